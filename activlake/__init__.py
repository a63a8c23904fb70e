"""Spark-native lakehouse analytics for employee activity data."""

from activlake.rules import BusinessRules, GeneratorBounds

__all__ = ["BusinessRules", "GeneratorBounds"]
