"""Casts that give null instead of an error under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    """Text to double; unreadable text and ``nan`` both become null."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def integer(c: Column) -> Column:
    """Text to int; ``'7.0'`` is 7 because integer columns with gaps are written as floats."""
    return F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"))


def bigint(c: Column) -> Column:
    """Text to bigint, accepting a decimal tail."""
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def micros_timestamp(c: Column) -> Column:
    """Epoch-microsecond text to timestamp, exact to the microsecond."""
    return F.timestamp_micros(bigint(c))
