"""The two independent consumers of the change stream, each with its own checkpoint."""

from activlake.streaming.consumers import start_bronze, start_bronze_lots, start_notifications

__all__ = ["start_bronze", "start_bronze_lots", "start_notifications"]
