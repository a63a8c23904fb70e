"""Streaming queries: change stream to Bronze, and change stream to notifications."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from activlake.operators.bronze import DAY, to_bronze, with_start_day
from activlake.operators.notify import to_notifications
from activlake.sinks.lots import write_lots
from activlake.sinks.streams import append_stream


def start_bronze(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    by_day: bool = False,
    fmt: str | None = None,
    files_per_day: int = 4,
    writers: int | None = None,
) -> StreamingQuery:
    """Append decoded changes to Bronze; ``by_day`` partitions it by start day.

    A batch then writes at most ``files_per_day`` files for each of its days: rows are brought
    together by day and a salt, so that a day with most of the rows has several writers.
    ``writers`` is the number of tasks, by default the session's shuffle partitions.
    """
    rows = to_bronze(messages)
    if by_day:
        dealt = _dealt_by_day(rows, files_per_day, writers)
        return append_stream(dealt, path, checkpoint, trigger, fmt, (DAY,), "bronze")
    return append_stream(rows, path, checkpoint, trigger, fmt, name="bronze")


def _dealt_by_day(rows: DataFrame, files_per_day: int, writers: int | None) -> DataFrame:
    salt = F.pmod(F.xxhash64("id"), F.lit(files_per_day))
    dealt = with_start_day(rows)
    return dealt.repartition(writers, DAY, salt) if writers else dealt.repartition(DAY, salt)


def start_bronze_lots(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    by_day: bool = False,
    files_per_day: int = 4,
    writers: int | None = None,
    counts: dict[str, Column] | None = None,
    counted: Callable[[SparkSession, str, int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Write decoded changes to Bronze in one folder per query and batch, which a replay overwrites.

    ``counts`` are quality counts taken in the write of each batch, see ``write_lots``.
    """
    rows = to_bronze(messages)
    if by_day:
        rows = _dealt_by_day(rows, files_per_day, writers)
    by = (DAY,) if by_day else ()
    return write_lots(rows, path, checkpoint, trigger, by, "bronze", counts, counted)


def start_notifications(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    fmt: str | None = None,
) -> StreamingQuery:
    """Append one message per change to the notification table."""
    messages = messages.filter(messages.value.isNotNull())
    return append_stream(
        to_notifications(messages), path, checkpoint, trigger, fmt, name="notifications"
    )
