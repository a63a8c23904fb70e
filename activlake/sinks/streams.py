"""Streaming writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from activlake.session import lake_format


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    fmt: str | None = None,
    partition_by: tuple[str, ...] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a table, each batch exactly once.

    ``trigger`` is a processing-time interval such as ``"1 minute"``;
    ``"available"`` drains what is there and stops; None starts a batch as soon
    as the last one ends. A longer interval means fewer, larger files.
    """
    writer = (
        df.writeStream.format(fmt or lake_format(df.sparkSession))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if trigger == "available":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start(path)
