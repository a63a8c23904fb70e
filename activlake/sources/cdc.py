"""Change-event stream source. Every connector yields one binary ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from activlake.schemas import STREAM_VALUE


def read_cdc_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Topic of change envelopes. Needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**(options or {}))
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select("value")


def read_cdc_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Directory where envelopes land as Parquet (binary ``value``) or as text, one per line."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        return reader.text(path).selectExpr("CAST(value AS BINARY) AS value")
    return reader.schema(STREAM_VALUE).format(fmt).load(path)
