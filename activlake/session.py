"""Session construction."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Settings that hold at any scale; the partition count comes from the input size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def shuffle_partitions(input_bytes: int, target_bytes: int = 128 * 1024**2) -> int:
    """Shuffle partitions for an input, so that one task's share stays near ``target_bytes``.

    AQE merges partitions that turn out small but cannot split an even shuffle,
    so the count has to be high enough from the start. It grows with the input
    without a limit; raise ``target_bytes`` where fewer, larger tasks are wanted.
    """
    return max(200, math.ceil(input_bytes / target_bytes))


def get_session(
    app_name: str = "activlake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    delta: bool = False,
    log_level: str = "WARN",
) -> SparkSession:
    """Build or fetch a session in UTC; ``delta=True`` where its jar is on the classpath."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(DELTA_CONF if delta else {}), **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def lake_format(spark: SparkSession) -> str:
    """Table format of the lake: Delta when the session has its extension, else Parquet."""
    return "delta" if "DeltaSparkSessionExtension" in spark.conf.get("spark.sql.extensions", "") else "parquet"
