"""Appends under a primary key: a key is stored once, whatever arrives again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Judged:
    """Rows to insert and rows that the key refuses."""

    fresh: DataFrame
    repeated: DataFrame


def first_arrivals(rows: DataFrame, key: str, arrival: str) -> DataFrame:
    """``key, arrival`` of the first row of each key.

    The minimum combines inside the map tasks, so a key on a third of the rows sends one row per task.
    """
    return rows.groupBy(key).agg(F.min(arrival).alias(arrival))


def stored_among(stored: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The ``wanted`` keys that are stored already.

    A semi join with the stored keys on the left: Spark then builds a Bloom filter of the wanted keys
    and drops other stored keys at the scan, before they are shuffled (where the stored side is
    larger than ``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold`` and the
    wanted keys pass a filter of their own). Nothing but the key column is read.
    """
    return stored.select(key).join(wanted.select(key), key, "left_semi").distinct()


def insertable(rows: DataFrame, stored: DataFrame, key: str, arrival: str) -> DataFrame:
    """``arrival`` of the rows that may be inserted: the first of each key that is not stored."""
    known = stored_among(stored, rows, key)
    return first_arrivals(rows, key, arrival).join(known, key, "left_anti").select(arrival)


def split_by_key(rows: DataFrame, arrivals: DataFrame, arrival: str) -> Judged:
    """Rows whose ``arrival`` is among ``arrivals``, and the others.

    Arrival numbers are unique, so neither join knows a hot key.
    """
    return Judged(
        rows.join(arrivals, arrival, "left_semi"), rows.join(arrivals, arrival, "left_anti")
    )


def fan_out(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """How a left join multiplies rows, from key counts alone; the join itself is not run.

    One row per key that occurs on the left: ``key, left_rows, right_rows, joined_rows, added_rows``.
    A null key matches nothing and keeps its rows. Both sides send one row per key and task.
    """
    own = left.groupBy(F.col(left_key).alias("key")).agg(F.count(F.lit(1)).alias("left_rows"))
    other = right.groupBy(F.col(right_key).alias("key")).agg(F.count(F.lit(1)).alias("right_rows"))
    found = own.join(other, "key", "left").withColumn(
        "right_rows", F.coalesce("right_rows", F.lit(0).cast("bigint"))
    )
    joined = F.col("left_rows") * F.greatest("right_rows", F.lit(1).cast("bigint"))
    return found.withColumns(
        {"joined_rows": joined, "added_rows": joined - F.col("left_rows")}
    )


def fan_out_total(report: DataFrame) -> DataFrame:
    """One row: rows before and after the join, keys that multiply rows, rows without a match."""
    none = F.lit(0).cast("bigint")
    total = lambda c: F.coalesce(F.sum(c), none)
    return report.agg(
        total("left_rows").alias("left_rows"),
        total("joined_rows").alias("joined_rows"),
        F.count_if(F.col("right_rows") > 1).alias("multiplying_keys"),
        total(F.when(F.col("right_rows") == 0, F.col("left_rows"))).alias("unmatched_rows"),
    )
