"""Stream output in one folder per query and micro-batch.

A batch that a crash left without its commit is run again with the same number and the same input: it
overwrites its folder, so nothing is stored twice, whatever of the first attempt was written. No log of
files is kept, so closed batches can be compacted and their small files deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from activlake.sinks.tables import (
    LOT,
    compact_table,
    delete_folder,
    folders,
    is_complete,
    overwrite_table,
)

QUERY, UPTO = "requete", "jusqu_a"


def _lot(path: str, query: str, lot: int) -> str:
    return f"{path}/{QUERY}={query}/{LOT}={lot}"


def write_lots(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    partition_by: tuple[str, ...] = (),
    name: str | None = None,
    counts: dict[str, Column] | None = None,
    counted: Callable[[SparkSession, str, int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Write a stream batch by batch. ``counts`` are taken in the write of each batch and handed to
    ``counted`` with the query's id and the batch number."""

    def write(batch: DataFrame, lot: int) -> None:
        spark = batch.sparkSession
        # The id stays with the checkpoint: a new checkpoint starts numbers anew under a new id.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        found = overwrite_table(batch, _lot(path, query, lot), "parquet", partition_by, counts)
        if counted:
            counted(spark, query, lot, found)

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    if trigger == "available":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def _numbers(spark: SparkSession, path: str, part: str) -> dict[str, list[int]]:
    """For each query the numbers of its folders, which are named ``part=number``."""
    found = {}
    for query in folders(spark, path):
        if query.startswith(f"{QUERY}="):
            names = [n for n in folders(spark, f"{path}/{query}") if n.startswith(f"{part}=")]
            found[query.partition("=")[2]] = sorted(int(n.partition("=")[2]) for n in names)
    return found


def ranges(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Last batch numbers of the complete compacted ranges, for each query."""
    return {
        query: [n for n in numbers if is_complete(spark, _range(path, query, n))]
        for query, numbers in _numbers(spark, path, UPTO).items()
    }


def _range(path: str, query: str, upto: int) -> str:
    return f"{path}/{QUERY}={query}/{UPTO}={upto}"


def has_lots(spark: SparkSession, path: str) -> bool:
    return bool(folders(spark, path))


def read_lots(
    spark: SparkSession, path: str, compacted: str, schema: T.StructType
) -> DataFrame:
    """All batches: compacted ranges, and the folders of the batches after them.

    The folders are named to the reader, so small files that were compacted are neither listed nor
    opened.
    """
    done = ranges(spark, compacted)
    fresh = [
        _lot(path, query, n)
        for query, numbers in _numbers(spark, path, LOT).items()
        for n in numbers
        if n > max(done.get(query, []), default=-1)
    ]
    merged = [_range(compacted, query, n) for query, numbers in done.items() for n in numbers]
    found = spark.createDataFrame([], schema)
    for base, parts in ((compacted, merged), (path, fresh)):
        if parts:
            rows = spark.read.schema(schema).option("basePath", base).parquet(*parts)
            found = found.unionByName(rows.drop(QUERY, LOT, UPTO), allowMissingColumns=True)
    return found


def compact_lots(
    spark: SparkSession,
    path: str,
    compacted: str,
    schema: T.StructType,
    files: int,
    partition_by: tuple[str, ...] = (),
) -> list[str]:
    """Merge the closed batches that no range holds yet into one range per query.

    A batch is closed when a later one exists: the last one may be written again after a crash. Each
    row is merged once, however often this runs. An attempt that did not end is invisible and is
    replaced by the next.
    """
    done, made = ranges(spark, compacted), []
    for query, numbers in _numbers(spark, path, LOT).items():
        after = max(done.get(query, []), default=-1)
        closed = [n for n in numbers[:-1] if n > after]
        if not closed:
            continue
        parts = [_lot(path, query, n) for n in closed]
        rows = spark.read.schema(schema).option("basePath", path).parquet(*parts)
        target = _range(compacted, query, closed[-1])
        compact_table(rows.drop(QUERY, LOT), target, files, partition_by, "parquet")
        made.append(target)
    return made


def retire_lots(spark: SparkSession, path: str, compacted: str) -> list[str]:
    """Delete the folders of batches that a complete range holds."""
    done, gone = ranges(spark, compacted), []
    for query, numbers in _numbers(spark, path, LOT).items():
        for n in numbers:
            if n <= max(done.get(query, []), default=-1):
                delete_folder(spark, _lot(path, query, n))
                gone.append(_lot(path, query, n))
    return gone


def lot_counts(path: str) -> Callable[[SparkSession, str, int, dict[str, int]], None]:
    """A receiver for ``write_lots`` that stores each batch's counts, one folder per batch as well."""

    def store(spark: SparkSession, query: str, lot: int, found: dict[str, int]) -> None:
        rows = spark.createDataFrame(list(found.items()), "rule string, n_bad long")
        overwrite_table(rows.coalesce(1), _lot(path, query, lot), "parquet")

    return store


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts over all batches so far."""
    schema = "rule string, n_bad long, requete string, lot long"
    rows = spark.read.schema(schema).parquet(path)
    return rows.groupBy("rule").agg(F.sum("n_bad").alias("n_bad"))
