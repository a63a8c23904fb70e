"""Batch writers."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activlake.session import lake_format

#: Partition column of tables that are written lot by lot.
LOT = "lot"

_RUN_LOG = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("published_at", T.TimestampType(), False),
        T.StructField("days", T.ArrayType(T.DateType()), True),
    ]
)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; text is kept exactly, white space and quotes included."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _by_partition(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Bring the rows of a partition together, so that each task writes few files.

    Rebalancing splits a partition value that is too large for one task, where
    a plain repartition by the column would not.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite_table(
    df: DataFrame,
    path: str,
    fmt: str | None = None,
    partition_by: tuple[str, ...] = (),
    counts: dict[str, Column] | None = None,
) -> dict[str, int]:
    """Replace a whole table; its schema may change.

    ``counts`` are aggregates that Spark takes while it writes, without reading a row again; they are
    returned by name. They stand above the last shuffle, in the tasks that write, so a repeated
    shuffle task is not counted twice.
    """
    dealt, observed = _by_partition(df, partition_by), None
    if counts:
        observed = Observation()
        dealt = dealt.observe(observed, *(c.alias(n) for n, c in counts.items()))
    writer = (
        dealt.write.format(fmt or lake_format(df.sparkSession))
        .mode("overwrite")
        .option("overwriteSchema", True)
        .option("partitionOverwriteMode", "static")
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return observed.get if observed else {}


def overwrite_lot(df: DataFrame, path: str, lot: str, fmt: str | None = None) -> None:
    """Replace one lot of a table. A lot that is written again leaves nothing of its first attempt."""
    fmt = fmt or lake_format(df.sparkSession)
    if fmt != "delta":
        overwrite_table(df, f"{path}/{LOT}={lot}", fmt)
        return
    (
        df.withColumn(LOT, F.lit(lot))
        .write.format(fmt)
        .mode("overwrite")
        .option("replaceWhere", f"{LOT} = '{lot}'")
        .partitionBy(LOT)
        .save(path)
    )


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, key: str, order: tuple[str, ...] = ()
) -> DataFrame:
    """Store a table in ``buckets`` files by ``key``, sorted, under a name of the catalog.

    Tables with equal bucket counts join on the key, and group by it, without a shuffle.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key, *order)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: tuple[str, ...], fmt: str | None = None
) -> None:
    """Replace only the partitions present in ``df``."""
    (
        _by_partition(df, partition_by)
        .write.format(fmt or lake_format(df.sparkSession))
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def append_table(df: DataFrame, path: str, fmt: str | None = None) -> None:
    df.write.format(fmt or lake_format(df.sparkSession)).mode("append").save(path)


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None
) -> None:
    """Create an empty table unless one is there already."""
    fmt = fmt or lake_format(spark)
    spark.createDataFrame([], schema).write.format(fmt).mode("ignore").save(path)


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Export a table as CSV: as many files as its plan has tasks, or exactly ``files``.

    One file is what a spreadsheet wants, and one task then writes it; that is
    the caller's choice, not something the number of rows decides.
    """
    write_csv(df if files is None else df.repartition(files), path)


def compact_table(
    df: DataFrame,
    target: str,
    files: int,
    partition_by: tuple[str, ...] = (),
    fmt: str | None = None,
) -> None:
    """Write the rows of many small files as fewer ones at a new path, partitions kept.

    A table without partitions gets ``files`` files. With partitions each value
    gets up to ``files``, so that a value with most of the rows has several writers.
    """
    if not partition_by:
        return overwrite_table(df.repartition(files), target, fmt)
    part = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    spread = df.repartition(*partition_by, part)
    (
        spread.write.format(fmt or lake_format(df.sparkSession))
        .mode("overwrite")
        .partitionBy(*partition_by)
        .save(target)
    )


# --- published versions ---------------------------------------------------------------
#
# Replacing Parquet in place is not atomic, so each run writes its own folder and one appended
# row makes it current. A run may replace some days only: the other days stay where they are.


def publish(
    spark: SparkSession, table: str, run_path: str, days: list[date] | None = None
) -> None:
    """Make ``run_path`` the current version of ``table``, or of some of its ``days``."""
    row = spark.range(0, 1, 1, 1).select(
        F.lit(run_path).alias("path"),
        F.current_timestamp().alias("published_at"),
        F.lit(None if days is None else [str(d) for d in days]).cast("array<date>").alias("days"),
    )
    row.write.mode("append").parquet(f"{table}/_runs_log")


def versions(spark: SparkSession, table: str) -> list[tuple[str, list[date] | None]]:
    """Published runs that are still current: the latest full one, then refreshed days."""
    try:
        log = spark.read.schema(_RUN_LOG).parquet(f"{table}/_runs_log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    current: list[tuple[str, list[date] | None]] = []
    for run in log.orderBy("published_at", "path").collect():  # one small row per run
        if run.days is None:
            current = [(run.path, None)]
        else:
            left = [
                (p, d if d is None else [x for x in d if x not in run.days]) for p, d in current
            ]
            current = [v for v in left if v[1] is None or v[1]] + [(run.path, list(run.days))]
    return current


def current_path(spark: SparkSession, table: str) -> str | None:
    """Folder of the latest full run, or None before the first one."""
    return next((path for path, days in versions(spark, table) if days is None), None)


def read_current(
    spark: SparkSession, table: str, schema: T.StructType | None = None, day: str | None = None
) -> DataFrame:
    """The current version of a Parquet table, refreshed days in place of the older ones.

    The day filters are on the partition column, so a replaced day is never read. Each run is read
    with its own schema and merged by column name: a column that some runs lack is null there, and
    a type that was widened holds for all (Spark refuses types that have no common one).
    """
    runs = versions(spark, table) or [(table, None)]
    replaced = sorted({d for _, days in runs if days for d in days})
    found = None
    for path, days in runs:
        part = _read_run(spark, path, found)
        if days is not None:
            part = part.filter(F.col(day).isin(days))
        elif replaced:
            part = part.filter(~F.col(day).isin(replaced) | F.col(day).isNull())
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return found if schema is None else found.select(*schema.fieldNames())


def _read_run(spark: SparkSession, path: str, before: DataFrame | None) -> DataFrame:
    """One run. A refresh that found no rows left no file, so the runs before it tell its schema."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as empty:
        if before is None or empty.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    return spark.read.schema(before.schema).parquet(path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it does not exist."""
    files, root = _folder(spark, path)
    if not files.exists(root):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(root) if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has ended."""
    files, root = _folder(spark, f"{path}/_SUCCESS")
    return files.exists(root)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, root = _folder(spark, path)
    files.delete(root, True)


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def retire_runs(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Delete run folders of ``table`` that are not current, except the ``keep`` newest of them."""
    files, root = _folder(spark, table)
    if not files.exists(root):
        return []
    current = {path.rstrip("/").rsplit("/", 1)[-1] for path, _ in versions(spark, table)}
    runs = sorted(
        s.getPath().getName()
        for s in files.listStatus(root)
        if s.isDirectory() and s.getPath().getName().startswith("run=")
    )
    old = [name for name in runs if name not in current]
    gone = old[: max(0, len(old) - keep)]
    for name in gone:
        where = _folder(spark, f"{table}/{name}")[1]
        files.delete(where, True)
    return gone
