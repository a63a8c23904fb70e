"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that Spark computes exactly once for each row, however often they are read.

    A generator of one row keeps the optimizer from copying the expression into its readers,
    where a lambda would evaluate it for every element.
    """
    held = F.array(F.struct(*(c.alias(n) for n, c in columns.items())))
    return df.select("*", F.inline(held).alias(*columns))


def words(text: Column) -> Column:
    """Words between white space, as an array; null and blank texts have none."""
    core = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(core) > 0, F.split(core, SPACE_CLASS + "+")).otherwise(
        F.array().cast("array<string>")
    )


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, CAPITALS, CAPITALS.lower())


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet, compared as Spark does."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def by_name(df: DataFrame, name: str) -> Column:
    """A column of the table, also if its name holds dots."""
    return df[f"`{name}`"]


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def crc32_mod(key: Column, modulus: int) -> Column:
    """crc32 of a key's text, modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir``; a session without it (as in tests) uses its warehouse.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    return found or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table as Parquet to a new folder of the shared one and read it again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Spark's setting to delete shuffle files when the query that wrote them ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end, not when the driver happens
    to collect its garbage. For frames that run once, such as ``stored`` ones: another run of the
    same frame would have to shuffle again. Frames that callers run are made outside."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
