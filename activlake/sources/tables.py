"""Batch readers: sheets, employee reference, distance cache and lake tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activlake.functions.casting import bigint, integer, number
from activlake.functions.text import strip_headers
from activlake.schemas import DISTANCE_CACHE, REFERENCE
from activlake.session import lake_format

_FROM_TEXT = {"int": integer, "bigint": bigint, "double": number}
_AS_IS = {(kind, kind) for kind in ("int", "bigint", "string", "boolean")}


def _cast(name: str, given: str, wanted: T.DataType) -> Column:
    column, kind = F.col(f"`{name}`"), wanted.simpleString()
    if given == "string" and kind in _FROM_TEXT:
        return _FROM_TEXT[kind](column)
    return number(column) if kind == "double" else column.try_cast(wanted)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns that ``schema`` knows by name; leave the others alone.

    Values that do not fit become null, and NaN becomes null with them.
    """
    given = dict(df.dtypes)
    return df.withColumns(
        {
            f.name: _cast(f.name, given[f.name], f.dataType)
            for f in schema
            if f.name in given and (given[f.name], f.dataType.simpleString()) not in _AS_IS
        }
    )


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with a header row, all columns as text; quotes are doubled inside quotes.

    A large file is split over many tasks. ``multiline`` keeps line breaks inside
    quoted fields instead, at the price that one file is one task.
    """
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )


def read_sheet(
    spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = False
) -> DataFrame:
    """An exported HR or sport sheet; white space around its headers is dropped."""
    sheet = read_csv(spark, path, multiline) if fmt == "csv" else spark.read.format(fmt).load(path)
    return strip_headers(sheet)


def read_reference(
    spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = False
) -> DataFrame:
    """Employee reference with typed known columns, extra columns passed through."""
    return conform(read_sheet(spark, path, fmt, multiline), REFERENCE)


def read_distance_cache(
    spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = False
) -> DataFrame:
    """Distances of an earlier reference build; empty when there is none yet."""
    try:
        known = read_reference(spark, path, fmt, multiline)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DISTANCE_CACHE)
    return known.select(*DISTANCE_CACHE.fieldNames())


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str | None = None
) -> DataFrame:
    """A lake table. With ``schema`` no file footer is opened to plan the scan."""
    fmt = fmt or lake_format(spark)
    if fmt == "delta" or schema is None:
        return spark.read.format(fmt).load(path)
    return spark.read.format(fmt).schema(schema).load(path).select(*schema.fieldNames())


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows; with ``order`` the choice is stable (a top-n, not a full sort)."""
    return (df.orderBy(*order) if order else df).limit(n)
