"""JSON decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode(df: DataFrame, text: Column, schema: T.StructType, *keep: str) -> DataFrame:
    """``keep`` columns and the fields of a JSON text, all null where it is unreadable.

    The fields come out of a generator because Spark moves a filter through a
    projection by copying its expressions: each filter on a field of a plain
    ``from_json`` column would parse the text once more.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))
