"""Text and column-name normalization."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters counted as white space when a value is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_HEADER_MAP = str.maketrans({" ": "_", "(": None, ")": None, "é": "e"})


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def label(c: Column) -> Column:
    """Canonical form of a category: stripped, upper case."""
    return F.upper(strip(c))


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def normalize_headers(df: DataFrame) -> DataFrame:
    """Snake-case headers. ``é`` is folded before lowering, so a capital ``É`` stays ``é``."""
    return df.toDF(*[name.translate(_HEADER_MAP).lower() for name in df.columns])


def one_decimal(c: Column) -> Column:
    """Fixed-point text with one digit, ties to even, no thousands separator."""
    return F.replace(F.format_number(c, 1), F.lit(","), F.lit(""))


def activity_comment(first_name: Column, last_name: Column, sport: Column) -> Column:
    return F.concat(F.concat_ws(" ", first_name, last_name), F.lit(" - "), sport)


def name_from_comment(comment: Column, employee: Column) -> Column:
    """Person named before the first ``' - '``; the whole text, or the id, when there is none."""
    return (
        F.when(F.coalesce(comment, F.lit("")) != "", F.substring_index(comment, " - ", 1))
        .otherwise(F.concat(F.lit("salarié "), employee))
    )
