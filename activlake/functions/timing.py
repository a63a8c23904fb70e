"""Durations and dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from activlake.functions.casting import bigint

# The date layouts accepted in an event, each with the shape that announces it.
EVENT_DATE_FORMATS = {"____-%": "yyyy-M-d H:m:s", "%/%": "d/M/yyyy H:m"}
EVENT_DATE_OUTPUT = "yyyy-MM-dd HH:mm:ss"


def duration_seconds(start_micros: Column, end_micros: Column) -> Column:
    """Whole seconds between two epoch-microsecond texts, truncated toward zero."""
    span = F.try_subtract(bigint(end_micros), bigint(start_micros))
    return (span / F.lit(1_000_000)).try_cast("bigint")


def whole_minutes(seconds: Column) -> Column:
    """Seconds to minutes, truncated toward zero."""
    return (seconds / F.lit(60)).try_cast("int")


def parse_event_date(c: Column) -> Column:
    """Date in an accepted layout or as an epoch-microsecond number, else null.

    The shape is tested first because a text that does not fit a layout costs an
    exception inside the parser.
    """
    parsed = F.timestamp_micros(c.try_cast("bigint"))
    for shape, layout in EVENT_DATE_FORMATS.items():
        parsed = F.when(c.like(shape), F.try_to_timestamp(c, F.lit(layout))).otherwise(parsed)
    return parsed


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes between two timestamps, rounded down (also below zero); 0 when unknown."""
    span = F.try_subtract(F.unix_micros(end), F.unix_micros(start))
    return F.coalesce(F.floor(span / F.lit(60_000_000)), F.lit(0).cast("bigint"))


def end_time(start: Column, duration_sec: Column) -> Column:
    zero = F.lit(0)
    return start + F.make_dt_interval(zero, zero, zero, duration_sec)


def event_date_text(c: Column) -> Column:
    return F.date_format(c, EVENT_DATE_OUTPUT)


def rolling_year_start(as_of: date) -> Column:
    """First day of the twelve months that end on ``as_of``."""
    return F.add_months(F.lit(as_of), -12)
