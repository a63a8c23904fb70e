"""Daily partials: what a day adds to the indicators of an employee.

Copies of an activity share their start, hence their day. A day is therefore counted from its own
rows alone, can be replaced alone, and any span of whole days is a sum over its partials: Gold and the
distances read one row per employee and day instead of every activity.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activlake.functions.casting import micros_timestamp, number
from activlake.functions.timing import rolling_year_start
from activlake.operators.bronze import DAY
from activlake.operators.gold import alert_rows, indicators, with_alerts
from activlake.operators.silver import DEDUP_KEYS, unique_activities
from activlake.rules import BusinessRules


def daily_partials(bronze: DataFrame) -> DataFrame:
    """``id_salarie, activities, metres, jour_debut``; activities without a readable start have the
    null day. Deduplicated on the columns that are counted; both groupings combine in the tasks."""
    unique = unique_activities(bronze.select("id", *DEDUP_KEYS, "distance"))
    metres = F.coalesce(number(F.col("distance")), F.lit(0.0))
    return unique.groupBy(
        "id_salarie", F.to_date(micros_timestamp(F.col("date_debut"))).alias(DAY)
    ).agg(F.count(F.lit(1)).alias("activities"), F.sum(metres).alias("metres")).select(
        "id_salarie", "activities", "metres", DAY
    )


def rolling_days(daily: DataFrame, as_of: date | None) -> DataFrame:
    """Partials of the twelve months before ``as_of``: the year starts at midnight, so it is a
    filter on the partition column."""
    return daily if as_of is None else daily.filter(F.col(DAY) >= rolling_year_start(as_of))


def gold_from_daily(
    daily: DataFrame,
    reference: DataFrame,
    as_of: date | None = None,
    rules: BusinessRules = BusinessRules(),
) -> DataFrame:
    """The rows of ``to_gold`` from daily partials. ``reference`` is read twice: give a stored one."""
    counts = (
        rolling_days(daily, as_of)
        .groupBy("id_salarie")
        .agg(F.sum("activities").alias("activities"))
    )
    return indicators(with_alerts(counts, alert_rows(reference)), reference, rules)


def distances_from_daily(daily: DataFrame, as_of: date | None = None) -> DataFrame:
    """Metres covered per employee."""
    return rolling_days(daily, as_of).groupBy("id_salarie").agg(
        F.sum("metres").alias("distance_totale_metres")
    )
