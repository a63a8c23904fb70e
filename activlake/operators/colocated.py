"""Activities and employees laid out by employee, so that the stages after Bronze shuffle nothing.

Deduplication, counts and the lookup all work per employee. Stored in equally many buckets by employee,
activities and lookup meet in one task without an exchange. A bucket cannot be split, so employees with
more than ``hot_rows`` activities, and activities without employee, are stored apart and take the usual
way: partial aggregation in the tasks and a shuffle of what is left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.operators.gold import alert_rows, employee_counts, with_alerts
from activlake.operators.silver import DEDUP_KEYS, reference_lookup, silver_rows, unique_activities
from activlake.sinks.tables import overwrite_table, write_bucketed


@dataclass(frozen=True)
class Layout:
    """Stored tables of one layout; ``name`` is the prefix of its tables in the catalog."""

    bucketed: DataFrame
    hot: DataFrame
    lookup: DataFrame
    alerts: DataFrame


def _paths(path: str) -> dict[str, str]:
    return {part: f"{path}/{part}" for part in ("activities", "hot", "lookup", "alerts")}


def store_by_employee(
    bronze: DataFrame, reference: DataFrame, name: str, path: str, buckets: int, hot_rows: int
) -> Layout:
    """Write the layout. The hot employees are at most the activities divided by ``hot_rows``."""
    at = _paths(path)
    hot = (
        bronze.filter(F.col("id_salarie").isNotNull())
        .groupBy("id_salarie")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > hot_rows)
        .select("id_salarie")
    )
    overwrite_table(hot, f"{path}/hot_employees", "parquet")
    hot = bronze.sparkSession.read.parquet(f"{path}/hot_employees")
    known = bronze.filter(F.col("id_salarie").isNotNull())
    write_bucketed(
        known.join(hot, "id_salarie", "left_anti").select(*bronze.columns),
        f"{name}_activities", at["activities"], buckets, "id_salarie", DEDUP_KEYS[1:],
    )
    apart = known.join(hot, "id_salarie", "left_semi").select(*bronze.columns)
    overwrite_table(
        apart.union(bronze.filter(F.col("id_salarie").isNull())), at["hot"], "parquet"
    )
    write_bucketed(
        reference_lookup(reference), f"{name}_lookup", at["lookup"], buckets, "id_salarie_rh"
    )
    write_bucketed(
        alert_rows(reference), f"{name}_alerts", at["alerts"], buckets, "id_salarie_rh"
    )
    return open_layout(bronze.sparkSession, name, path)


def open_layout(spark: SparkSession, name: str, path: str) -> Layout:
    tables = (spark.table(f"{name}_{part}") for part in ("activities", "lookup", "alerts"))
    bucketed, lookup, alerts = tables
    return Layout(bucketed, spark.read.parquet(_paths(path)["hot"]), lookup, alerts)


def bucketed_counts(layout: Layout) -> DataFrame:
    """Indicator counts of all but the hot employees, without an exchange."""
    return with_alerts(employee_counts(layout.bucketed), layout.alerts.hint("merge"))


def bucketed_silver(layout: Layout) -> DataFrame:
    """Silver rows of all but the hot employees, without an exchange."""
    return silver_rows(unique_activities(layout.bucketed), layout.lookup.hint("merge"))


def counts(layout: Layout) -> DataFrame:
    """Total and valid activities of every employee."""
    return bucketed_counts(layout).unionByName(
        with_alerts(employee_counts(layout.hot), layout.alerts)
    )


def silver(layout: Layout) -> DataFrame:
    """All Silver rows."""
    return bucketed_silver(layout).unionByName(
        silver_rows(unique_activities(layout.hot), layout.lookup)
    )
