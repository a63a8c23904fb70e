"""Silver to Gold: indicators per employee."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activlake.functions.casting import micros_timestamp, number
from activlake.functions.rules import sport_bonus, wellbeing_eligible
from activlake.functions.text import normalize_headers
from activlake.functions.timing import rolling_year_start
from activlake.operators.bronze import DAY
from activlake.operators.silver import DEDUP_KEYS, reference_lookup, unique_activities
from activlake.rules import BusinessRules


def rolling_year(silver: DataFrame, as_of: date | None) -> DataFrame:
    """Activities of the twelve months before ``as_of``; all of them when it is None."""
    if as_of is None:
        return silver
    first = rolling_year_start(as_of)
    if DAY in silver.columns:  # a table partitioned by day: skip the older partitions
        silver = silver.filter(F.col(DAY) >= first)
    return silver.filter(F.col("date_debut") >= first.cast("timestamp"))


def rolling_year_of_bronze(bronze: DataFrame, as_of: date | None) -> DataFrame:
    """The same choice on Bronze. The start is part of the deduplication key, so whole groups of
    copies are in or out and the filter may come before the deduplication."""
    if as_of is None:
        return bronze
    first = rolling_year_start(as_of)
    if DAY in bronze.columns:
        bronze = bronze.filter(F.col(DAY) >= first)
    return bronze.filter(micros_timestamp(F.col("date_debut")) >= first.cast("timestamp"))


def activity_counts(silver: DataFrame) -> DataFrame:
    """Activities and valid activities per employee.

    Both counts combine inside the map tasks, so one employee with most of the
    rows still sends one row per task.
    """
    return silver.groupBy("id_salarie").agg(
        F.count("id_evenement").alias("nb_total_activites"),
        F.count_if(F.col("alerte_transport") == "OK").alias("nb_activites_valides"),
    )


def employee_counts(bronze: DataFrame) -> DataFrame:
    """Distinct activities per employee: keys of rows with an id, as Silver keeps them."""
    return (
        bronze.filter(F.col("id").isNotNull())
        .select(*DEDUP_KEYS)
        .distinct()
        .groupBy("id_salarie")
        .agg(F.count(F.lit(1)).alias("activities"))
    )


def activity_counts_from_bronze(bronze: DataFrame, reference: DataFrame) -> DataFrame:
    """The counts of :func:`activity_counts` without building Silver first.

    The alert depends on the employee alone, so activities are counted before
    the join: it then carries one row per employee instead of one per activity.
    Counting needs only the distinct keys, not the surviving rows, so nothing is
    sorted and no other column is read. An employee with several lookup rows
    counts each activity once per row, as the Silver join would.
    """
    return with_alerts(employee_counts(bronze), alert_rows(reference))


def alert_rows(reference: DataFrame) -> DataFrame:
    """Lookup rows per employee, and those whose declaration is in order."""
    return (
        reference_lookup(reference)
        .groupBy("id_salarie_rh")
        .agg(
            F.count("*").alias("lookup_rows"),
            F.count_if(F.col("alerte_transport") == "OK").alias("ok_rows"),
        )
    )


def with_alerts(per_employee: DataFrame, alerts: DataFrame) -> DataFrame:
    """Counts of ``activities`` per employee as total and valid ones."""
    joined = per_employee.join(
        alerts, per_employee.id_salarie == alerts.id_salarie_rh, "left"
    )
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return joined.select(
        "id_salarie",
        (F.col("activities") * F.coalesce("lookup_rows", one)).alias("nb_total_activites"),
        (F.col("activities") * F.coalesce("ok_rows", none)).alias("nb_activites_valides"),
    )


def indicators(
    counts: DataFrame, reference: DataFrame, rules: BusinessRules = BusinessRules()
) -> DataFrame:
    """Counts with every reference column, the bonus and the wellbeing eligibility.

    The bonus does not look at the valid count: a flagged employee keeps it.
    """
    reference = normalize_headers(reference)
    joined = counts.join(reference, counts.id_salarie == reference.employee_id, "inner")
    return joined.withColumns(
        {
            "montant_prime_sportive": sport_bonus(
                F.col("moyen_transport"), F.col("salaire_brut"), rules
            ),
            "eligible_jours_bien_etre": wellbeing_eligible(F.col("nb_total_activites"), rules),
        }
    )


def to_gold(
    silver: DataFrame,
    reference: DataFrame,
    as_of: date | None = None,
    rules: BusinessRules = BusinessRules(),
) -> DataFrame:
    return indicators(activity_counts(rolling_year(silver, as_of)), reference, rules)


def gold_from_bronze(
    bronze: DataFrame,
    reference: DataFrame,
    as_of: date | None = None,
    rules: BusinessRules = BusinessRules(),
) -> DataFrame:
    """The rows of :func:`to_gold` without a Silver table. ``reference`` is read twice, so give
    it a stored one."""
    recent = rolling_year_of_bronze(bronze, as_of)
    return indicators(activity_counts_from_bronze(recent, reference), reference, rules)


def distance_totals(silver: DataFrame) -> DataFrame:
    """Metres covered per employee."""
    return silver.groupBy("id_salarie").agg(F.sum("distance_metres").alias("distance_totale_metres"))


def distance_totals_from_bronze(bronze: DataFrame) -> DataFrame:
    """The same from Bronze: deduplicated on the columns it needs, without join or stored table.

    An employee with several lookup rows counts each activity once here.
    """
    unique = unique_activities(bronze.select("id", *DEDUP_KEYS, "distance"))
    metres = F.coalesce(number(F.col("distance")), F.lit(0.0))
    return unique.groupBy("id_salarie").agg(F.sum(metres).alias("distance_totale_metres"))


def financial_report(gold: DataFrame) -> DataFrame:
    """One row of totals; an empty Gold table costs 0."""
    return gold.agg(
        F.count("*").alias("nb_salaries"),
        F.count_if(F.col("montant_prime_sportive") > 0).alias("nb_primes"),
        F.count_if("eligible_jours_bien_etre").alias("nb_bien_etre"),
        F.coalesce(F.sum("montant_prime_sportive"), F.lit(0.0)).alias("total_primes"),
    )


def most_active(gold: DataFrame, n: int = 10) -> DataFrame:
    """Employees with the most activities; ties go to the lower id."""
    return (
        gold.select(
            "id_salarie",
            "nb_total_activites",
            "montant_prime_sportive",
            "eligible_jours_bien_etre",
        )
        .orderBy(F.col("nb_total_activites").desc(), F.col("id_salarie"))
        .limit(n)
    )
