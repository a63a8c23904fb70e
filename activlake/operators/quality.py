"""Data-quality jobs. Each report is one pass over its table, whatever the number of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activlake.functions.casting import micros_timestamp
from activlake.operators.gold import employee_counts
from activlake.operators.silver import UNKNOWN_ALERT, reference_lookup
from activlake.rules import GeneratorBounds


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows ``(rule, n_bad)``, all counted by a single aggregation."""
    wide = df.agg(*[F.count_if(bad).alias(rule) for rule, bad in rules.items()])
    return wide.unpivot([], list(rules), "rule", "n_bad")


def silver_rules() -> dict[str, Column]:
    """The three conformity rules of the Silver table."""
    return {
        "distance_negative": F.col("distance_metres") < 0,
        "date_fin_avant_debut": F.col("date_fin") < F.col("date_debut"),
        # Matched employees always carry OK or FRAUDE, even without a transport label.
        "salarie_absent_du_referentiel": F.col("alerte_transport") == UNKNOWN_ALERT,
    }


def not_null_rules(*columns: str) -> dict[str, Column]:
    return {f"{c}_null": F.col(c).isNull() for c in columns}


def generator_rules(bounds: GeneratorBounds = GeneratorBounds()) -> dict[str, Column]:
    """Rules on Bronze values: durations, distances, start period, matching end date.

    A value that is missing or unreadable breaks its rule.
    """
    seconds, metres = F.col("duration_sec"), F.col("distance")
    start, end = micros_timestamp(F.col("date_debut")), micros_timestamp(F.col("date_fin"))
    first, last = (F.lit(str(t)).cast("timestamp") for t in (bounds.first_start, bounds.last_start))
    stationary = F.col("type_sport").isin(*bounds.stationary_sports)
    span = F.try_subtract(F.unix_micros(end), F.unix_micros(start))
    expected = F.try_multiply(seconds, F.lit(1_000_000).cast("bigint"))
    rules = {
        "duree_hors_bornes": ~seconds.between(bounds.min_duration_sec, bounds.max_duration_sec),
        "distance_hors_bornes": F.when(stationary, metres != 0).otherwise(
            ~metres.between(bounds.min_distance_m, bounds.max_distance_m)
        ),
        "debut_hors_periode": ~start.between(first, last),
        "fin_differente_du_debut_plus_duree": span != expected,
    }
    return {name: F.coalesce(bad, F.lit(True)) for name, bad in rules.items()}


#: Silver columns that the reports read.
REPORT_COLUMNS = (
    "id_evenement",
    "id_salarie",
    "type_sport",
    "distance_metres",
    "date_debut",
    "date_fin",
    "alerte_transport",
)
FRAUD_COLUMNS = (
    "id_evenement",
    "id_salarie",
    "type_sport",
    "distance_domicile_travail_km",
    "alerte_transport",
)


def silver_report_rules() -> dict[str, Column]:
    return {**silver_rules(), **not_null_rules("id_salarie", "type_sport")}


def silver_report(silver: DataFrame) -> DataFrame:
    return count_violations(silver, silver_report_rules())


def bronze_report(bronze: DataFrame, bounds: GeneratorBounds = GeneratorBounds()) -> DataFrame:
    return count_violations(bronze, generator_rules(bounds))


def gold_report(gold: DataFrame) -> DataFrame:
    return count_violations(gold, not_null_rules("id_salarie"))


def issue_total(report: DataFrame) -> DataFrame:
    """Number of rules with violations, and the verdict."""
    issues = F.count_if(F.col("n_bad") > 0)
    return report.agg(
        issues.alias("nb_regles_en_echec"),
        F.when(issues == 0, F.lit("OK")).otherwise(F.lit("ALERTE")).alias("statut"),
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def alert_split(silver: DataFrame) -> DataFrame:
    return silver.groupBy("alerte_transport").agg(F.count("*").alias("nb_activites"))


def alert_split_from_bronze(bronze: DataFrame, reference: DataFrame) -> DataFrame:
    """The same from Bronze: activities are counted per employee before the join, which then
    carries one row per employee."""
    lookups = (
        reference_lookup(reference)
        .groupBy("id_salarie_rh", "alerte_transport")
        .agg(F.count(F.lit(1)).alias("lookup_rows"))
    )
    counts = employee_counts(bronze)
    joined = counts.join(lookups, counts.id_salarie == lookups.id_salarie_rh, "left")
    rows = F.col("activities") * F.coalesce("lookup_rows", F.lit(1).cast("bigint"))
    return joined.groupBy(
        F.coalesce("alerte_transport", F.lit(UNKNOWN_ALERT)).alias("alerte_transport")
    ).agg(F.sum(rows).alias("nb_activites"))


def flagged_activities(silver: DataFrame) -> DataFrame:
    """Activities of employees whose transport declaration is contradicted."""
    return silver.filter(F.col("alerte_transport") == "FRAUDE").select(*FRAUD_COLUMNS)
