"""Bronze to Silver: typed, deduplicated, enriched with the employee reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activlake.functions.casting import micros_timestamp, number
from activlake.functions.rules import transport_alert
from activlake.functions.timing import whole_minutes
from activlake.schemas import REFERENCE
from activlake.sources.tables import conform

DEDUP_KEYS = ("id_salarie", "type_sport", "date_debut")
UNKNOWN_ALERT = "INCONNU"


def deduplicate(df: DataFrame, keys: tuple[str, ...], first_by: tuple[str, ...]) -> DataFrame:
    """One row per key: the smallest, compared by ``first_by`` and then by every other column.

    The minimum combines inside the map tasks before the shuffle, so a group of
    any number of copies reaches the reducer as one row per map task. Comparing
    whole rows makes the survivor the same on every run and retry.
    """
    columns = df.columns
    rest = [c for c in columns if c not in keys and c not in first_by]
    smallest = F.min(F.struct(*first_by, *rest)).alias("_row")
    return df.groupBy(*keys).agg(smallest).select(*keys, "_row.*").select(*columns)


def unique_activities(bronze: DataFrame) -> DataFrame:
    """One Bronze row per employee, sport and start; the lowest id survives.

    A row without id is no activity (Bronze never stores one), so it cannot survive.
    """
    return deduplicate(bronze.filter(F.col("id").isNotNull()), DEDUP_KEYS, ("id",))


def reference_lookup(reference: DataFrame) -> DataFrame:
    """Declared transport, home distance and alert per employee, without repeated rows."""
    distinct = conform(reference, REFERENCE).select(
        F.col("employee_id").alias("id_salarie_rh"),
        F.col("moyen_transport").alias("mode_transport_declare"),
        F.col("distance_domicile_entreprise_km").alias("distance_domicile_travail_km"),
        F.coalesce(F.col("erreur_declaration_transport"), F.lit(False)).alias("erreur_flag"),
    ).distinct()
    return distinct.withColumn("alerte_transport", transport_alert(F.col("erreur_flag"))).drop(
        "erreur_flag"
    )


# Bronze columns behind Silver ones, beyond the key and the id, in the order they settle ties.
_SOURCES = {
    "distance": "distance_metres",
    "date_fin": "date_fin",
    "commentaire": "commentaire",
    "duration_sec": "duration_min",
}


def _needed(bronze: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The Bronze columns that some Silver columns need, and those that settle ties before them."""
    wanted = [i for i, name in enumerate(_SOURCES.values()) if name in columns]
    kept = list(_SOURCES)[: max(wanted, default=-1) + 1]
    return bronze.select("id", *DEDUP_KEYS, *kept)


def to_silver(
    bronze: DataFrame, reference: DataFrame, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Silver rows. Employees missing from the reference keep their activities.

    With ``columns`` only these are made, and the deduplication carries no others: a report
    never sorts or shuffles comments that it does not read.

    The lookup is broadcast only while Spark's own size check allows it. Past
    that the join shuffles, and AQE splits a partition that one employee fills.
    """
    activities = unique_activities(_needed(bronze, columns) if columns else bronze)
    return silver_rows(activities, reference_lookup(reference), columns)


def silver_rows(
    activities: DataFrame, lookup: DataFrame, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Silver rows of activities without copies and the employee lookup."""
    joined = activities.join(lookup, activities.id_salarie == lookup.id_salarie_rh, "left")
    unknown, none = F.lit(UNKNOWN_ALERT), F.lit(0)
    made = {
        "id_evenement": F.col("id"),
        "id_salarie": F.col("id_salarie").try_cast("bigint"),
        "type_sport": F.col("type_sport"),
        "distance_metres": F.coalesce(number(F.col("distance")), F.lit(0.0)),
        "duration_min": F.coalesce(whole_minutes(F.col("duration_sec")), none),
        "date_debut": micros_timestamp(F.col("date_debut")),
        "date_fin": micros_timestamp(F.col("date_fin")),
        "mode_transport_declare": F.col("mode_transport_declare"),
        "distance_domicile_travail_km": F.col("distance_domicile_travail_km"),
        "alerte_transport": F.coalesce("alerte_transport", unknown),
        "commentaire": F.col("commentaire"),
    }
    return joined.select(*(c.alias(n) for n, c in made.items() if not columns or n in columns))
