"""Employee reference: HR joined with sport, home distance and declaration check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activlake.functions.casting import number
from activlake.functions.distance import provider_distance_km
from activlake.functions.rules import transport_anomaly, travel_mode
from activlake.functions.text import label
from activlake.rules import NO_SPORT, BusinessRules
from activlake.schemas import HR_RENAMES, REFERENCE, SPORT_RENAMES
from activlake.sources.tables import conform

DISTANCE = "distance_domicile_entreprise_km"


def clean_hr(hr: DataFrame) -> DataFrame:
    """Working names, typed columns, canonical transport labels."""
    hr = conform(hr.withColumnsRenamed(HR_RENAMES), REFERENCE)
    return hr.withColumn("moyen_transport", label(F.col("moyen_transport")))


def clean_sport(sport: DataFrame) -> DataFrame:
    """Working names, canonical sports, ``AUCUN`` for a missing one."""
    sport = conform(sport.withColumnsRenamed(SPORT_RENAMES), REFERENCE)
    declared = F.coalesce(F.col("pratique_sport"), F.lit(NO_SPORT))
    return sport.withColumn("pratique_sport", label(declared))


def merge_sources(hr: DataFrame, sport: DataFrame) -> DataFrame:
    """Every HR row with its sport rows; clashing names get ``_x`` (HR) and ``_y`` (sport).

    An employee absent from the sport table has no declared sport. The left join
    is written as its two halves because Spark splits a hot key on either side of
    an inner join, but only on the left side of a left join.
    """
    clashes = (set(hr.columns) & set(sport.columns)) - {"employee_id"}
    hr = hr.withColumnsRenamed({c: f"{c}_x" for c in clashes})
    sport = sport.withColumnsRenamed({c: f"{c}_y" for c in clashes})
    declared = sport.select("employee_id").distinct()
    merged = hr.join(sport, "employee_id").unionByName(
        hr.join(declared, "employee_id", "left_anti"), allowMissingColumns=True
    )
    return merged.withColumn("pratique_sport", F.coalesce("pratique_sport", F.lit(NO_SPORT)))


def known_distances(cache: DataFrame) -> DataFrame:
    """One known distance per employee; the largest where the cache disagrees with itself.

    The maximum combines inside each task before the shuffle, so a cache full
    of copies of one employee moves one row per task.
    """
    km = number(F.col(DISTANCE))
    return (
        cache.groupBy(F.col("employee_id").try_cast("bigint").alias("employee_id"))
        .agg(F.max(km).alias("km"))
        .filter(F.col("employee_id").isNotNull() & F.col("km").isNotNull())
    )


def provider_distances(responses: DataFrame) -> DataFrame:
    """Cache rows decoded from stored provider responses (``employee_id``, ``response``)."""
    return responses.select("employee_id", provider_distance_km(F.col("response")).alias(DISTANCE))


def with_distance(
    employees: DataFrame,
    cache: DataFrame | None = None,
    responses: DataFrame | None = None,
    rules: BusinessRules = BusinessRules(),
) -> DataFrame:
    """Add the home distance: cached, else decoded from a response, else the default.

    The default stands for "no provider at all": where responses are given, an
    employee whose response is unusable gets null.
    """
    decoded = None if responses is None else provider_distances(responses)
    candidates = []
    for i, source in enumerate((cache, decoded)):
        if source is None:
            continue
        lookup = known_distances(source).withColumnRenamed("km", f"_km{i}")
        employees = employees.join(lookup, "employee_id", "left")
        candidates.append(F.col(f"_km{i}"))
    if responses is None:
        candidates.append(F.lit(rules.default_distance_km))
    return employees.withColumn(DISTANCE, F.coalesce(*candidates)).drop("_km0", "_km1")


def _asked(employees: DataFrame, rules: BusinessRules) -> DataFrame:
    """Employees with the address and travel mode a provider is asked about."""
    mode = travel_mode(F.col("moyen_transport"), rules)
    return employees.withColumn("mode_trajet", mode)


def distance_requests(
    employees: DataFrame, cache: DataFrame | None = None, rules: BusinessRules = BusinessRules()
) -> DataFrame:
    """Which distances have to be asked for: ``domicile_address, mode_trajet, nb_salaries``.

    Employees whose distance the cache knows are left out; of the others, those of one address and
    mode share a request. Without an address there is nothing to ask. ``employees`` come from
    :func:`clean_hr`.
    """
    if cache is not None:
        known = known_distances(cache).select("employee_id")
        employees = employees.join(known, "employee_id", "left_anti")
    return (
        _asked(employees, rules)
        .filter(F.col("domicile_address").isNotNull())
        .groupBy("domicile_address", "mode_trajet")
        .agg(F.count(F.lit(1)).alias("nb_salaries"))
    )


def responses_of_answers(
    employees: DataFrame, answers: DataFrame, rules: BusinessRules = BusinessRules()
) -> DataFrame:
    """Answers (``domicile_address, mode_trajet, response``) handed to every employee who shares the
    request, as the ``employee_id, response`` rows a reference build takes.

    The join is an inner one of two plain tables, of which Spark splits an address that very many
    employees share.
    """
    keys = ["domicile_address", "mode_trajet"]
    asked = _asked(employees, rules).select("employee_id", *keys)
    return asked.join(answers.select(*keys, "response"), keys).select("employee_id", "response")


def flag_declarations(employees: DataFrame, rules: BusinessRules = BusinessRules()) -> DataFrame:
    flag = transport_anomaly(F.col("moyen_transport"), F.col(DISTANCE), rules)
    return employees.withColumn("erreur_declaration_transport", flag)


def build_reference(
    hr: DataFrame,
    sport: DataFrame,
    cache: DataFrame | None = None,
    responses: DataFrame | None = None,
    rules: BusinessRules = BusinessRules(),
) -> DataFrame:
    """The whole employee reference as one lazy plan."""
    merged = merge_sources(clean_hr(hr), clean_sport(sport))
    return flag_declarations(with_distance(merged, cache, responses, rules), rules)


def transport_modes(hr: DataFrame, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """Distinct transport labels with their travel mode."""
    labels = hr.select("moyen_transport").distinct()
    return labels.withColumn("mode_trajet", travel_mode(F.col("moyen_transport"), rules))


def anomaly_count(reference: DataFrame) -> DataFrame:
    return reference.agg(
        F.count("*").alias("nb_salaries"),
        F.count_if("erreur_declaration_transport").alias("nb_anomalies"),
    )


def declared_athletes(reference: DataFrame) -> DataFrame:
    """Employees who practise a sport."""
    return reference.filter(label(F.col("pratique_sport")) != NO_SPORT)
