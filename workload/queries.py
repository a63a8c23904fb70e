"""One query per operator group, each over whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activlake.functions.casting import integer, micros_timestamp, number
from activlake.functions.distance import metres_to_km, provider_distance_km
from activlake.functions.rules import activity_distance
from activlake.functions.text import activity_comment, label, normalize_headers
from activlake.functions.timing import end_time, event_date_text, minutes_between, parse_event_date
from activlake.operators import (
    bronze,
    colocated,
    daily,
    dated,
    gold,
    ingest,
    keyed,
    notify,
    quality,
    reference,
    silver,
)
from activlake.plans.medallion import (
    LakePaths,
    compact_bronze,
    create_tables,
    load_bronze,
    load_daily,
    load_reference,
    refresh_silver,
    run_daily,
    run_ingest,
    run_reference,
    run_silver,
    silver_counts,
    stream_counts,
)
from activlake.rules import GeneratorBounds
from activlake.schemas import ACTIVITES, BRONZE, NOTIFICATION, SILVER
from activlake.sinks.lots import lot_counts
from activlake.sinks.tables import (
    LOT,
    append_table,
    export_csv,
    overwrite_table,
    publish,
    read_current,
    write_csv,
)
from activlake.sources.tables import preview, read_csv, read_reference, read_table
from activlake.streaming import start_bronze, start_bronze_lots, start_notifications
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that the SQL oracle repeats.
AS_OF = date(2001, 8, 1)
AS_OF_EVENTS = date(2025, 1, 15)
VIEWS_LATER = 10**12
EVENT_BOUNDS = GeneratorBounds(
    min_distance_m=20,
    max_distance_m=80,
    first_start=datetime(2024, 1, 10),
    last_start=datetime(2024, 1, 20),
)
ORDER_BOUNDS = GeneratorBounds(
    stationary_sports=("F",),
    first_start=datetime(1996, 1, 1),
    last_start=datetime(2000, 12, 31),
)


def scratch(spark: SparkSession, name: str) -> str:
    """New folder for a query that stores its result, on the cluster's shared storage.

    It is ``spark.checkpoint.dir``, or the warehouse of a session without one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as plain UTC date-times, the form the SQL side has."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Integers with gaps as text: pandas would turn them into floats on one side only."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- shared stages -------------------------------------------------------------------


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return reference.build_reference(
        t.hr_customers(spark, sf), t.sport_suppliers(spark, sf), t.cache_events(spark, sf)
    )


def _suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return reference.build_reference(
        t.hr_suppliers(spark, sf), t.sport_suppliers(spark, sf), t.cache_suppliers(spark, sf)
    )


def _silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver.to_silver(t.bronze_orders(spark, sf), _customers(spark, sf))


def _stored_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver of the orders as the pipeline leaves it: a stored table."""
    path = scratch(spark, "silver")
    overwrite_table(_silver_orders(spark, sf), path, "parquet")
    return read_table(spark, path, SILVER, "parquet")


def _silver_events(
    spark: SparkSession, sf: str, columns: tuple[str, ...] | None = None
) -> DataFrame:
    return silver.to_silver(t.bronze_events(spark, sf), _suppliers(spark, sf), columns)


def _stored_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The reference as the pipeline leaves it: built once, a stored table."""
    path = scratch(spark, "reference-table")
    overwrite_table(_customers(spark, sf), path, "parquet")
    return read_table(spark, path, fmt="parquet")


def _gold(spark: SparkSession, sf: str, as_of: date | None = None) -> DataFrame:
    return gold.gold_from_bronze(
        t.bronze_orders(spark, sf), _stored_customers(spark, sf), as_of
    )


# --- Gold ----------------------------------------------------------------------------


def gold_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return _gold(spark, sf)


def gold_kpi_from_silver(spark: SparkSession, sf: str) -> DataFrame:
    return gold.to_gold(_stored_silver(spark, sf), _customers(spark, sf))


def gold_kpi_rolling(spark: SparkSession, sf: str) -> DataFrame:
    rolled = _gold(spark, sf, AS_OF)
    return rolled.select(
        "id_salarie", "nb_total_activites", "nb_activites_valides", "eligible_jours_bien_etre"
    )


def gold_distance(spark: SparkSession, sf: str) -> DataFrame:
    totals = gold.distance_totals_from_bronze(t.bronze_orders(spark, sf))
    return totals.withColumn("distance_totale_metres", F.round("distance_totale_metres", 3))


def gold_bilan(spark: SparkSession, sf: str) -> DataFrame:
    report = gold.financial_report(_gold(spark, sf))
    return report.withColumn("total_primes", F.round("total_primes", 2))


def gold_top10(spark: SparkSession, sf: str) -> DataFrame:
    return gold.most_active(_gold(spark, sf))


# --- Silver --------------------------------------------------------------------------


def silver_activities(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(_silver_events(spark, sf), "date_debut", "date_fin")


def silver_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return silver.reference_lookup(_customers(spark, sf))


def silver_dedup(spark: SparkSession, sf: str) -> DataFrame:
    unique = silver.unique_activities(t.bronze_events(spark, sf))
    return unique.select("id", "id_salarie", "type_sport", "date_debut", "duration_sec")


# --- reference -----------------------------------------------------------------------


def reference_build(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_headers(_customers(spark, sf))


def reference_provider(spark: SparkSession, sf: str) -> DataFrame:
    built = reference.build_reference(
        t.hr_customers(spark, sf),
        t.sport_suppliers(spark, sf),
        t.cache_events(spark, sf),
        t.provider_responses(spark, sf),
    )
    return built.select(
        "employee_id", "distance_domicile_entreprise_km", "erreur_declaration_transport"
    )


def reference_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return reference.anomaly_count(_suppliers(spark, sf))


def reference_modes(spark: SparkSession, sf: str) -> DataFrame:
    return reference.transport_modes(reference.clean_hr(t.hr_customers(spark, sf)))


def reference_athletes(spark: SparkSession, sf: str) -> DataFrame:
    athletes = reference.declared_athletes(_suppliers(spark, sf))
    return athletes.select(
        "employee_id",
        activity_comment(F.col("Prénom"), F.col("Nom"), F.col("pratique_sport")).alias(
            "commentaire"
        ),
        activity_distance(F.col("pratique_sport"), F.col("salaire_brut")).alias("distance"),
    )


def distance_decode(spark: SparkSession, sf: str) -> DataFrame:
    responses = t.provider_responses(spark, sf)
    return responses.select("employee_id", provider_distance_km(F.col("response")).alias("km"))


# --- Bronze and ingestion ------------------------------------------------------------


def cdc_bronze(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.to_bronze(t.cdc_messages(t.table(spark, sf, "events")))
    return as_text(rows, "duration_sec")


def ingest_validate(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.validate(t.ingest_bodies(spark, sf)).select("id", "status", "message")


def ingest_store(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "activites")
    append_table(ingest.stored_rows(t.ingest_bodies(spark, sf)), path, "parquet")
    stored = read_table(spark, path, fmt="parquet").drop("created_at", "duration_sec")
    return ntz(stored, "date_debut", "date_fin")


# --- quality -------------------------------------------------------------------------


def dq_silver(spark: SparkSession, sf: str) -> DataFrame:
    return quality.silver_report(_silver_events(spark, sf, quality.REPORT_COLUMNS))


def dq_issue_total(spark: SparkSession, sf: str) -> DataFrame:
    rows = _silver_events(spark, sf, quality.REPORT_COLUMNS)
    return quality.issue_total(quality.count_violations(rows, quality.silver_rules()))


def dq_bronze_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return quality.bronze_report(t.faulty_orders(spark, sf), ORDER_BOUNDS)


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    starts = t.bronze_events(spark, sf)
    return quality.duplicate_keys(starts, *silver.DEDUP_KEYS)


def dq_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold as a faulty load would leave it: some employees lost their id."""
    lost = F.when(F.col("id_salarie") % 7 != 0, F.col("id_salarie"))
    return quality.gold_report(_gold(spark, sf).withColumn("id_salarie", lost))


def alert_split(spark: SparkSession, sf: str) -> DataFrame:
    return quality.alert_split_from_bronze(t.bronze_events(spark, sf), _suppliers(spark, sf))


def fraud_list(spark: SparkSession, sf: str) -> DataFrame:
    return quality.flagged_activities(_silver_events(spark, sf, quality.FRAUD_COLUMNS))


# --- notifications and times ---------------------------------------------------------


def notify_messages(spark: SparkSession, sf: str) -> DataFrame:
    return notify.to_notifications(t.notification_messages(t.table(spark, sf, "events")))


def time_rules(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("ts").cast("timestamp")
    end = end_time(F.date_trunc("second", start), (F.col("k") - 50) * 7)
    text = event_date_text(end)
    return t.with_k(t.table(spark, sf, "events")).select(
        "event_id",
        text.alias("date_fin"),
        minutes_between(start, parse_event_date(text)).alias("minutes"),
        metres_to_km(F.col("value").cast("string")).alias("km"),
    )


def casts(spark: SparkSession, sf: str) -> DataFrame:
    """Typed reading of identifiers and amounts that were written as text."""
    kind = F.col("event_type")
    whole = F.concat(F.col("user_id").cast("string"), F.lit(".0"))
    written_id = (
        F.when(kind == "click", whole)
        .when(kind == "error", F.lit("x"))
        .otherwise(F.col("user_id").cast("string"))
    )
    written_km = F.when(kind == "view", F.lit("nan")).otherwise(F.col("value").cast("string"))
    typed = t.table(spark, sf, "events").select(
        "event_id",
        integer(written_id).alias("id_salarie"),
        number(written_km).alias("km"),
        label(F.concat(F.lit(" \t"), kind, F.lit(" "))).alias("categorie"),
    )
    return as_text(typed, "id_salarie")


def preview_limit(spark: SparkSession, sf: str) -> DataFrame:
    return preview(t.bronze_orders(spark, sf), 20, "id")


# --- stored results ------------------------------------------------------------------


def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    """The event table as a file stream. The glob also matches when it is a single file."""
    schema = t.table(spark, sf, "events").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000)
    return reader.parquet(f"{sf}/events.parque[t]")


def stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch(spark, "stream-bronze")
    for _ in range(2):  # the second run resumes from the checkpoint and finds nothing new
        start_bronze(
            t.cdc_messages(stream_events(spark, sf)),
            f"{base}/table",
            f"{base}/checkpoint",
            trigger="available",
            by_day=True,
            fmt="parquet",
        ).awaitTermination()
    return as_text(read_table(spark, f"{base}/table", BRONZE, "parquet"), "duration_sec")


def _lot_lake(spark: SparkSession, sf: str) -> LakePaths:
    """Bronze streamed in several batches, a folder each, with its quality counts."""
    paths = LakePaths(scratch(spark, "lots"))
    events = t.table(spark, sf, "events")
    inbox = f"{paths.root}/inbox"
    events.repartition(4).write.parquet(inbox)
    rules = quality.generator_rules(EVENT_BOUNDS)
    for _ in range(2):  # the second run resumes from the checkpoint and finds nothing new
        source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
        start_bronze_lots(
            t.cdc_messages(source.parquet(inbox)),
            paths.lots,
            paths.checkpoint("lots"),
            trigger="available",
            by_day=True,
            counts={name: F.count_if(bad) for name, bad in rules.items()},
            counted=lot_counts(paths.counts("bronze")),
        ).awaitTermination()
    return paths


def stream_lots(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze in lots, its closed ones compacted."""
    paths = _lot_lake(spark, sf)
    compact_bronze(spark, paths, 2)
    return as_text(load_bronze(spark, paths).select(*BRONZE.fieldNames()), "duration_sec")


def stream_observed(spark: SparkSession, sf: str) -> DataFrame:
    """Quality counts that the stream took in the writes of its batches."""
    return stream_counts(spark, _lot_lake(spark, sf))


def stream_notifications(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch(spark, "stream-notifications")
    start_notifications(
        t.notification_messages(stream_events(spark, sf)),
        f"{base}/table",
        f"{base}/checkpoint",
        trigger="available",
        fmt="parquet",
    ).awaitTermination()
    return read_table(spark, f"{base}/table", NOTIFICATION, "parquet")


def reference_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "reference")
    write_csv(_customers(spark, sf), path)
    stored = normalize_headers(read_reference(spark, path))
    return stored.withColumn("code_secteur", integer(F.col("code_secteur")))


def reference_from_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Raw sheets as CSV with padded headers, built twice: the second run reads the distances of
    the first and has no provider."""
    base = scratch(spark, "sheets")
    for name, sheet in (("hr", t.hr_customers(spark, sf)), ("sport", t.sport_suppliers(spark, sf))):
        write_csv(sheet.withColumnsRenamed({c: f" {c} " for c in sheet.columns}), f"{base}/{name}")
    paths = LakePaths(f"{base}/lake")
    for responses in (t.provider_responses(spark, sf), None):
        run_reference(spark, paths, f"{base}/hr", f"{base}/sport", responses=responses)
    stored = normalize_headers(load_reference(spark, paths))
    return stored.select(
        "employee_id",
        "nom",
        "moyen_transport",
        "pratique_sport",
        "distance_domicile_entreprise_km",
        "erreur_declaration_transport",
    )


def ingest_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Tables created, the same bodies ingested as two lots: each id is stored once, and the refused
    bodies of both lots are kept with the reason."""
    paths = LakePaths(scratch(spark, "operations"))
    create_tables(spark, paths)
    for _ in range(2):
        run_ingest(spark, paths, t.ingest_bodies(spark, sf))
    stored = read_table(spark, paths.activities, ACTIVITES, "parquet").select(
        "id", F.lit("ok").alias("status"), F.lit(ingest.STORED).alias("message")
    )
    refused = read_table(spark, paths.refused, fmt="parquet").select("id", "status", "message")
    return stored.unionByName(refused)


def ingest_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies without ids and with a hot one, sent twice as one lot, then in another lot with new
    ids for some: what each lot stored and refused."""
    paths = LakePaths(scratch(spark, "keyed"))
    for lot, shift in (("a", 0), ("a", 0), ("b", VIEWS_LATER)):
        run_ingest(spark, paths, t.keyed_bodies(spark, sf, shift), lot)
    lots = read_table(spark, paths.activities, fmt="parquet").filter(F.col(LOT) != "0")
    stored = lots.select(LOT, "id", F.lit("ok").alias("status"), F.lit(ingest.STORED).alias("message"))
    refused = read_table(spark, paths.refused, fmt="parquet").select(LOT, "id", "status", "message")
    return as_text(stored.unionByName(refused), "id")


def _event_lake(spark: SparkSession, sf: str, name: str) -> LakePaths:
    """A lake with the stored reference of suppliers."""
    paths = LakePaths(scratch(spark, name))
    path = f"{paths.reference}/run=0"
    overwrite_table(_suppliers(spark, sf), f"{path}/table", "parquet")
    publish(spark, paths.reference, path)
    return paths


def gold_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily partials of a Bronze that lacks late rows of two days; these come and the days are
    replaced. Gold and distances of a rolling year are then sums of partials."""
    paths = _event_lake(spark, sf, "daily")
    rows = bronze.with_start_day(t.bronze_events(spark, sf))
    days = list(rows.agg(F.min(bronze.DAY), F.max(bronze.DAY)).first())
    early = rows.filter(~F.col(bronze.DAY).isin(days) | (F.col("id") % 2 == 0))
    for arrived, replaced in ((early, None), (rows, days)):
        overwrite_table(arrived, paths.bronze, "parquet", (bronze.DAY,))
        run_daily(spark, paths, replaced)
    partials = load_daily(spark, paths)
    metres = daily.distances_from_daily(partials, AS_OF_EVENTS)
    made = daily.gold_from_daily(partials, load_reference(spark, paths), AS_OF_EVENTS)
    return made.join(metres, "id_salarie").select(
        "id_salarie",
        "nb_total_activites",
        "nb_activites_valides",
        "montant_prime_sportive",
        "eligible_jours_bien_etre",
        F.round("distance_totale_metres", 3).alias("distance_totale_metres"),
    )


def _layout(spark: SparkSession, sf: str) -> colocated.Layout:
    name = f"orders_{uuid.uuid4().hex}"
    return colocated.store_by_employee(
        t.hot_orders(spark, sf), _stored_customers(spark, sf), name, scratch(spark, name), 8, 1_000
    )


def gold_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per employee over bucketed tables; one employee has a third of the rows."""
    return colocated.counts(_layout(spark, sf))


def silver_colocated(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(colocated.silver(_layout(spark, sf)), "date_debut", "date_fin")


def dq_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The Silver report as Spark counts it while Silver is written."""
    paths = _event_lake(spark, sf, "observed")
    overwrite_table(t.bronze_events(spark, sf), paths.bronze, "parquet")
    run_silver(spark, paths)
    return silver_counts(spark, paths)


def table_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A table by day whose last day is refreshed with wider ids and a column more."""
    events = t.table(spark, sf, "events").withColumn(bronze.DAY, F.to_date("ts"))
    last = events.agg(F.max(bronze.DAY)).first()[0]
    path = scratch(spark, "evolution")
    first = events.select(F.col("event_id").cast("int").alias("id"), "value", bronze.DAY)
    later = events.filter(F.col(bronze.DAY) == last).select(
        (F.col("event_id") + t.WIDE).alias("id"), "value", F.col("event_type").alias("note"), bronze.DAY
    )
    for run, rows, days in (("0", first, None), ("1", later, [last])):
        overwrite_table(rows, f"{path}/run={run}", "parquet", (bronze.DAY,))
        publish(spark, path, f"{path}/run={run}", days)
    current = read_current(spark, path, day=bronze.DAY)
    return current.select("id", "value", "note", F.col(bronze.DAY).cast("string").alias("day"))


def distance_worklist(spark: SparkSession, sf: str) -> DataFrame:
    """Distances to ask for: employees the cache does not know, one request per address and mode."""
    hr = reference.clean_hr(t.hr_customers(spark, sf))
    return reference.distance_requests(hr, t.cache_events(spark, sf))


def distance_answered(spark: SparkSession, sf: str) -> DataFrame:
    """The answers to these requests, given back to every employee who shares one."""
    hr = reference.clean_hr(t.hr_customers(spark, sf))
    cache = t.cache_events(spark, sf)
    answers = t.distance_answers(reference.distance_requests(hr, cache))
    responses = reference.responses_of_answers(hr, answers)
    known = reference.with_distance(hr, cache, responses)
    return known.select("employee_id", "distance_domicile_entreprise_km")


def join_multiplicity(spark: SparkSession, sf: str) -> DataFrame:
    """What a join of activities with a table of many rows per employee would do to their number."""
    lookup = t.cache_events(spark, sf)
    return keyed.fan_out(t.hot_orders(spark, sf), lookup, "id_salarie", "employee_id")


def rules_dated(spark: SparkSession, sf: str) -> DataFrame:
    """Activities with the rule of their sport on their day, or the default sport's."""
    activities = t.bronze_orders(spark, sf).withColumn("debut", micros_timestamp(F.col("date_debut")))
    found = dated.with_dated_rule(
        activities, t.dated_rules(spark, sf), F.col("type_sport"), F.to_date("debut")
    )
    return found.select(
        "id", "type_sport", "rule.label", "rule.rate", F.col("rule_level").alias("level")
    )


def silver_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Silver built in full from half of Bronze, then refreshed for the days of the other half."""
    paths = LakePaths(scratch(spark, "refresh"))
    rows = bronze.with_start_day(t.bronze_events(spark, sf))
    days = sorted(
        r[0] for r in rows.select(bronze.DAY).distinct().collect() if r[0] and r[0].day % 2
    )  # calendar days, a few at any size of the table
    early = rows.filter(~F.col(bronze.DAY).isin(days) | (F.col("id") % 2 == 0))
    overwrite_table(early, paths.bronze, "parquet", (bronze.DAY,))
    path = f"{paths.reference}/run=0"
    overwrite_table(_suppliers(spark, sf), f"{path}/table", "parquet")
    publish(spark, paths.reference, path)
    run_silver(spark, paths, by_day=True)
    overwrite_table(rows, paths.bronze, "parquet", (bronze.DAY,))
    return ntz(refresh_silver(spark, paths, days), "date_debut", "date_fin")


def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "silver")
    overwrite_table(_silver_events(spark, sf), path, "parquet")
    return ntz(read_table(spark, path, SILVER, "parquet"), "date_debut", "date_fin")


def gold_export(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch(spark, "gold")
    overwrite_table(_gold(spark, sf), f"{base}/table", "parquet")
    stored = read_table(spark, f"{base}/table", fmt="parquet")
    export_csv(stored, f"{base}/export")
    exported = read_csv(spark, f"{base}/export")
    return exported.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in stored.schema])


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        gold_kpi,
        gold_kpi_from_silver,
        gold_kpi_rolling,
        gold_distance,
        gold_bilan,
        gold_top10,
        gold_export,
        silver_activities,
        silver_lookup,
        silver_dedup,
        silver_table,
        silver_refresh,
        reference_build,
        reference_provider,
        reference_anomaly,
        reference_modes,
        reference_athletes,
        reference_csv,
        reference_from_sheets,
        distance_decode,
        cdc_bronze,
        stream_bronze,
        ingest_validate,
        ingest_store,
        ingest_pipeline,
        ingest_keyed,
        gold_daily,
        gold_colocated,
        silver_colocated,
        dq_observed,
        table_evolution,
        distance_worklist,
        distance_answered,
        join_multiplicity,
        rules_dated,
        stream_lots,
        stream_observed,
        dq_silver,
        dq_issue_total,
        dq_bronze_bounds,
        dq_unique,
        dq_gold,
        alert_split,
        fraud_list,
        notify_messages,
        stream_notifications,
        time_rules,
        casts,
        preview_limit,
    )
}
