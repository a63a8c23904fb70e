"""Stages from sheets to Gold. Each one reads stored tables and writes one table.

A lost executor costs the tasks it ran: every stage restarts from what the stage
before it stored, and no stage keeps state outside its output.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activlake.operators import daily, gold, keyed, quality
from activlake.operators.bronze import DAY
from activlake.operators.ingest import REPEATED, judged
from activlake.operators.reference import build_reference, clean_hr, distance_requests
from activlake.operators.silver import reference_lookup, to_silver
from activlake.rules import BusinessRules
from activlake.schemas import ACTIVITES, BRONZE, DAILY, EMPLOYES, SILVER
from activlake.session import lake_format
from activlake.sinks.lots import compact_lots, has_lots, read_counts, read_lots, retire_lots
from activlake.sinks.tables import (
    LOT,
    compact_table,
    create_table,
    current_path,
    export_csv,
    folders,
    overwrite_lot,
    overwrite_partitions,
    overwrite_table,
    publish,
    read_current,
    retire_runs,
    versions,
    write_csv,
)
from activlake.sources.tables import (
    read_distance_cache,
    read_reference,
    read_sheet,
    read_table,
)

#: Parts of a run that holds more than its table.
TABLE, FILES = "table", "files"

#: Refreshes that readers put together before they are folded into one run.
FOLD_RUNS = 16


@dataclass(frozen=True)
class LakePaths:
    """Where each table lives under one shared root."""

    root: str

    @property
    def reference(self) -> str:
        return f"{self.root}/reference"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/activites_sportives"

    @property
    def lots(self) -> str:
        """Bronze written batch by batch."""
        return f"{self.root}/bronze/lots"

    @property
    def compacted_lots(self) -> str:
        return f"{self.root}/bronze/compacted_lots"

    @property
    def notifications(self) -> str:
        return f"{self.root}/notifications"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/activites_sportives"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/indicateurs_rh"

    @property
    def compacted(self) -> str:
        return f"{self.root}/bronze/compacted"

    @property
    def employees(self) -> str:
        return f"{self.root}/operations/employes"

    @property
    def activities(self) -> str:
        return f"{self.root}/operations/activites_sportives"

    @property
    def refused(self) -> str:
        return f"{self.root}/operations/refused"

    @property
    def staging(self) -> str:
        return f"{self.root}/operations/staging"

    @property
    def daily(self) -> str:
        """Counts and metres per employee and day."""
        return f"{self.root}/gold/partiels_par_jour"

    @property
    def requests(self) -> str:
        """Addresses whose distance has to be asked for."""
        return f"{self.root}/reference_requests"

    def counts(self, layer: str) -> str:
        """Quality counts taken while ``layer`` was written."""
        return f"{self.root}/quality/{layer}"

    @property
    def distances(self) -> str:
        return f"{self.root}/gold/distances"

    @property
    def export(self) -> str:
        return f"{self.root}/gold/export_csv"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/{query}"


def _new_run(table: str) -> str:
    return f"{table}/run={datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"


def _replace(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    partition_by: tuple[str, ...] = (),
    rules: dict[str, Column] | None = None,
    counts: dict[str, int] | None = None,
) -> str:
    """Store ``df`` as the new version of ``table`` and return where it is. What ``rules`` count in
    the write goes into ``counts``."""
    path = table if lake_format(spark) == "delta" else _new_run(table)
    found = overwrite_table(df, path, partition_by=partition_by, counts=rules)
    if counts is not None:
        counts.update(found)
    if path == table:
        return table
    publish(spark, table, path)
    return path


def located(spark: SparkSession, table: str) -> str:
    """Folder a reader of ``table`` has to load."""
    return table if lake_format(spark) == "delta" else current_path(spark, table) or table


def load(spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of a table, refreshed days included."""
    if lake_format(spark) == "delta":
        return read_table(spark, table, schema)
    return read_current(spark, table, schema, DAY)


#: Activities with the lot that brought them.
_ACTIVITY_LOTS = T.StructType([*ACTIVITES.fields, T.StructField(LOT, T.StringType())])


def create_tables(spark: SparkSession, paths: LakePaths) -> None:
    """The empty operational tables, unless they are there already."""
    create_table(spark, paths.employees, EMPLOYES)
    if not folders(spark, paths.activities):
        overwrite_lot(spark.createDataFrame([], ACTIVITES), paths.activities, "0")


def run_ingest(
    spark: SparkSession, paths: LakePaths, bodies: DataFrame, lot: str | None = None
) -> str:
    """Store accepted bodies (``id``, ``body``) as activities and keep refused ones with the reason.

    ``id`` is the primary key: of several accepted bodies with one id the first is stored, and none
    if another lot has stored the id; the others are refused. A lot is judged once, stored, and split
    from the stored copy. All of its output is its own: a lot that failed half-way, or is sent again
    under its name, replaces what it left. One ingestion runs at a time. Returns the lot's name.
    """
    lot = re.sub(r"[^A-Za-z0-9_.-]", "_", lot or f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}")
    create_tables(spark, paths)
    overwrite_table(judged(bodies), f"{paths.staging}/{LOT}={lot}/judged", "parquet")
    rows = spark.read.parquet(f"{paths.staging}/{LOT}={lot}/judged")
    stored = read_table(spark, paths.activities, _ACTIVITY_LOTS).filter(F.col(LOT) != lot)
    accepted = rows.filter(F.col("status") == "ok").withColumn("id", F.col("row.id"))
    arrivals = keyed.insertable(accepted, stored, "id", "arrival")
    overwrite_table(arrivals, f"{paths.staging}/{LOT}={lot}/arrivals", "parquet")
    arrivals = spark.read.parquet(f"{paths.staging}/{LOT}={lot}/arrivals")
    split = keyed.split_by_key(rows.filter(F.col("status") == "ok"), arrivals, "arrival")
    repeated = split.repeated.withColumns(
        {"status": F.lit("error"), "message": F.lit(REPEATED)}
    )
    refused = rows.filter(F.col("status") != "ok").unionByName(repeated)
    overwrite_lot(refused.drop("row", "arrival"), paths.refused, lot)
    overwrite_lot(split.fresh.select("row.*"), paths.activities, lot)
    return lot


def run_reference(
    spark: SparkSession,
    paths: LakePaths,
    hr_path: str,
    sport_path: str,
    fmt: str = "csv",
    responses: DataFrame | None = None,
    rules: BusinessRules = BusinessRules(),
    multiline: bool = False,
) -> DataFrame:
    """Build the reference, reusing the distances of the version before it.

    The version is a lake table, which the later stages read, and a CSV beside it.
    """
    before = current_path(spark, paths.reference)
    cache = read_distance_cache(spark, f"{before}/{TABLE}", "parquet") if before else None
    reference = build_reference(
        read_sheet(spark, hr_path, fmt, multiline),
        read_sheet(spark, sport_path, fmt, multiline),
        cache,
        responses,
        rules,
    )
    path = _new_run(paths.reference)
    overwrite_table(reference, f"{path}/{TABLE}", "parquet")
    stored = read_table(spark, f"{path}/{TABLE}", fmt="parquet")
    write_csv(stored, f"{path}/csv")
    publish(spark, paths.reference, path)
    return stored


def run_requests(
    spark: SparkSession,
    paths: LakePaths,
    hr_path: str,
    fmt: str = "csv",
    rules: BusinessRules = BusinessRules(),
    multiline: bool = False,
) -> DataFrame:
    """Store which distances have to be asked for before the next reference build."""
    before = current_path(spark, paths.reference)
    cache = read_distance_cache(spark, f"{before}/{TABLE}", "parquet") if before else None
    hr = clean_hr(read_sheet(spark, hr_path, fmt, multiline))
    return read_table(spark, _replace(spark, distance_requests(hr, cache, rules), paths.requests))


def load_reference(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The stored reference; a folder without versions is a CSV from elsewhere."""
    path = current_path(spark, paths.reference)
    if path is None:
        return read_reference(spark, paths.reference)
    return read_table(spark, f"{path}/{TABLE}", fmt="parquet")


def _lot_schema(spark: SparkSession, paths: LakePaths) -> T.StructType:
    """Bronze as its batches are stored: with the start day where they are partitioned by it."""
    for query in folders(spark, paths.lots):
        for lot in folders(spark, f"{paths.lots}/{query}"):
            if any(n.startswith(f"{DAY}=") for n in folders(spark, f"{paths.lots}/{query}/{lot}")):
                return T.StructType([*BRONZE.fields, T.StructField(DAY, T.DateType())])
    return BRONZE


def load_bronze(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Bronze with its compacted part in place of the small files that went into it."""
    if has_lots(spark, paths.lots):
        return read_lots(spark, paths.lots, paths.compacted_lots, _lot_schema(spark, paths))
    bronze = read_table(spark, paths.bronze)
    done = versions(spark, paths.compacted)
    if not done:
        return bronze
    path = done[-1][0]
    compacted = spark.read.parquet(f"{path}/{TABLE}")
    files = spark.read.parquet(f"{path}/{FILES}")
    fresh = (
        bronze.withColumn("_file", F.col("_metadata.file_path"))
        .join(files, "_file", "left_anti")
        .drop("_file")
    )
    return fresh.unionByName(compacted.select(*fresh.columns))


def compact_bronze(spark: SparkSession, paths: LakePaths, files: int) -> str:
    """Rewrite Bronze as ``files`` files (for each day, if it has days) and publish them.

    The stream goes on writing where it did. Bronze in lots gets a range of its closed batches, whose
    small files no reader opens any more. For the other layout, whose files the stream's own log
    lists, the compacted version names the files it holds; readers take these rows from it and all
    other files, late days included, from the stream.
    """
    if has_lots(spark, paths.lots):
        schema = _lot_schema(spark, paths)
        by = (DAY,) if DAY in schema.fieldNames() else ()
        compact_lots(spark, paths.lots, paths.compacted_lots, schema, files, by)
        return paths.compacted_lots
    bronze = read_table(spark, paths.bronze).withColumn("_file", F.col("_metadata.file_path"))
    path = _new_run(paths.compacted)
    overwrite_table(bronze.select("_file").distinct(), f"{path}/{FILES}", "parquet")
    listed = spark.read.parquet(f"{path}/{FILES}")
    held = bronze.join(listed, "_file", "left_semi").drop("_file")
    by = (DAY,) if DAY in held.columns else ()
    compact_table(held, f"{path}/{TABLE}", files, by, "parquet")
    publish(spark, paths.compacted, path)
    return path


def run_silver(spark: SparkSession, paths: LakePaths, by_day: bool = False) -> DataFrame:
    """Rebuild Silver from the whole of Bronze. Its quality report is taken in the same write."""
    bronze = load_bronze(spark, paths).select(*BRONZE.fieldNames())
    silver = to_silver(bronze, load_reference(spark, paths))
    if by_day:
        silver = silver.withColumn(DAY, F.to_date("date_debut"))
    by, counts = (DAY,) if by_day else (), {}
    rules = {name: F.count_if(bad) for name, bad in quality.silver_report_rules().items()}
    path = _replace(spark, silver, paths.silver, by, rules, counts)
    report = spark.createDataFrame(list(counts.items()), "rule string, n_bad long")
    overwrite_table(report.coalesce(1), paths.counts("silver"), "parquet")
    return read_table(spark, path, SILVER)


def silver_counts(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The quality report of the last full Silver build, without reading Silver."""
    return spark.read.parquet(paths.counts("silver"))


def stream_counts(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Quality counts that the Bronze stream took, over all its batches."""
    return read_counts(spark, paths.counts("bronze"))


def _with_days(df: DataFrame, name: str) -> DataFrame:
    if DAY not in df.columns:
        raise ValueError(f"{name} is not partitioned by {DAY}: rebuild it by day first")
    return df


def refresh_silver(spark: SparkSession, paths: LakePaths, days: list[date]) -> DataFrame:
    """Rebuild the Silver partitions of some start days, reading only those of Bronze.

    Duplicates share their start, so they share a day: the result equals a full
    rebuild as long as the reference has not changed. Both tables must be
    partitioned by day, which is checked. The refreshed days are a new run;
    readers see them all at once when it is published, and the other days stay
    where they are. Activities without a readable start have no day and wait
    for the next full rebuild.
    """
    _with_days(load(spark, paths.silver), "Silver")
    bronze = _with_days(load_bronze(spark, paths), "Bronze").filter(F.col(DAY).isin(*days))
    silver = to_silver(bronze.select(*BRONZE.fieldNames()), load_reference(spark, paths))
    silver = silver.withColumn(DAY, F.to_date("date_debut"))
    if lake_format(spark) == "delta":
        overwrite_partitions(silver, paths.silver, (DAY,))
    else:
        path = _new_run(paths.silver)
        overwrite_table(silver, path, partition_by=(DAY,))
        publish(spark, paths.silver, path, list(days))
        if len(versions(spark, paths.silver)) > FOLD_RUNS:
            _replace(spark, load(spark, paths.silver), paths.silver, (DAY,))
    return load(spark, paths.silver, SILVER)


def run_daily(spark: SparkSession, paths: LakePaths, days: list[date] | None = None) -> DataFrame:
    """Build the daily partials from Bronze, or replace those of some ``days``.

    A day is counted from its own rows, of which Bronze by day reads no others. A day that a replay
    or a late row has touched is replaced whole; the partitions of other days stay as they are.
    """
    bronze = load_bronze(spark, paths)
    if days is None:
        overwrite_table(daily.daily_partials(bronze), paths.daily, partition_by=(DAY,))
    else:
        bronze = _with_days(bronze, "Bronze").filter(F.col(DAY).isin(*days))
        overwrite_partitions(daily.daily_partials(bronze), paths.daily, (DAY,))
    return load_daily(spark, paths)


def load_daily(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return read_table(spark, paths.daily, DAILY)


def run_gold(
    spark: SparkSession,
    paths: LakePaths,
    as_of: date | None = None,
    rules: BusinessRules = BusinessRules(),
    export_columns: list[str] | None = None,
    export_files: int | None = None,
    from_bronze: bool = False,
    from_daily: bool = False,
) -> DataFrame:
    """Rebuild Gold, then export the stored table; the export does not recompute it.

    ``from_bronze`` counts straight from Bronze, which reads four columns and
    needs no Silver; ``from_daily`` adds up the daily partials, which reads no
    activity at all. The rows are the same.
    """
    reference = load_reference(spark, paths)
    if from_daily:
        made = daily.gold_from_daily(load_daily(spark, paths), reference, as_of, rules)
    elif from_bronze:
        made = gold.gold_from_bronze(load_bronze(spark, paths), reference, as_of, rules)
    else:
        made = gold.to_gold(load(spark, paths.silver), reference, as_of, rules)
    stored = read_table(spark, _replace(spark, made, paths.gold))
    export_csv(
        stored.select(*export_columns) if export_columns else stored, paths.export, export_files
    )
    return stored


def run_distances(spark: SparkSession, paths: LakePaths, from_daily: bool = False) -> DataFrame:
    """Store the metres covered per employee."""
    if from_daily:
        totals = daily.distances_from_daily(load_daily(spark, paths))
    else:
        totals = gold.distance_totals_from_bronze(load_bronze(spark, paths))
    return read_table(spark, _replace(spark, totals, paths.distances))


def clean_up(spark: SparkSession, paths: LakePaths, keep: int = 1) -> dict[str, list[str]]:
    """Delete runs that no reader can reach, except the ``keep`` newest of each table."""
    tables = (paths.reference, paths.silver, paths.gold, paths.distances, paths.compacted)
    gone = {table: retire_runs(spark, table, keep) for table in tables}
    return gone | {paths.lots: retire_lots(spark, paths.lots, paths.compacted_lots)}


def check_silver(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    silver = load(spark, paths.silver, SILVER)
    report = quality.silver_report(silver)
    return {
        "rapport": report,
        "bilan": quality.issue_total(report.filter(F.col("rule").isin(*quality.silver_rules()))),
        "alertes": quality.alert_split(silver),
        "fraudes": quality.flagged_activities(silver).orderBy("id_evenement").limit(5),
        "multiplicite": multiplicity(spark, paths),
    }


def multiplicity(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """What the joins with the reference do to the number of rows, told from key counts."""
    activities = load_bronze(spark, paths).select("id_salarie")
    reference = load_reference(spark, paths)
    lookups = {
        "silver": (reference_lookup(reference), "id_salarie_rh"),
        "gold": (reference, "employee_id"),
    }
    found = None
    for stage, (lookup, key) in lookups.items():
        total = keyed.fan_out_total(keyed.fan_out(activities, lookup, "id_salarie", key))
        total = total.select(F.lit(stage).alias("jointure"), "*")
        found = total if found is None else found.unionByName(total)
    return found


def check_gold(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    stored = read_table(spark, located(spark, paths.gold))
    reports = {
        "bilan": gold.financial_report(stored),
        "top": gold.most_active(stored),
        "rapport": quality.gold_report(stored),
    }
    if current_path(spark, paths.distances):
        totals = read_table(spark, located(spark, paths.distances))
        reports["distances"] = totals.orderBy(F.desc("distance_totale_metres"), "id_salarie").limit(10)
    return reports


def check_bronze(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    bronze = load_bronze(spark, paths).select(*BRONZE.fieldNames())
    return {
        "apercu": bronze.limit(20),
        "rapport": quality.bronze_report(bronze),
        "doublons": quality.duplicate_keys(bronze, "id"),
    }
