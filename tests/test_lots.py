"""Bronze in a folder per batch: replays, compaction and counts taken in the write."""

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from activlake.operators import quality
from activlake.operators.bronze import to_bronze
from activlake.plans import medallion
from activlake.plans.medallion import LakePaths
from activlake.schemas import BRONZE
from activlake.sinks import lots
from activlake.sinks.lots import lot_counts
from activlake.sinks.tables import overwrite_table, publish
from activlake.sources.cdc import read_cdc_files
from activlake.streaming import start_bronze_lots

START, DAY = 1743898597000000, 86400000000


def land(spark, folder, first, last):
    texts = [
        json.dumps({"payload": {"after": {
            "id": i, "id_salarie": i % 3, "type_sport": "JUDO", "distance": 100.0 * i,
            "date_debut": START + (i % 4) * DAY, "date_fin": START + (i % 4) * DAY + 1800000000 + i % 2}}})
        for i in range(first, last)
    ] + ["garbage", None]
    df = spark.createDataFrame([(t and t.encode(),) for t in texts], "value binary")
    df.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def lake(tmp_path):
    return LakePaths(str(tmp_path / "lake")), str(tmp_path / "in"), tmp_path


def drain(spark, paths, inbox, by_day=True):
    rules = {name: F.count_if(bad) for name, bad in quality.generator_rules().items()}
    start_bronze_lots(
        read_cdc_files(spark, inbox, max_files_per_trigger=1), paths.lots, paths.checkpoint("lots"),
        "available", by_day, counts=rules, counted=lot_counts(paths.counts("bronze")),
    ).awaitTermination()


def bronze(spark, paths):
    return rows(medallion.load_bronze(spark, paths), *BRONZE.fieldNames())


def lot_folders(paths):
    return sorted(Path(paths.lots).glob("requete=*/lot=*"))


@pytest.mark.parametrize("by_day", [False, True])
def test_a_crash_between_data_and_commit_leaves_no_copies(spark, lake, by_day):
    paths, inbox, tmp = lake
    for i in range(3):
        land(spark, inbox, 10 * i, 10 * i + 10)
    drain(spark, paths, inbox, by_day)
    want = rows(to_bronze(spark.read.parquet(inbox)))
    assert bronze(spark, paths) == want and len(lot_folders(paths)) == 3
    # The last batch wrote its rows, but its commit was lost: it runs again.
    commits = Path(paths.checkpoint("lots"), "commits")
    (commits / "2").unlink()
    (commits / ".2.crc").unlink(missing_ok=True)
    drain(spark, paths, inbox, by_day)
    assert (commits / "2").exists()
    assert bronze(spark, paths) == want and len(lot_folders(paths)) == 3
    # A crash amid the write leaves files of an attempt that never ended: they are replaced.
    (commits / "2").unlink()
    (commits / ".2.crc").unlink(missing_ok=True)
    stray = next(lot_folders(paths)[-1].rglob("*.parquet"))
    stray.with_name("part-99999-stray.snappy.parquet").write_bytes(stray.read_bytes())
    drain(spark, paths, inbox, by_day)
    assert bronze(spark, paths) == want
    counted = rows(medallion.stream_counts(spark, paths))
    report = quality.bronze_report(medallion.load_bronze(spark, paths))
    assert counted == rows(report)


def test_a_new_checkpoint_does_not_touch_older_lots(spark, lake):
    paths, inbox, tmp = lake
    land(spark, inbox, 0, 5)
    drain(spark, paths, inbox)
    start_bronze_lots(
        read_cdc_files(spark, inbox), paths.lots, paths.checkpoint("other"), "available", True
    ).awaitTermination()
    assert len(bronze(spark, paths)) == 10 and len(list(Path(paths.lots).glob("requete=*"))) == 2


def opened(df):
    return sorted(df.inputFiles())


def test_compaction_lowers_what_readers_open(spark, lake):
    paths, inbox, tmp = lake
    for i in range(6):
        land(spark, inbox, 10 * i, 10 * i + 10)
    drain(spark, paths, inbox)
    want, before = bronze(spark, paths), opened(medallion.load_bronze(spark, paths))
    assert len(before) >= 24
    medallion.compact_bronze(spark, paths, 1)
    after = opened(medallion.load_bronze(spark, paths))
    # Four days of the five closed lots, and the small files of the open one.
    assert len([f for f in after if "compacted_lots" in f]) == 4
    assert len([f for f in after if "lot=5" in f]) == len(after) - 4
    assert bronze(spark, paths) == want
    assert medallion.compact_bronze(spark, paths, 1) and opened(medallion.load_bronze(spark, paths)) == after
    # Rows are merged once: the next range holds the newly closed lots only.
    land(spark, inbox, 60, 70)
    land(spark, inbox, 70, 80)
    drain(spark, paths, inbox)
    medallion.compact_bronze(spark, paths, 1)
    ranges = sorted(p.name for p in Path(paths.compacted_lots).glob("requete=*/jusqu_a=*"))
    assert ranges == ["jusqu_a=4", "jusqu_a=6"]
    assert bronze(spark, paths) == rows(to_bronze(spark.read.parquet(inbox)))
    gone = medallion.clean_up(spark, paths)[paths.lots]
    assert len(gone) == 7 and len(lot_folders(paths)) == 1
    assert len(bronze(spark, paths)) == 80


def test_an_unfinished_range_is_invisible_and_replaced(spark, lake):
    paths, inbox, tmp = lake
    for i in range(3):
        land(spark, inbox, 10 * i, 10 * i + 10)
    drain(spark, paths, inbox)
    want = bronze(spark, paths)
    medallion.compact_bronze(spark, paths, 1)
    mark = next(Path(paths.compacted_lots).glob("requete=*/jusqu_a=1/_SUCCESS"))
    mark.unlink()
    assert lots.ranges(spark, paths.compacted_lots) == {mark.parts[-3].partition("=")[2]: []}
    assert bronze(spark, paths) == want
    assert lots.retire_lots(spark, paths.lots, paths.compacted_lots) == []
    medallion.compact_bronze(spark, paths, 1)
    assert mark.exists() and bronze(spark, paths) == want


def test_silver_and_gold_from_lots(spark, lake):
    paths, inbox, tmp = lake
    people = spark.createDataFrame(
        [(i, "VÉLO", 3.0, False, 100.0) for i in range(3)],
        "employee_id long, moyen_transport string, distance_domicile_entreprise_km double, "
        "erreur_declaration_transport boolean, salaire_brut double",
    )
    overwrite_table(people, f"{paths.reference}/run=0/table", "parquet")
    publish(spark, paths.reference, f"{paths.reference}/run=0")
    land(spark, inbox, 0, 30)
    land(spark, inbox, 30, 40)
    drain(spark, paths, inbox)
    medallion.compact_bronze(spark, paths, 1)
    silver = medallion.run_silver(spark, paths, by_day=True)
    assert silver.count() == 12
    assert rows(medallion.run_daily(spark, paths).selectExpr("sum(activities)")) == [(12,)]
    assert medallion.run_gold(spark, paths, from_daily=True).count() == 3
    assert rows(medallion.multiplicity(spark, paths)) == [("gold", 40, 40, 0, 0), ("silver", 40, 40, 0, 0)]


def scans(spark, action, path):
    """How many of the statements that ``action`` runs read ``path``."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    action()
    found = [store.executionsList().apply(int(i)) for i in range(before, store.executionsCount())]
    plans = [e.physicalPlanDescription() for e in found]
    return sum(f"Location: InMemoryFileIndex [file:{path}" in p for p in plans)


@pytest.mark.parametrize("by_day", [False, True])
def test_the_report_costs_no_second_scan(spark, lake, by_day):
    paths, inbox, tmp = lake
    people = spark.createDataFrame(
        [(1, "VÉLO", 3.0, True)],
        "employee_id long, moyen_transport string, distance_domicile_entreprise_km double, "
        "erreur_declaration_transport boolean",
    )
    overwrite_table(people, f"{paths.reference}/run=0/table", "parquet")
    publish(spark, paths.reference, f"{paths.reference}/run=0")
    data = [(i, i % 3 or None, None if i % 5 == 0 else "J", float(i - 4), str(START + i * DAY),
             str(START + i * DAY - 2 + i % 4), "c", 1) for i in range(40)]
    overwrite_table(spark.createDataFrame(data, BRONZE), paths.bronze, "parquet")
    assert scans(spark, lambda: medallion.run_silver(spark, paths, by_day), paths.bronze) == 1
    counts = medallion.silver_counts(spark, paths)
    assert scans(spark, counts.collect, paths.silver) == 0
    assert rows(counts) == rows(quality.silver_report(medallion.load(spark, paths.silver)))
