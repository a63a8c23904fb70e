from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from activlake.schemas import ACTIVITES, BRONZE, EMPLOYES
from activlake.session import lake_format
from activlake.sinks import tables as sinks
from activlake.sources import tables as sources

PEOPLE = "employee_id int, Nom string, salaire_brut double, domicile_address string, " \
    "moyen_transport string, pratique_sport string, distance_domicile_entreprise_km double, " \
    "erreur_declaration_transport boolean, `Code (secteur)` string"
AWKWARD = [
    (1, "Du\"pont", 1000.5, '12, rue "X"', " VÉLO ", "JUDO", 3.25, True, "a"),
    (2, "Le,Bon", None, "ligne 1\nligne 2", None, "AUCUN", None, False, "b"),
]


def test_reference_round_trip(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, PEOPLE)
    sinks.write_csv(df, str(tmp_path / "ref"))
    again = sources.read_reference(spark, str(tmp_path / "ref"), multiline=True)
    assert rows(again) == rows(df)
    assert dict(again.dtypes)["Code (secteur)"] == "string"


def test_reference_written_by_pandas(spark, tmp_path):
    path = tmp_path / "ref.csv"
    path.write_text(
        " employee_id ,Prénom,salaire_brut,domicile_address,moyen_transport,pratique_sport,"
        "distance_domicile_entreprise_km,erreur_declaration_transport\n"
        '7.0,Zoé,1000,"1, rue ""A""",VÉLO,JUDO,nan,True\n'
        "x,Ali,,,,,,False\n",
        encoding="utf-8",
    )
    assert rows(sources.read_reference(spark, str(path))) == [
        (None, "Ali", None, None, None, None, None, False),
        (7, "Zoé", 1000.0, '1, rue "A"', "VÉLO", "JUDO", None, True),
    ]


def test_sheets(spark, tmp_path):
    df = spark.createDataFrame([(1, "marche")], "`ID salarié` int, `Moyen de déplacement` string")
    df.write.parquet(str(tmp_path / "p"))
    sinks.write_csv(df, str(tmp_path / "c"))
    assert rows(sources.read_sheet(spark, str(tmp_path / "p"), "parquet")) == [(1, "marche")]
    assert rows(sources.read_sheet(spark, str(tmp_path / "c"))) == [("1", "marche")]


def test_distance_cache(spark, tmp_path):
    missing = sources.read_distance_cache(spark, str(tmp_path / "none"))
    assert missing.count() == 0
    assert missing.columns == ["employee_id", "distance_domicile_entreprise_km"]
    sinks.write_csv(spark.createDataFrame(AWKWARD, PEOPLE), str(tmp_path / "ref"))
    known = sources.read_distance_cache(spark, str(tmp_path / "ref"), multiline=True)
    assert rows(known) == [(1, 3.25), (2, None)]


def test_one_large_csv_is_read_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "big")
    sinks.write_csv(spark.range(200_000).selectExpr("id AS employee_id", "'x' AS Nom").coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert sources.read_sheet(spark, path).rdd.getNumPartitions() > 3
        assert sources.read_reference(spark, path).rdd.getNumPartitions() > 3
        assert sources.read_sheet(spark, path, multiline=True).rdd.getNumPartitions() == 1
        assert sources.read_reference(spark, path).count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_overwrite_may_change_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_table(spark.range(3), path)
    sinks.overwrite_table(spark.range(2).selectExpr("id AS other", "'x' AS text"), path)
    assert rows(sources.read_table(spark, path)) == [(0, "x"), (1, "x")]
    assert lake_format(spark) == "parquet"


def test_overwrite_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, day string")
    sinks.overwrite_table(first, path, partition_by=("day",))
    sinks.overwrite_partitions(
        spark.createDataFrame([(9, "b")], "id int, day string"), path, ("day",)
    )
    assert rows(sources.read_table(spark, path), "id", "day") == [(1, "a"), (9, "b")]
    # A full overwrite drops the partitions it does not mention.
    sinks.overwrite_table(
        spark.createDataFrame([(5, "c")], "id int, day string"), path, partition_by=("day",)
    )
    assert rows(sources.read_table(spark, path), "id", "day") == [(5, "c")]


def test_partitioned_table_reads_back_with_its_contract(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.createDataFrame([(1, 7, "J", 1.0, "0", "1", "c", 1)], BRONZE)
    sinks.overwrite_table(df.withColumn("jour_debut", F.lit("2025-01-01")), path, partition_by=("jour_debut",))
    assert sources.read_table(spark, path, BRONZE).columns == BRONZE.fieldNames()


def test_create_table_if_absent(spark, tmp_path):
    for name, schema in (("e", EMPLOYES), ("a", ACTIVITES)):
        path = str(tmp_path / name)
        sinks.create_table(spark, path, schema)
        assert sources.read_table(spark, path).columns == schema.fieldNames()
    path = str(tmp_path / "e")
    row = spark.createDataFrame([(1, *[None] * 7)], EMPLOYES)
    sinks.append_table(row, path)
    sinks.create_table(spark, path, EMPLOYES)
    assert sources.read_table(spark, path).count() == 1


@pytest.mark.parametrize("asked, files", [(None, 3), (1, 1), (4, 4)])
def test_export_files_are_the_callers_choice(spark, tmp_path, asked, files):
    path = tmp_path / f"export{asked}"
    sinks.export_csv(spark.range(0, 100, 1, 3), str(path), asked)
    assert len(list(path.glob("*.csv"))) == files
    assert sources.read_csv(spark, str(path)).count() == 100


def test_compaction(spark, tmp_path):
    many = spark.range(0, 50, 1, 10)
    sinks.compact_table(many, str(tmp_path / "few"), 2)
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 2
    assert sources.read_table(spark, str(tmp_path / "few")).count() == 50


def test_compaction_keeps_the_partitions(spark, tmp_path):
    days = spark.range(0, 300, 1, 10).selectExpr("id", "if(id < 200, 0, id % 3) AS day")
    sinks.compact_table(days, str(tmp_path / "few"), 2, ("day",))
    per_day = [len(list(d.glob("*.parquet"))) for d in (tmp_path / "few").glob("day=*")]
    assert len(per_day) == 3 and max(per_day) <= 2
    assert rows(sources.read_table(spark, str(tmp_path / "few"))) == rows(days)


def test_versions_of_days(spark, tmp_path):
    table, first, second = str(tmp_path / "t"), date(2025, 1, 1), date(2025, 1, 2)
    shape = "id long, day date"

    def run(name, data, days=None):
        path = f"{table}/run={name}"
        sinks.overwrite_table(spark.createDataFrame(data, shape), path, partition_by=("day",))
        sinks.publish(spark, table, path, days)

    run("a", [(1, first), (2, second), (3, None)])
    before = sinks.read_current(spark, table, day="day")
    run("b", [(20, second)], [second])
    assert rows(before) == [(1, first), (2, second), (3, None)]  # a reader of the older version
    current = sinks.read_current(spark, table, day="day")
    assert rows(current) == [(1, first), (20, second), (3, None)]
    run("c", [], [first])
    assert rows(sinks.read_current(spark, table, day="day")) == [(20, second), (3, None)]
    assert sinks.retire_runs(spark, table, keep=0) == []
    run("d", [(9, first)])
    assert rows(sinks.read_current(spark, table, day="day")) == [(9, first)]
    assert sinks.retire_runs(spark, table, keep=1) == ["run=a", "run=b"]
    assert rows(sinks.read_current(spark, table, day="day")) == [(9, first)]


def test_publish_switches_readers(spark, tmp_path):
    table = str(tmp_path / "t")
    assert sinks.current_path(spark, table) is None
    for run in ("a", "b"):
        sinks.publish(spark, table, f"{table}/run={run}")
        assert sinks.current_path(spark, table) == f"{table}/run={run}"


def test_preview(spark):
    assert rows(sources.preview(spark.range(100), 3, "id")) == [(0,), (1,), (2,)]
    assert sources.preview(spark.range(100), 3).count() == 3


def test_runs_whose_schema_changed_are_merged_by_name(spark, tmp_path):
    table, first, second, third = str(tmp_path / "t"), *(date(2025, 1, d) for d in (1, 2, 3))

    def run(name, data, shape, days=None):
        path = f"{table}/run={name}"
        sinks.overwrite_table(spark.createDataFrame(data, shape), path, partition_by=("day",))
        sinks.publish(spark, table, path, days)

    run("a", [(1, 1.5, "x", first), (2, 2.5, "y", second)], "id int, km float, gone string, day date")
    run("b", [(2**40, 0.1, "new", second)], "id long, km double, note string, day date", [second])
    run("c", [], "id long, km double, note string, day date", [third])
    current = sinks.read_current(spark, table, day="day")
    assert dict(current.dtypes) == {
        "id": "bigint", "km": "double", "gone": "string", "note": "string", "day": "date",
    }
    assert rows(current, "id", "km", "gone", "note", "day") == [
        (1, 1.5, "x", None, first), (2**40, 0.1, None, "new", second),
    ]
    run("d", [([1], 1.0, third)], "id array<int>, km double, day date", [third])
    with pytest.raises(Exception, match="INCOMPATIBLE_COLUMN_TYPE"):
        sinks.read_current(spark, table, day="day").collect()


def test_counts_taken_in_a_write(spark, tmp_path):
    df = spark.range(0, 100, 1, 5).selectExpr("id", "id % 4 AS part")
    rules = {"odd": F.count_if(F.col("id") % 2 == 1), "all": F.count(F.lit(1))}
    for by in ((), ("part",)):
        found = sinks.overwrite_table(df, str(tmp_path / f"t{len(by)}"), "parquet", by, rules)
        assert found == {"odd": 50, "all": 100}
    assert sinks.overwrite_table(df.limit(0), str(tmp_path / "e"), "parquet", (), rules)["all"] == 0
    assert sinks.overwrite_table(df, str(tmp_path / "n"), "parquet") == {}
