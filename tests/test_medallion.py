import json
from datetime import date

import pytest
from conftest import rows

from activlake import cli
from activlake.plans import medallion
from activlake.plans.medallion import LakePaths
from activlake.schemas import SILVER

HR = """ID salarié,Nom,Prénom,Salaire brut,Adresse du domicile,Moyen de déplacement
1,N1,P1,1000,"1, rue A",Marche/Running
2,N2,P2,2000,"2, rue B", vélo
3,N3,P3,,"3, rue C",VÉLO/Trottinette/Autres
"""
SPORT = """ID salarié,Pratique d'un sport
1,judo
2,
"""
START = 1743898597000000
DAY = 86400000000


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "hr.csv").write_text(HR, encoding="utf-8")
    (tmp_path / "sport.csv").write_text(SPORT, encoding="utf-8")
    return LakePaths(str(tmp_path / "lake")), tmp_path


def land(spark, folder, afters):
    texts = [json.dumps({"payload": {"after": a}}) for a in afters]
    spark.createDataFrame([(t.encode(),) for t in texts], "value binary").write.mode("append").parquet(folder)


def activity(i, who, day=0):
    return {"id": i, "id_salarie": who, "type_sport": "JUDO", "distance": 2500.0,
            "date_debut": START + day * DAY + who, "date_fin": START + day * DAY + 3600000000,
            "commentaire": "A - JUDO"}


def test_command_line_end_to_end(spark, lake):
    paths, tmp = lake
    root = ["--lake", paths.root, "--input-gb", "0.1"]
    cli.main([*root, "reference", "--hr", str(tmp / "hr.csv"), "--sport", str(tmp / "sport.csv")])
    inbox = str(tmp / "in")
    land(spark, inbox, [activity(i, 1, day=i) for i in range(16)])
    land(spark, inbox, [activity(100, 2), activity(101, 2), activity(102, 9)])
    for command in ("bronze", "notify"):
        cli.main([*root, command, "--source", inbox, "--trigger", "available"])
    cli.main([*root, "run", "--by-day"])
    for layer in ("bronze", "silver", "gold"):
        cli.main([*root, f"check-{layer}"])

    gold = medallion.read_table(spark, medallion.located(spark, paths.gold))
    assert rows(gold, "id_salarie", "nb_total_activites", "montant_prime_sportive",
                "eligible_jours_bien_etre") == [(1, 16, 50.0, True), (2, 1, 0.0, False)]
    exported = medallion.read_sheet(spark, paths.export)
    assert exported.columns == gold.columns and exported.count() == 2
    assert medallion.read_table(spark, paths.notifications).count() == 19
    reports = {k: rows(v) for k, v in medallion.check_silver(spark, paths).items()}
    assert ("salarie_absent_du_referentiel", 1) in reports["rapport"]
    assert reports["bilan"] == [(1, "ALERTE")]


def test_reference_reuses_known_distances(spark, lake):
    paths, tmp = lake
    sources = (str(tmp / "hr.csv"), str(tmp / "sport.csv"))
    ok = '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":%d}}]}]}'
    responses = spark.createDataFrame(
        [(1, ok % 4000), (2, ok % 26000)], "employee_id int, response string"
    )
    first = medallion.run_reference(spark, paths, *sources, responses=responses)
    distance = ("employee_id", "distance_domicile_entreprise_km", "erreur_declaration_transport")
    assert rows(first, *distance) == [(1, 4.0, False), (2, 26.0, True), (3, None, False)]
    second = medallion.run_reference(spark, paths, *sources)
    assert rows(second, *distance) == [(1, 4.0, False), (2, 26.0, True), (3, 12.5, False)]
    assert rows(medallion.load_reference(spark, paths)) == rows(second)


def test_refreshing_days_equals_a_full_rebuild(spark, lake):
    paths, tmp = lake
    medallion.run_reference(spark, paths, str(tmp / "hr.csv"), str(tmp / "sport.csv"))
    inbox = str(tmp / "in")

    def ingest():
        cli.main(["--lake", paths.root, "--input-gb", "1", "bronze", "--source", inbox, "--trigger", "available", "--by-day"])

    land(spark, inbox, [activity(1, 1, 0), activity(2, 2, 0), activity(3, 1, 1), activity(4, 3, 2)])
    ingest()
    medallion.run_silver(spark, paths, by_day=True)
    land(spark, inbox, [activity(0, 1, 0), activity(5, 3, 1), activity(6, 1, 1)])
    ingest()
    refreshed = rows(medallion.refresh_silver(spark, paths, [date(2025, 4, 6), date(2025, 4, 7)]))
    rebuilt = rows(medallion.run_silver(spark, paths, by_day=True), *SILVER.fieldNames())
    assert refreshed == rebuilt
    assert [r[0] for r in rebuilt] == [0, 2, 3, 4, 5]


def test_gold_of_the_last_year_and_chosen_columns(spark, lake):
    paths, tmp = lake
    medallion.run_reference(spark, paths, str(tmp / "hr.csv"), str(tmp / "sport.csv"))
    inbox = str(tmp / "in")
    land(spark, inbox, [activity(i, 1, day=i * 100) for i in range(5)])
    cli.main(["--lake", paths.root, "--input-gb", "1", "bronze", "--source", inbox, "--trigger", "available"])
    for by_day in (False, True):
        medallion.run_silver(spark, paths, by_day=by_day)
        gold = medallion.run_gold(
            spark, paths, as_of=date(2026, 5, 11), export_columns=["id_salarie", "nb_total_activites"]
        )
        assert rows(gold, "id_salarie", "nb_total_activites") == [(1, 4)]
    assert medallion.read_sheet(spark, paths.export).columns == ["id_salarie", "nb_total_activites"]


def stream(spark, paths, inbox, *options):
    cli.main(["--lake", paths.root, "--input-gb", "1", "bronze", "--source", inbox,
              "--trigger", "available", *options])


def test_refresh_refuses_tables_without_days(spark, lake):
    paths, tmp = lake
    medallion.run_reference(spark, paths, str(tmp / "hr.csv"), str(tmp / "sport.csv"))
    inbox = str(tmp / "in")
    land(spark, inbox, [activity(1, 1, 0), activity(2, 2, 1), activity(3, 3, 2)])
    stream(spark, paths, inbox, "--by-day")
    medallion.run_silver(spark, paths)
    with pytest.raises(ValueError, match="Silver"):
        medallion.refresh_silver(spark, paths, [date(2025, 4, 6)])
    assert medallion.load(spark, paths.silver).count() == 3


def test_a_reader_during_a_refresh_sees_one_version(spark, lake):
    paths, tmp = lake
    medallion.run_reference(spark, paths, str(tmp / "hr.csv"), str(tmp / "sport.csv"))
    inbox = str(tmp / "in")
    land(spark, inbox, [activity(1, 1, 0), activity(2, 2, 1)])
    stream(spark, paths, inbox, "--by-day")
    medallion.run_silver(spark, paths, by_day=True)
    reader = medallion.load(spark, paths.silver, SILVER)
    land(spark, inbox, [activity(3, 3, 0)])
    stream(spark, paths, inbox, "--by-day")
    after = medallion.refresh_silver(spark, paths, [date(2025, 4, 6)])
    assert sorted(r.id_evenement for r in reader.collect()) == [1, 2]
    assert sorted(r.id_evenement for r in after.collect()) == [1, 2, 3]
    assert medallion.load(spark, paths.silver, SILVER).count() == 3


def test_compacted_bronze_holds_late_days_too(spark, lake):
    paths, tmp = lake
    medallion.run_reference(spark, paths, str(tmp / "hr.csv"), str(tmp / "sport.csv"))
    inbox = str(tmp / "in")
    for i in range(4):
        land(spark, inbox, [activity(10 * i + d, 1 + d, d) for d in range(3)])
        stream(spark, paths, inbox, "--by-day")
    before = rows(medallion.load_bronze(spark, paths))
    path = medallion.compact_bronze(spark, paths, 1)
    days = list((tmp / "lake").joinpath(*path.split("/lake/")[1].split("/"), "table").glob("jour_debut=*"))
    assert len(days) == 3 and all(len(list(d.glob("*.parquet"))) == 1 for d in days)
    assert rows(medallion.load_bronze(spark, paths)) == before
    land(spark, inbox, [activity(99, 2, 1)])
    stream(spark, paths, inbox, "--by-day")
    assert medallion.load_bronze(spark, paths).count() == len(before) + 1
    medallion.compact_bronze(spark, paths, 1)
    assert medallion.load_bronze(spark, paths).count() == len(before) + 1
    assert medallion.run_silver(spark, paths, by_day=True).count() == 3  # four copies of each


def test_from_bodies_to_gold(spark, lake):
    paths, tmp = lake
    root = ["--lake", paths.root, "--input-gb", "0.1"]
    body = {"id_salarie": 3_000_000_001, "type_sport": "JUDO", "distance": 2500,
            "date_debut": "2025-04-06 00:16:37", "date_fin": "2025-04-06 01:16:37"}
    bodies = [(2**40, json.dumps(body)), (2, json.dumps({**body, "id_salarie": None})), (None, "x")]
    spark.createDataFrame(bodies, "id long, body string").write.parquet(str(tmp / "bodies"))
    ok = '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":4000}}]}]}'
    spark.createDataFrame([(3_000_000_001, ok)], "employee_id long, response string").write.parquet(
        str(tmp / "responses")
    )
    (tmp / "hr.csv").write_text(HR.replace("1,N1", "3000000001,N1"), encoding="utf-8")
    cli.main([*root, "create"])
    cli.main([*root, "ingest", "--bodies", str(tmp / "bodies")])
    cli.main([*root, "reference", "--hr", str(tmp / "hr.csv"), "--sport", str(tmp / "sport.csv"),
              "--responses", str(tmp / "responses")])
    stored = medallion.read_table(spark, paths.activities)
    assert rows(stored, "id", "id_salarie") == [(2**40, 3_000_000_001)]
    refused = medallion.read_table(spark, paths.refused)
    assert rows(refused, "id", "message") == [(None, "Invalid body"), (2, "Null value: id_salarie")]
    land(spark, str(tmp / "in"), [
        {**activity(r.id, 0), "id_salarie": r.id_salarie} for r in stored.collect()
    ])
    stream(spark, paths, str(tmp / "in"))
    cli.main([*root, "run"])
    direct = rows(medallion.load(spark, paths.gold))
    cli.main([*root, "gold", "--from-bronze", "--export-files", "1"])
    assert rows(medallion.load(spark, paths.gold)) == direct
    gold = medallion.load(spark, paths.gold).first()
    assert (gold.id_salarie, gold.distance_domicile_entreprise_km) == (3_000_000_001, 4.0)
    assert rows(medallion.check_gold(spark, paths)["distances"]) == [(3_000_000_001, 2500.0)]
    cli.main([*root, "clean", "--keep", "0"])
    assert rows(medallion.load(spark, paths.gold)) == direct
    assert len(list((tmp / "lake" / "gold" / "indicateurs_rh").glob("run=*"))) == 1


def test_requests_command_lists_what_the_last_reference_lacks(spark, lake):
    paths, tmp = lake
    root = ["--lake", paths.root, "--input-gb", "0.1"]
    cli.main([*root, "requests", "--hr", str(tmp / "hr.csv")])
    asked = medallion.load(spark, paths.requests)
    assert rows(asked, "domicile_address", "mode_trajet") == [
        ("1, rue A", "driving"), ("2, rue B", "bicycling"), ("3, rue C", "driving"),
    ]
    ok = '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":4000}}]}]}'
    answers = spark.createDataFrame([(1, ok)], "employee_id long, response string")
    medallion.run_reference(spark, paths, str(tmp / "hr.csv"), str(tmp / "sport.csv"), responses=answers)
    cli.main([*root, "requests", "--hr", str(tmp / "hr.csv")])
    assert rows(medallion.load(spark, paths.requests), "domicile_address") == [("2, rue B",), ("3, rue C",)]


def test_many_refreshes_are_folded(spark, lake, monkeypatch):
    paths, tmp = lake
    monkeypatch.setattr(medallion, "FOLD_RUNS", 2)
    medallion.run_reference(spark, paths, str(tmp / "hr.csv"), str(tmp / "sport.csv"))
    inbox = str(tmp / "in")
    land(spark, inbox, [activity(i, 1, i) for i in range(4)])
    stream(spark, paths, inbox, "--by-day")
    whole = rows(medallion.run_silver(spark, paths, by_day=True), *SILVER.fieldNames())
    for day in (6, 7, 8):
        got = medallion.refresh_silver(spark, paths, [date(2025, 4, day)])
        assert rows(got, *SILVER.fieldNames()) == whole
        assert len(medallion.versions(spark, paths.silver)) <= 2


def test_batches_daily_partials_and_lots_from_the_command_line(spark, lake):
    paths, tmp = lake
    root = ["--lake", paths.root, "--input-gb", "0.1"]
    cli.main([*root, "reference", "--hr", str(tmp / "hr.csv"), "--sport", str(tmp / "sport.csv")])
    inbox = str(tmp / "in")
    for i in range(3):
        land(spark, inbox, [activity(10 * i + d, 1 + d, d) for d in range(3)])
        stream(spark, paths, inbox, "--by-day", "--by-lot")
    cli.main([*root, "compact", "--files", "1"])
    cli.main([*root, "daily"])
    cli.main([*root, "gold", "--from-daily"])
    direct = rows(medallion.load(spark, paths.gold))
    assert len(direct) == 3
    cli.main([*root, "daily", "--days", "2025-04-06", "2025-04-07"])
    cli.main([*root, "gold", "--from-bronze"])
    assert rows(medallion.load(spark, paths.gold)) == direct
    cli.main([*root, "silver", "--by-day"])
    cli.main([*root, "check-silver"])
    assert rows(medallion.silver_counts(spark, paths)) == rows(
        medallion.check_silver(spark, paths)["rapport"]
    )
    cli.main([*root, "clean"])
    assert rows(medallion.load_bronze(spark, paths), "id") == [(i,) for i in sorted(
        [10 * i + d for i in range(3) for d in range(3)], key=str)]
