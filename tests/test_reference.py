import math

from conftest import rows

from activlake.operators import reference as ref
from activlake.rules import BusinessRules

HR = "`ID salarié` int, Nom string, `Prénom` string, `Salaire brut` double, `Adresse du domicile` string, `Moyen de déplacement` string"
SPORT = "`ID salarié` int, `Pratique d'un sport` string"
CACHE = "employee_id int, distance_domicile_entreprise_km double"


def hr(spark, *people):
    return spark.createDataFrame(
        [(i, f"N{i}", f"P{i}", 1000.0 * (i or 0), f"rue {i}", mode) for i, mode in people], HR
    )


def test_clean_and_merge(spark):
    people = hr(spark, (1, " marche "), (2, "Vélo"), (3, None))
    sport = spark.createDataFrame([(1, " judo "), (2, None)], SPORT)
    merged = ref.merge_sources(ref.clean_hr(people), ref.clean_sport(sport))
    assert rows(merged, "employee_id", "moyen_transport", "pratique_sport") == [
        (1, "MARCHE", "JUDO"),
        (2, "VÉLO", "AUCUN"),
        (3, None, "AUCUN"),
    ]


def test_merge_keeps_every_sport_row_and_suffixes_clashes(spark):
    people = hr(spark, (1, "VÉLO")).withColumnsRenamed({"Nom": "note"})
    sport = spark.createDataFrame(
        [(1, "JUDO", "a"), (1, "BOXE", "b")], SPORT + ", note string"
    )
    merged = ref.merge_sources(ref.clean_hr(people), ref.clean_sport(sport))
    assert merged.count() == 2
    assert {"note_x", "note_y"} <= set(merged.columns)


def test_distance_order(spark):
    people = ref.clean_hr(hr(spark, *[(i, "MARCHE") for i in range(1, 6)]))
    cache = spark.createDataFrame(
        [(1, 3.0), (1, 5.0), (1, None), (2, math.nan), (3, None), (None, 8.0)], CACHE
    )
    ok = '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":%d}}]}]}'
    responses = spark.createDataFrame(
        [(1, ok % 9000), (2, ok % 16000), (4, '{"status":"DENIED"}')],
        "employee_id int, response string",
    )
    simulated = ref.with_distance(people, cache)
    assert rows(simulated, "employee_id", ref.DISTANCE) == [
        (1, 5.0), (2, 12.5), (3, 12.5), (4, 12.5), (5, 12.5)
    ]
    provided = ref.with_distance(people, cache, responses)
    assert rows(provided, "employee_id", ref.DISTANCE) == [
        (1, 5.0), (2, 16.0), (3, None), (4, None), (5, None)
    ]
    assert rows(ref.with_distance(people), ref.DISTANCE) == [(12.5,)] * 5
    flagged = ref.flag_declarations(provided)
    assert rows(flagged.filter("erreur_declaration_transport"), "employee_id") == [(2,)]


def test_default_distance_flags_nobody(spark):
    built = ref.build_reference(
        hr(spark, (1, "marche"), (2, "vélo"), (3, "voiture")),
        spark.createDataFrame([(1, "JUDO")], SPORT),
    )
    assert tuple(ref.anomaly_count(built).first()) == (3, 0)
    assert built.columns == [
        "employee_id", "Nom", "Prénom", "salaire_brut", "domicile_address", "moyen_transport",
        "pratique_sport", ref.DISTANCE, "erreur_declaration_transport",
    ]


def test_limits_are_parameters(spark):
    strict = BusinessRules(walk_limit_km=10.0)
    built = ref.build_reference(
        hr(spark, (1, "marche"), (2, "vélo")),
        spark.createDataFrame([(1, "JUDO")], SPORT),
        rules=strict,
    )
    assert tuple(ref.anomaly_count(built).first()) == (2, 1)


def test_modes_and_athletes(spark):
    people = ref.clean_hr(hr(spark, (1, "marche"), (2, "MARCHE "), (3, "bus")))
    assert rows(ref.transport_modes(people)) == [("BUS", "driving"), ("MARCHE", "walking")]
    sports = spark.createDataFrame([(1, " aucun "), (2, "JUDO"), (3, None)], "id int, pratique_sport string")
    assert rows(ref.declared_athletes(sports), "id") == [(2,)]


def test_merge_with_a_hot_employee_on_each_side(spark):
    from pyspark.sql import functions as F

    people = hr(spark, (1, "VÉLO"), (2, "VÉLO"), (None, "VÉLO"))
    sport = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).cast("int").alias("ID salarié"),
        F.col("id").cast("string").alias("Pratique d'un sport"),
    )
    merged = ref.merge_sources(ref.clean_hr(people), ref.clean_sport(sport))
    counts = merged.groupBy("employee_id").agg(
        F.count("*"), F.count_if(F.col("pratique_sport") == "AUCUN")
    )
    assert rows(counts) == [(None, 1, 1), (1, 2000, 0), (2, 1, 1)]


def test_requests_are_asked_once_and_answers_reach_everyone(spark):
    shape = "employee_id long, domicile_address string, moyen_transport string"
    people = spark.createDataFrame(
        [(i, "1, rue A", "VÉLO") for i in range(20)]  # one address for most
        + [(20, "1, rue A", "MARCHE"), (21, "2, rue B", "VOITURE"), (22, "2, rue B", "BUS"), (23, None, "VÉLO")],
        shape,
    )
    cache = spark.createDataFrame(
        [(0, 3.0), (0, None), (21, None), (None, 1.0)], "employee_id long, distance_domicile_entreprise_km double"
    )
    requests = ref.distance_requests(people, cache)
    assert rows(requests) == [
        ("1, rue A", "bicycling", 19), ("1, rue A", "walking", 1), ("2, rue B", "driving", 2),
    ]
    assert ref.distance_requests(people).where("nb_salaries = 20").count() == 1
    ok = '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":%d}}]}]}'
    answers = spark.createDataFrame(
        [("1, rue A", "bicycling", ok % 4000), ("2, rue B", "driving", '{"status":"DENIED"}')],
        "domicile_address string, mode_trajet string, response string",
    )
    responses = ref.responses_of_answers(people, answers)
    assert responses.count() == 22
    known = ref.with_distance(people, cache, responses)
    got = dict(rows(known, "employee_id", "distance_domicile_entreprise_km"))
    assert got == {0: 3.0, **{i: 4.0 for i in range(1, 20)}, 20: None, 21: None, 22: None, 23: None}
    # What was not answered is asked again.
    again = known.select("employee_id", "distance_domicile_entreprise_km")
    assert rows(ref.distance_requests(people, again)) == [
        ("1, rue A", "walking", 1), ("2, rue B", "driving", 2),
    ]
