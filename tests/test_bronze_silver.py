import json
from datetime import datetime

from conftest import plan_of, rows
from pyspark.sql import functions as F

from activlake.operators import silver
from activlake.operators.bronze import decode_envelopes, to_bronze, with_start_day
from activlake.schemas import BRONZE, SILVER

AFTER = {
    "id": 1, "id_salarie": 7, "type_sport": "JUDO", "distance": 2500.5,
    "date_debut": 1743898597000000, "date_fin": 1743899995000000, "commentaire": "A B - JUDO",
}
# Recovered activities: id, employee, sport, metres, start, end, seconds -> start, end, minutes.
GOLDEN = [
    (3666, 39874, "TENNIS", 7243.0, 1743898597000000, 1743899995000000, 1398,
     datetime(2025, 4, 6, 0, 16, 37), datetime(2025, 4, 6, 0, 39, 55), 23),
    (3671, 50955, "RUGBY", 11296.0, 1762681912000000, 1762689094000000, 7182,
     datetime(2025, 11, 9, 9, 51, 52), datetime(2025, 11, 9, 11, 51, 34), 119),
    (3712, 46253, "RANDONNÉE", 4356.0, 1755673505000000, 1755676317000000, 2812,
     datetime(2025, 8, 20, 7, 5, 5), datetime(2025, 8, 20, 7, 51, 57), 46),
    (3715, 34922, "TENNIS", 2775.0, 1747207188000000, 1747209863000000, 2675,
     datetime(2025, 5, 14, 7, 19, 48), datetime(2025, 5, 14, 8, 4, 23), 44),
]


def envelope(op="c", **changes):
    return json.dumps({"payload": {"before": None, "after": {**AFTER, **changes}, "op": op}})


def messages(spark, *texts):
    return spark.createDataFrame([(t.encode() if t is not None else None,) for t in texts], "value binary")


def reference(spark, *people):
    return spark.createDataFrame(
        list(people),
        "employee_id int, moyen_transport string, distance_domicile_entreprise_km double, "
        "erreur_declaration_transport boolean",
    )


def activities(spark, *values):
    return spark.createDataFrame(list(values), BRONZE)


def test_cdc_edges(spark):
    texts = [
        envelope(),
        envelope("u", id=2, date_fin="soon"),
        envelope("r", id=3, distance="far"),
        envelope(id="x"),
        envelope(id=None),
        '{"payload": {"after": null, "op": "d"}}',
        '{"payload": {}}',
        "{}",
        "garbage",
        None,
    ]
    bronze = to_bronze(messages(spark, *texts))
    assert bronze.schema == BRONZE
    assert rows(bronze, "id", "distance", "date_fin", "duration_sec") == [
        (1, 2500.5, "1743899995000000", 1398),
        (2, 2500.5, "soon", None),
        (3, None, "1743899995000000", 1398),
    ]
    assert decode_envelopes(messages(spark, *texts)).count() == 3
    assert rows(with_start_day(bronze).select(F.col("jour_debut").cast("string")).distinct()) == [
        ("2025-04-06",)
    ]


def test_golden_rows(spark):
    texts = [
        envelope(id=i, id_salarie=s, type_sport=t, distance=d, date_debut=a, date_fin=b)
        for i, s, t, d, a, b, *_ in GOLDEN
    ]
    bronze = to_bronze(messages(spark, *texts))
    assert rows(bronze, "id", "duration_sec") == [(g[0], g[6]) for g in GOLDEN]
    result = silver.to_silver(bronze, reference(spark))
    got = rows(
        result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("date_debut", "date_fin")}),
        "id_evenement", "id_salarie", "type_sport", "distance_metres", "date_debut", "date_fin",
        "duration_min",
    )
    assert got == [(*g[:4], *g[7:]) for g in GOLDEN]


def test_silver_schema_and_fills(spark):
    bronze = activities(
        spark,
        (1, 7, "JUDO", None, "1743898597000000", "x", "c", None),
        (2, 8, "BOXE", float("nan"), "y", "1743898597000000", "c", 61),
        (3, 9, "BOXE", 5.0, None, None, None, -61),
    )
    people = reference(spark, (7, "MARCHE", 20.0, True), (8, None, None, None))
    result = silver.to_silver(bronze, people)
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in SILVER]
    assert rows(
        result, "id_evenement", "distance_metres", "duration_min", "mode_transport_declare",
        "distance_domicile_travail_km", "alerte_transport",
    ) == [
        (1, 0.0, 0, "MARCHE", 20.0, "FRAUDE"),
        (2, 0.0, 1, None, None, "OK"),
        (3, 5.0, -1, None, None, "INCONNU"),
    ]


def test_dedup_keeps_lowest_id(spark):
    bronze = activities(
        spark,
        (2, 7, "JUDO", 1.0, "5", "6", "b", 1),
        (1, 7, "JUDO", 2.0, "5", "7", "a", 2),
        (3, 7, "BOXE", 3.0, "5", "6", "c", 1),
        (4, None, None, 3.0, None, "6", "c", 1),
        (5, None, None, 3.0, None, "6", "c", 1),
        (6, 7, "JUDO", 9.0, "8", "9", "z", 1),
        (6, 7, "JUDO", 4.0, "8", "9", "z", 1),
    )
    unique = silver.unique_activities(bronze)
    assert unique.columns == bronze.columns
    assert rows(unique, "id", "distance") == [(1, 2.0), (3, 3.0), (4, 3.0), (6, 4.0)]


def test_join_multiplies_on_different_reference_rows(spark):
    bronze = activities(spark, (1, 7, "JUDO", 1.0, "5", "6", "b", 1))
    people = reference(
        spark, (7, "VÉLO", 1.0, False), (7, "VÉLO", 1.0, False), (7, "VÉLO", 30.0, True)
    )
    assert rows(silver.to_silver(bronze, people), "alerte_transport") == [("FRAUDE",), ("OK",)]


def test_text_reference_is_typed(spark):
    people = spark.createDataFrame(
        [("7.0", "VÉLO", "nan", "True"), ("x", "VÉLO", "3", "False"), (None, "A", None, None)],
        "employee_id string, moyen_transport string, distance_domicile_entreprise_km string, "
        "erreur_declaration_transport string",
    )
    assert rows(silver.reference_lookup(people)) == [
        (None, "A", None, "OK"), (None, "VÉLO", 3.0, "OK"), (7, "VÉLO", None, "FRAUDE")
    ]


def test_copies_combine_before_the_shuffle(spark):
    bronze = spark.range(0, 1000, 1, 4).select(
        F.col("id").cast("int").alias("id"), F.lit(7).alias("id_salarie"),
        F.lit("JUDO").alias("type_sport"), F.lit(1.0).alias("distance"),
        F.lit("5").alias("date_debut"), F.lit("6").alias("date_fin"), F.lit("c").alias("commentaire"),
        F.lit(1).cast("bigint").alias("duration_sec"),
    )
    unique = silver.unique_activities(bronze)
    assert [r.id for r in unique.collect()] == [0]
    assert "partial_min" in plan_of(unique)


def test_hot_employee_is_split_when_the_join_shuffles(spark):
    """With broadcasting off, one employee with most rows is spread over several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "8",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        bronze = spark.range(0, 40000, 1, 8).select(
            F.col("id").cast("int").alias("id"),
            F.when(F.col("id") < 30000, 7).otherwise(F.col("id") % 500).cast("int").alias("id_salarie"),
            F.lit("JUDO").alias("type_sport"), F.lit(1.0).alias("distance"),
            F.col("id").cast("string").alias("date_debut"), F.lit("6").alias("date_fin"),
            F.sha2(F.col("id").cast("string"), 256).alias("commentaire"),
            F.lit(60).cast("bigint").alias("duration_sec"),
        )
        people = spark.range(0, 400).select(
            F.col("id").cast("int").alias("employee_id"), F.lit("VÉLO").alias("moyen_transport"),
            F.lit(1.0).alias("distance_domicile_entreprise_km"),
            F.lit(False).alias("erreur_declaration_transport"),
        )
        result = silver.to_silver(bronze, people)
        assert len(result.collect()) == 40000
        assert "skew=true" in plan_of(result)
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
