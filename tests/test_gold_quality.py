from datetime import date

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from activlake.operators import gold, quality, silver
from activlake.rules import BusinessRules, GeneratorBounds
from activlake.schemas import BRONZE, SILVER

PEOPLE = "employee_id int, `Prénom` string, salaire_brut double, moyen_transport string, " \
    "distance_domicile_entreprise_km double, erreur_declaration_transport boolean"


def people(spark, *values):
    return spark.createDataFrame(list(values), PEOPLE)


def silver_rows(spark, *values):
    """(event, employee, metres, start, alert) with the other columns fixed."""
    df = spark.createDataFrame(
        list(values), "id int, who int, m double, start string, alert string"
    )
    return df.select(
        F.col("id").alias("id_evenement"), F.col("who").alias("id_salarie"),
        F.lit("JUDO").alias("type_sport"), F.col("m").alias("distance_metres"),
        F.lit(1).alias("duration_min"), F.col("start").cast("timestamp").alias("date_debut"),
        F.col("start").cast("timestamp").alias("date_fin"), F.lit("X").alias("mode_transport_declare"),
        F.lit(1.0).alias("distance_domicile_travail_km"), F.col("alert").alias("alerte_transport"),
        F.lit("c").alias("commentaire"),
    )


def many(spark, who, n, alert="OK"):
    return [(who * 1000 + i, who, 10.0, "2025-05-01", alert) for i in range(n)]


def test_indicators(spark):
    done = silver_rows(
        spark, *many(spark, 1, 14), *many(spark, 2, 15, "FRAUDE"), *many(spark, 3, 1),
        *many(spark, 4, 2), *many(spark, 9, 3, "INCONNU"), (99, None, 1.0, "2025-05-01", "INCONNU"),
    )
    staff = people(
        spark,
        (1, "A", 1000.0, "VÉLO/TROTTINETTE/AUTRES", 1.0, False),
        (2, "B", 2000.0, "MARCHE/RUNNING", 1.0, True),
        (3, "C", 3000.0, "VOITURE", 1.0, False),
        (4, "D", None, "MARCHE/RUNNING", 1.0, False),
        (5, "E", 500.0, "MARCHE/RUNNING", 1.0, False),
    )
    result = gold.to_gold(done, staff)
    assert rows(
        result, "id_salarie", "nb_total_activites", "nb_activites_valides",
        "montant_prime_sportive", "eligible_jours_bien_etre",
    ) == [
        (1, 14, 14, 50.0, False),
        (2, 15, 0, 100.0, True),
        (3, 1, 1, 0.0, False),
        (4, 2, 2, None, False),
    ]
    assert result.columns == [
        "id_salarie", "nb_total_activites", "nb_activites_valides", "employee_id", "prenom",
        "salaire_brut", "moyen_transport", "distance_domicile_entreprise_km",
        "erreur_declaration_transport", "montant_prime_sportive", "eligible_jours_bien_etre",
    ]
    assert tuple(gold.financial_report(result).first()) == (4, 2, 1, 150.0)
    assert [r.id_salarie for r in gold.most_active(result, 3).collect()] == [2, 1, 4]
    assert rows(quality.gold_report(result)) == [("id_salarie_null", 0)]


def test_reference_rows_are_not_deduplicated(spark):
    staff = people(spark, (1, "A", 1.0, "X", 1.0, False), (1, "B", 2.0, "X", 1.0, False))
    assert gold.to_gold(silver_rows(spark, *many(spark, 1, 2)), staff).count() == 2


def test_empty_gold(spark):
    empty = gold.to_gold(spark.createDataFrame([], SILVER), people(spark))
    assert tuple(gold.financial_report(empty).first()) == (0, 0, 0, 0.0)


def test_rolling_year(spark):
    done = silver_rows(
        spark, (1, 1, 1.0, "2024-04-30 23:59:59", "OK"), (2, 1, 1.0, "2024-05-01", "OK"),
        (3, 1, 1.0, "2025-05-01", "OK"), (4, 1, 1.0, None, "OK"),
    )
    assert rows(gold.rolling_year(done, date(2025, 5, 1)), "id_evenement") == [(2,), (3,)]
    assert gold.rolling_year(done, None) is done


def test_rules_are_parameters(spark):
    staff = people(spark, (1, "A", 1000.0, "BUS", 1.0, False))
    lenient = BusinessRules(bonus_modes=("BUS",), bonus_rate=0.1, wellbeing_min_activities=2)
    row = gold.to_gold(silver_rows(spark, *many(spark, 1, 2)), staff, rules=lenient).first()
    assert (row.montant_prime_sportive, row.eligible_jours_bien_etre) == (100.0, True)


def test_distance_totals(spark):
    done = silver_rows(spark, *many(spark, 1, 3), *many(spark, 2, 1))
    assert rows(gold.distance_totals(done)) == [(1, 30.0), (2, 10.0)]


def test_counts_before_the_join_equal_counts_after_it(spark):
    """Also with repeated, differing and missing reference rows and copies of activities."""
    bronze = spark.range(0, 3000, 1, 4).select(
        F.col("id"),
        F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 40).cast("bigint").alias("id_salarie"),
        F.concat(F.lit("S"), F.col("id") % 3).alias("type_sport"), F.lit(1.0).alias("distance"),
        (F.col("id") % 50).cast("string").alias("date_debut"), F.lit("6").alias("date_fin"),
        F.lit("c").alias("commentaire"), F.lit(1).cast("bigint").alias("duration_sec"),
    )
    staff = people(
        spark, *[(i, "A", 1.0, "VÉLO", float(i), i % 3 == 0) for i in range(30)],
        *[(i, "B", 1.0, "VÉLO", float(i), i % 3 == 0) for i in range(0, 30, 2)],
        *[(i, "C", 1.0, "VÉLO", 50.0, True) for i in range(0, 30, 5)],
    )
    after = gold.activity_counts(silver.to_silver(bronze, staff))
    before = gold.activity_counts_from_bronze(bronze, staff)
    assert before.dtypes == after.dtypes
    assert rows(before) == rows(after)
    assert len(rows(before)) == 40
    plan = plan_of(before)
    assert "partial_count" in plan


def test_silver_report(spark):
    done = silver_rows(
        spark, (1, 1, -5.0, "2025-01-01", "OK"), (2, 1, 5.0, "2025-01-01", "FRAUDE"),
        (3, None, 5.0, None, "INCONNU"), (4, 2, None, "2025-01-01", "INCONNU"),
    ).withColumn("date_fin", F.when(F.col("id_evenement") == 2, F.col("date_debut") - F.expr("interval 1 second"))
                 .otherwise(F.col("date_fin")))
    report = quality.silver_report(done)
    assert rows(report) == [
        ("date_fin_avant_debut", 1), ("distance_negative", 1), ("id_salarie_null", 1),
        ("salarie_absent_du_referentiel", 2), ("type_sport_null", 0),
    ]
    assert tuple(quality.issue_total(report).first()) == (4, "ALERTE")
    assert rows(quality.alert_split(done)) == [("FRAUDE", 1), ("INCONNU", 2), ("OK", 1)]
    assert rows(quality.flagged_activities(done), "id_evenement") == [(2,)]


def test_clean_silver_has_no_issue(spark):
    done = silver_rows(spark, *many(spark, 1, 3))
    report = quality.count_violations(done, quality.silver_rules())
    assert tuple(quality.issue_total(report).first()) == (0, "OK")
    empty = quality.silver_report(spark.createDataFrame([], SILVER))
    assert {r.n_bad for r in empty.collect()} == {0}


def test_report_is_one_pass(spark):
    plan = plan_of(quality.silver_report(silver_rows(spark, *many(spark, 1, 3))))
    assert plan.count("Exchange\n") <= 2  # the two mentions of one exchange
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"duration_sec": 1199}, "duree_hors_bornes"),
        ({"distance": 1999.0}, "distance_hors_bornes"),
        ({"distance": 15000.5}, "distance_hors_bornes"),
        ({"type_sport": "YOGA"}, "distance_hors_bornes"),
        ({"date_debut": "1767139200000001"}, "debut_hors_periode"),
        ({"date_fin": "1743899995000001"}, "fin_differente_du_debut_plus_duree"),
    ],
)
def test_generator_bounds(spark, change, rule):
    good = {"id": 1, "id_salarie": 7, "type_sport": "JUDO", "distance": 2000.0,
            "date_debut": "1743898597000000", "date_fin": "1743899995000000",
            "commentaire": "c", "duration_sec": 1398}
    order = BRONZE.fieldNames()
    bronze = spark.createDataFrame(
        [tuple(good[c] for c in order), tuple({**good, **change}[c] for c in order)], BRONZE
    )
    report = dict(rows(quality.bronze_report(bronze)))
    assert report[rule] == 1


def test_last_start_is_inclusive(spark):
    end = str(1767139200000000 + 1200 * 10**6)
    bronze = spark.createDataFrame(
        [(1, 7, "MUSCULATION", 0.0, "1767139200000000", end, "c", 1200)], BRONZE
    )
    assert {n for _, n in rows(quality.bronze_report(bronze, GeneratorBounds()))} == {0}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert rows(quality.duplicate_keys(df, "id")) == [(None, 2), (1, 2)]


def test_unreadable_values_break_their_rules(spark):
    wide = 2**63 - 1
    values = [
        (1, 1, "JUDO", None, "soon", "later", "c", None),
        (2, 1, "JUDO", 3000.0, str(-wide), str(wide), "c", wide),
    ]
    df = spark.createDataFrame(values, BRONZE)
    got = dict(rows(quality.bronze_report(df)))
    assert got == {
        "duree_hors_bornes": 2,
        "distance_hors_bornes": 1,
        "debut_hors_periode": 2,
        "fin_differente_du_debut_plus_duree": 2,
    }


def test_copies_without_an_id_count_alike_on_both_paths(spark):
    shape = "id long, id_salarie long, type_sport string, distance double, date_debut string, " \
        "date_fin string, commentaire string, duration_sec long"
    values = [
        (i, who, "S", 1.0, str(start), "9", "c", 1)
        for i, who, start in [(None, 1, 5), (5, 1, 5), (None, 2, 5), (7, 3, 5), (8, 3, 6)]
    ]
    bronze = spark.createDataFrame(values, shape)
    staff = people(spark, (1, "A", 1.0, "VÉLO", 1.0, False), (3, "B", 1.0, "VÉLO", 99.0, True),
                   (3, "C", 1.0, "VÉLO", 98.0, False))
    made = silver.to_silver(bronze, staff)
    assert rows(gold.activity_counts_from_bronze(bronze, staff)) == rows(gold.activity_counts(made))
    assert rows(quality.alert_split_from_bronze(bronze, staff)) == rows(quality.alert_split(made))
    assert rows(gold.gold_from_bronze(bronze, staff)) == rows(gold.to_gold(made, staff))
