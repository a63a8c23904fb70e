import json

from conftest import rows

from activlake.operators.ingest import stored_rows, validate

FULL = {
    "id_salarie": 7,
    "type_sport": "JUDO",
    "distance": 2500,
    "duration_sec": 60,
    "date_debut": "2025-01-01 10:00:00",
    "date_fin": "2025-01-01 11:00:00",
    "commentaire": "A B - JUDO",
}


def without(*keys, **changes):
    return json.dumps({**{k: v for k, v in FULL.items() if k not in keys}, **changes})


CASES = [
    (1, without(), "activity stored"),
    (2, without("distance"), "Missing field: distance"),
    (3, without("id_salarie", "date_fin"), "Missing field: id_salarie"),
    (4, without(distance=None), "activity stored"),
    (5, without("commentaire"), "activity stored"),
    (6, without("duration_sec"), "activity stored"),
    (7, without(id_salarie=None), "Null value: id_salarie"),
    (8, without(id_salarie="abc"), "Invalid value: id_salarie"),
    (9, without(date_debut="demain"), "Invalid value: date_debut"),
    (10, "[1, 2]", "Invalid body"),
    (11, "garbage", "Invalid body"),
    (12, None, "Invalid body"),
    (13, without(commentaire=None), "activity stored"),
]


def bodies(spark):
    return spark.createDataFrame([(i, b) for i, b, _ in CASES], "id int, body string")


def test_validation_messages(spark):
    got = rows(validate(bodies(spark)), "id", "status", "message")
    want = [(i, "ok" if m == "activity stored" else "error", m) for i, _, m in CASES]
    assert got == sorted(want, key=lambda r: str(r[0]))


def test_stored_rows(spark):
    stored = stored_rows(bodies(spark))
    assert rows(stored, "id", "id_salarie", "type_sport", "distance", "commentaire") == [
        (1, 7, "JUDO", 2500.0, "A B - JUDO"),
        (13, 7, "JUDO", 2500.0, None),
        (4, 7, "JUDO", None, "A B - JUDO"),
        (5, 7, "JUDO", 2500.0, ""),
        (6, 7, "JUDO", 2500.0, "A B - JUDO"),
    ]
    first = stored.filter("id = 1").selectExpr("date_debut = '2025-01-01 10:00:00'", "duration_sec",
                                               "created_at is not null").first()
    assert tuple(first) == (True, None, True)
