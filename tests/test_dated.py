"""Rules with validity dates against a plain reading of their definition."""

from datetime import date

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from activlake.operators.dated import with_dated_rule

RULES = "key string, valid_from date, valid_to date, label string, rate double"
ROWS = "id long, sport string, day date, label string"


def d(n):
    return None if n is None else date(2025, 1, n)


def brute(rules, key, day):
    if day is None:
        return None, None

    def of(k):
        began = [r for r in rules if k is not None and r[0] == k and (r[1] is None or r[1] <= day)]
        if not began:
            return None
        first = max((r[1] is not None, r[1] or date.min) for r in began)
        last = max(
            (r for r in began if (r[1] is not None, r[1] or date.min) == first),
            key=lambda r: (r[2] is None, r[2] or date.min, r[3], r[4]),
        )
        return last[3:] if last[2] is None or day < last[2] else None

    own, other = of(key), of("DEFAULT")
    if own:
        return own, "default" if key == "DEFAULT" else "own"
    return other, "default" if other else None


def check(spark, rules, rows):
    got = with_dated_rule(
        spark.createDataFrame(rows, ROWS),
        spark.createDataFrame(rules, RULES),
        F.col("sport"),
        F.col("day"),
    )
    have = sorted(
        ((r.id, r.label, tuple(r.rule) if r.rule else None, r.rule_level) for r in got.collect()), key=str
    )
    want = sorted(((i, x, *brute(rules, k, day)) for i, k, day, x in rows), key=str)
    assert have == want
    return got


CASES = [
    ("TENNIS", d(5), d(10), "a", 1.0),
    ("TENNIS", d(8), d(9), "short and later", 1.0),  # ends the rule above for good
    ("TENNIS", d(20), None, "open", 2.0),
    ("TENNIS", d(20), d(25), "same start, ends sooner", 9.0),
    ("TENNIS", d(20), None, "open", 1.0),
    ("RUGBY", None, d(3), "since ever", 1.0),
    ("RUGBY", d(6), d(6), "no day", 1.0),
    ("RUGBY", d(9), d(4), "ends before it begins", 1.0),
    ("DEFAULT", d(2), d(28), "default", 0.5),
    (None, None, None, "no key", 7.0),
]
KEYS = ["TENNIS", "RUGBY", "DEFAULT", "UNKNOWN", "", None]


def test_every_key_on_every_day(spark):
    rows = [(i, k, d(n), "text") for i, k in enumerate(KEYS) for n in [None, *range(1, 32)]]
    check(spark, CASES, rows + rows[:9])


def test_a_hot_key_and_empty_tables(spark):
    rows = [(i, "TENNIS", d(21), None) for i in range(3000)] + [(i, "X", d(1 + i % 31), "") for i in range(900)]
    check(spark, CASES, rows)
    check(spark, [], rows[:50])
    check(spark, CASES, [])


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_rows_meet_rules_by_equality_and_are_broadcast_by_size_alone(spark, threshold):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = check(spark, CASES, [(1, "TENNIS", d(21), None), (2, None, d(4), "")])
        plan = plan_of(got)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
