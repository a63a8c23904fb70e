"""Appends under a primary key, and what joins do to the number of rows."""

import json

import pytest
from conftest import plan_of, rows

from activlake.operators import keyed
from activlake.plans import medallion
from activlake.plans.medallion import LakePaths, run_ingest

BODY = {
    "type_sport": "JUDO", "distance": 2500,
    "date_debut": "2025-04-06 00:16:37", "date_fin": "2025-04-06 01:16:37",
}


def body(who, **changes):
    return json.dumps({**BODY, "id_salarie": who, **changes})


@pytest.fixture
def paths(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


def send(spark, paths, data, lot):
    table = spark.createDataFrame(data, "id long, body string").repartition(3)
    return run_ingest(spark, paths, table, lot)


def stored(spark, paths):
    return rows(medallion.read_table(spark, paths.activities), "id", "id_salarie")


def refused(spark, paths):
    return rows(medallion.read_table(spark, paths.refused), "lot", "id", "message")


def test_each_id_is_stored_once(spark, paths):
    hot = [(7, body(1))] * 50  # a third of the lot
    others = [(i, body(i)) for i in range(100, 200)]
    send(spark, paths, [*hot, *others, (None, body(3)), (5, "garbage")], "a")
    want = sorted([(7, 1), *((i, i) for i in range(100, 200))], key=str)
    assert sorted(stored(spark, paths), key=str) == want
    first = [("a", 5, "Invalid body"), ("a", None, "Null value: id"), *[("a", 7, "Duplicate key: id")] * 49]
    assert sorted(refused(spark, paths), key=str) == sorted(first, key=str)
    send(spark, paths, [(7, body(2)), (150, body(150)), (300, body(300)), (300, body(301))], "b")
    ids = [i for i, _ in stored(spark, paths)]
    assert sorted(ids) == sorted([7, 300, *range(100, 200)])
    assert (7, 1) in stored(spark, paths)  # the first lot's row stays
    second = [("b", i, "Duplicate key: id") for i in (7, 150, 300)]
    assert sorted(refused(spark, paths), key=str) == sorted(first + second, key=str)


def test_a_lot_that_is_sent_again_replaces_itself(spark, paths):
    send(spark, paths, [(1, body(1)), (2, body(2)), (2, body(3)), (3, "x")], "day 1/é")
    before = stored(spark, paths), refused(spark, paths)
    send(spark, paths, [(1, body(1)), (2, body(2)), (2, body(3)), (3, "x")], "day 1/é")
    assert (stored(spark, paths), refused(spark, paths)) == before
    send(spark, paths, [(1, body(9))], "day 1/é")
    assert (stored(spark, paths), refused(spark, paths)) == ([(1, 9)], [])


@pytest.mark.parametrize("step", [0, 1])
def test_a_lot_that_failed_half_way_is_whole_after_a_retry(spark, paths, monkeypatch, step):
    send(spark, paths, [(1, body(1))], "a")
    real, calls = medallion.overwrite_lot, []

    def failing(df, path, lot, fmt=None):
        calls.append(path)
        if len(calls) > step:
            raise OSError("lost")
        real(df, path, lot, fmt)

    monkeypatch.setattr(medallion, "overwrite_lot", failing)
    data = [(1, body(5)), (2, body(2)), (3, "x")]
    with pytest.raises(OSError):
        send(spark, paths, data, "b")
    monkeypatch.setattr(medallion, "overwrite_lot", real)
    send(spark, paths, data, "b")
    assert stored(spark, paths) == [(1, 1), (2, 2)]
    assert refused(spark, paths) == [("b", 1, "Duplicate key: id"), ("b", 3, "Invalid body")]


def test_empty_lots(spark, paths):
    send(spark, paths, [], "none")
    assert medallion.read_table(spark, paths.activities).count() == 0
    send(spark, paths, [(1, body(1))], None)
    assert stored(spark, paths) == [(1, 1)]


def test_stored_keys_pass_a_bloom_filter_and_nothing_else_is_read(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    spark.range(10_000).selectExpr("id", "uuid() AS body").write.parquet(old)
    spark.range(9_990, 10_010).selectExpr("id", "'ok' AS status", "id AS arrival").write.parquet(new)
    options = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        wanted = spark.read.parquet(new).filter("status = 'ok'")
        found = keyed.stored_among(spark.read.parquet(old), wanted, "id")
        plan = plan_of(found)
        assert "might_contain" in plan and "bloom_filter_agg" in plan
        assert "ReadSchema: struct<id:bigint>" in plan
        assert rows(found) == [(i,) for i in range(9_990, 10_000)]
        fresh = keyed.insertable(wanted, spark.read.parquet(old), "id", "arrival")
        assert rows(fresh) == [(i,) for i in range(10_000, 10_010)]
    finally:
        for name in options:
            spark.conf.unset(name)


def test_multiplicity_is_told_without_the_join(spark):
    left = spark.createDataFrame([(1,)] * 40 + [(2,), (3,), (None,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (9, "e"), (None, "f")], "k int, v string")
    report = keyed.fan_out(left, right, "k", "k")
    assert rows(report) == [(None, 2, 0, 2, 0), (1, 40, 3, 120, 80), (2, 1, 1, 1, 0), (3, 1, 0, 1, 0)]
    total = keyed.fan_out_total(report).first()
    assert tuple(total) == (44, 124, 1, 3)
    assert total.joined_rows == left.join(right, "k", "left").count()
    assert tuple(keyed.fan_out_total(keyed.fan_out(left.limit(0), right, "k", "k")).first()) == (0, 0, 0, 0)
