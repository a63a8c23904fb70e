"""Every registered query against its SQL, and the shape of the plans."""

import pytest
from conftest import plan_of
from oracle_check import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from workload.queries import QUERIES

NAMES = sorted(QUERIES)
# Row-at-a-time or Arrow Python stages, and joins without keys.
UNWANTED = (
    "PythonUDF",
    "ArrowEvalPython",
    "BatchEvalPython",
    "MapInPandas",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


def test_every_query_has_sql():
    assert set(NAMES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, small, con, name):
    frame = queries()[name](spark, small)
    plan = plan_of(frame)
    assert [word for word in UNWANTED if word in plan] == []
    assert difference(con, name, frame, oracle_sql()[name]) is None


def test_counts_read_only_the_key_columns(spark, small):
    plan = plan_of(queries()["gold_kpi"](spark, small))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_rolling_filter_is_below_the_deduplication(spark, small):
    plan = plan_of(queries()["gold_kpi_rolling"](spark, small))
    tree = plan[: plan.index("(1)")]
    assert "timestamp_micros" in plan
    # The filter on the start sits between the scan of the orders and the first aggregate.
    scan = tree.rindex("Scan parquet", 0, tree.rindex("HashAggregate") + 4000)
    assert "Filter" in tree[tree.rindex("HashAggregate", 0, scan) : scan]


def test_reports_carry_no_comments(spark, small):
    for name in ("dq_silver", "fraud_list", "alert_split"):
        plan = plan_of(queries()[name](spark, small))
        assert "commentaire" not in plan and "min(struct(id, id, distance, distance, date_fin, date_fin, comm" not in plan


def test_the_reference_is_built_once(spark, small):
    plan = plan_of(queries()["gold_kpi"](spark, small))
    assert "customer.parquet" not in plan and "supplier.parquet" not in plan


def test_top_is_not_a_full_sort(spark, small):
    assert "TakeOrderedAndProject" in plan_of(queries()["gold_top10"](spark, small))


def test_entry(spark):
    assert entry(spark).count() > 0
