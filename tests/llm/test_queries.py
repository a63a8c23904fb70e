"""Registered queries against their SQL, and which of them stay free of Python."""

import pytest
from conftest import plan_of
from oracle_check import connect, difference

from activlake.llm.registry import ORACLE, QUERIES

NATIVE = ("op2_", "op5_", "op9_", "op10_")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, small, name):
    assert difference(connect(small), name, QUERIES[name](spark, small), ORACLE[name]) is None


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.startswith(NATIVE)])
def test_native_plans_hold_no_python(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    found = [w for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if w in plan]
    assert found == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
