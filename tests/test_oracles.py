"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from oracle_compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        difference = compare(df, duck, ORACLES[name])
        assert difference is None, difference
    else:
        assert df.collect()


def test_entry(spark):
    assert entry_point.entry(spark).collect()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
