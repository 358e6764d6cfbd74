"""Every query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = entry.SMOKE_DIR
NO_ORACLE: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_all_queries_have_an_oracle():
    assert set(QUERIES) - set(ORACLE) == NO_ORACLE
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0


UNWANTED = ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [bad for bad in UNWANTED if bad in plan] == []
    assert difference(df, con, ORACLE[name]) is None
