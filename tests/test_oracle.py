"""Every registered query against its SQL at the smallest scale."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from logquarry.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.QUERIES, oracle.ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(ORACLE) == {"final_report"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    diffs, rows = compare(df, duck, ORACLE[name])
    assert not diffs and rows > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(join in plan for join in ("CartesianProduct", "BroadcastNestedLoopJoin"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
