import pytest
from check_oracle import compare, connect

from logquarry.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    diffs, rows = compare(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name])
    assert not diffs and rows > 0


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and ORACLE_SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_cross_join_and_read_whole_tables(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit", "Sample "))


def test_pipeline_joins_have_no_cross_join(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        plan = stage(spark, docs, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
