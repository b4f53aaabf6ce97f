"""Every registered query against its SQL twin, on the smallest tables."""

import re

import compare
import pytest

import __spark_entry__ as entry_points
from millrace.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return compare.connect(sf)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["l_returnflag", "prediction", "count"]
    assert sum(r["count"] for r in df.collect()) == 6000


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    found = compare.rows_of_spark(df)
    if name in ORACLES:
        assert compare.difference(found, compare.rows_of_sql(duck, ORACLES[name])) is None
    else:
        assert found[1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name != "batch_infer":
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)
