"""Every registered query but the training-data ones (tests/llm) against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pulsegrid.plans.catalog import QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert slow not in plan
    ours = df.toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(ours) > 0
        return
    assert differences(ours, con.sql(sql).df()) is None
