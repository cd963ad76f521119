import os

import pytest

from tests.compare import connect, rows
from tidewell.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, con, name):
    got, want = registry.queries()[name](spark, FOLDER).toPandas(), con.execute(registry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plans_scale(spark):
    """No Cartesian products or nested loops; top-k is limited before the shuffle."""
    for name, query in registry.queries().items():
        plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    top = registry.queries()["top_topics"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in top
