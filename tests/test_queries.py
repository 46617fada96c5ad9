"""Every registered query against its SQL counterpart on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

from gildstar.queries import REGISTRY

SF_DIR = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")

# Plan nodes that would mean per-row Python, a cross join, or everything in one task.
UNWANTED = (
    "EvalPython",
    "InPandas",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "GlobalLimit",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(spark, con, name):
    query = REGISTRY[name]
    df = query.run(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in UNWANTED:
        assert node not in plan, f"{node} in the plan of {name}"
    if query.sql is None:
        assert df.count() > 0
    else:
        assert difference(con, df, query.sql) is None


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
