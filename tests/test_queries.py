"""Every registered query against its SQL in another engine, on the small tables."""

from __future__ import annotations

import os

import pytest

from compare import differences, duck
from ledgerloom.plans import oracle, queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_columns_and_sql():
    assert set(queries.BUILDERS) == set(queries.COLUMNS) == set(oracle.statements())


# Operators that leave the JVM or compare every pair of rows.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


@pytest.mark.parametrize("name", list(queries.BUILDERS))
def test_query(spark, con, name):
    df = queries.run(name, spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [node for node in UNWANTED if node in plan] == []
    assert differences(df, con, oracle.statement(name)) == []


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["total_orders"] > 0
    # The optional package for text corpora has queries that SQL can't express.
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(queries.BUILDERS) <= set(entry.oracle_sql())
