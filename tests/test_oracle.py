"""Every registered query equals its DuckDB statement."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as entry_module
from cotag.verify.registry import QUERIES

ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, sf_dir, name):
    df = entry_module.queries()[name](spark, sf_dir)
    names, got = spark_rows(df)
    assert sum(got.values()) > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert unwanted not in plan
    if name in ORACLES:
        want_names, want = duck_rows(con, ORACLES[name])
        assert names == want_names
        assert got == want


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
