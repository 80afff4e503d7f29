"""Registered queries against their DuckDB statements, at two sizes."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as entry_module
import corpus_pipeline
from cotag.llm.oracles import ORACLES
from cotag.llm.queries import QUERIES


def test_all_registered():
    names = entry_module.queries().keys()
    assert {*QUERIES, "pipeline"} <= set(names)
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert ORACLES.items() <= entry_module.oracle_sql().items()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_statement(spark, name, folder):
    sf_dir = f"/root/testdata/{folder}"
    names, got = spark_rows(QUERIES[name](spark, sf_dir))
    want_names, want = duck_rows(connect(sf_dir), ORACLES[name])
    assert names == want_names
    assert got == want and got
