"""What the input of the queries costs to build, on small made tables."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cotag.functions.text import SPACE_SEPARATORS, clean_account, trim_spaces
from cotag.operators import quality
from cotag.operators.stage import tagged_post_rows
from cotag.plans.rebuild import expectations
from cotag.verify import fixtures as fx


@pytest.fixture
def folder(spark, tmp_path):
    """Orders with no, one, tied, repeated and missing line items."""
    day = datetime(2024, 1, 1)
    tables = {
        "orders": ([(n, 1, day) for n in (1, 2, 3, 4, 5, 5)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "customer": ([(1, "ann", "AUTO")], "c_custkey long, c_name string, c_mktsegment string"),
        "part": ([(1, "Brand#1"), (2, "Brand#2"), (3, None)], "p_partkey long, p_brand string"),
        "lineitem": (
            [
                (1, 2, 1, 1, 5.0, 9.0), (1, 1, 1, 1, 5.0, 9.0), (1, 1, 1, 1, 5.0, 9.0),
                (1, None, 2, 1, 2.0, 1.0), (1, 3, 2, None, 1.0, 4.0), (2, 1, 3, 1, 5.0, 1.0),
                (2, 2, 3, 1, 5.0, 1.0), (3, 2, 3, 1, 5.0, 1.0), (3, 1, 2, 1, 5.0, 2.0),
                (3, 1, 2, 1, 5.0, None), (3, 4, None, 1, 5.0, 2.0), (None, 1, 1, 1, 5.0, 2.0),
                (5, 4, 1, 1, None, 2.0), (5, 3, 1, 2, 1.0, 2.0),
            ],
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
            "l_extendedprice double",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_posts_are_those_of_the_statement(spark, folder):
    f = fx.Fixture.of(spark, folder)
    columns = ["post_id", "insta_id", "tagged_insta_id", "tagged_insta_id_cnt"]
    want = f.sql(fx.POSTS_SQL).select(columns)
    got = f.posts().select(columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r["tagged_insta_id"] for r in got.filter("post_id in ('p2', 'p4')").collect()} == {None}


def test_posts_are_built_without_a_buffer_per_line_item(spark, folder, monkeypatch):
    plans = []

    def spy(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(fx, "write_mart", spy)
    monkeypatch.setattr(fx, "scan_posts", lambda spark, path: None)
    fx.Fixture(spark, folder).posts()
    assert "ObjectHashAggregate" not in plans[0] and "SortAggregate" not in plans[0]


def test_cheap_trims_give_what_the_plain_ones_give(spark):
    ends = ["", " ", "  ", "\t", " ", "　 ", " ", ".", "..", "@", "@@", "é", "@."]
    texts = [a + middle + b for a in ends for b in ends for middle in ("", "x", "X.y", "é", "가 b")]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    t = F.col("t")
    bare = F.when(t.startswith("@"), t.substr(F.lit(2), F.length(t))).otherwise(t)
    plain = (F.btrim(t, F.lit(SPACE_SEPARATORS)), F.lower(F.rtrim(bare, F.lit("."))))
    wrong = ~(trim_spaces(t).eqNullSafe(plain[0]) & clean_account(t).eqNullSafe(plain[1]))
    assert df.filter(wrong).collect() == []
    assert "btrim" in str(trim_spaces(t)) and "octet_length" in str(trim_spaces(t))


def test_data_tests_derive_a_summary_once(spark):
    ids = F.concat(F.lit("u"), F.col("id").cast("string"))
    base = spark.range(4).select(ids.alias("insta_id"))
    edges = base.withColumn("tagged_account", F.lit("t")).filter("insta_id <> 'mark-of-edges'")
    cross = base.withColumn("tagged_account_count", F.lit(1)).filter("insta_id <> 'mark-of-cross'")
    posts = base.select("insta_id", *(F.lit("x").alias(c) for c in ("post_id", "brand_name", "insta_name",
                        "brand_id", "full_link", "tagged_insta_id")), F.current_date().alias("post_date"))
    built = {"account_tagged_accounts": edges, "cross_brand_accounts": cross}
    found = expectations(posts, tagged_post_rows(posts), built)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "mark-of" in line]
    assert len([x for x in filters if "mark-of-cross" in x]) == 1
    assert len([x for x in filters if "mark-of-edges" in x]) == 1


def test_failures_by_key_are_those_of_single_tests(spark):
    rows = [(None, 1), (None, None), ("a", 1), ("a", 1), ("b", None), ("c", None), ("c", 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    checks = {"k": F.col("k").isNull(), "v": F.col("v").isNull()}

    def found(table, keys, **how):
        return dict(map(tuple, quality.key_failures(table, checks, keys, "unique", "name", **how).collect()))

    assert found(df, ["k"]) == {"k": 2, "v": 3, "unique": 2}
    assert found(df, ["k"], with_nulls=True) == {"k": 2, "v": 3, "unique": 3}
    assert found(df, ["k", "v"]) == {"k": 2, "v": 3, "unique": 1}
    assert found(df.limit(0), ["k"]) == {"k": 0, "v": 0, "unique": 0}
