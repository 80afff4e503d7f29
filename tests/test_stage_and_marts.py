"""Row rules of the stage and whole-table rules of the marts on small made tables."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cotag.functions.text import clean_account, trim_spaces
from cotag.operators import marts, stage
from cotag.plans import rebuild
from cotag.plans.rebuild import write_mart

POST = (
    "post_id string, insta_id string, insta_name string, brand_name string, brand_id string, "
    "post_date date, full_link string, tagged_insta_id string"
)


def posts_of(spark, rows):
    """(post_id, insta_id, insta_name, day, tags)"""
    data = [(p, i, n, "b", "b1", d, "", t) for p, i, n, d, t in rows]
    return spark.createDataFrame(data, POST)


def tags_of(spark, text):
    df = posts_of(spark, [("p", "i", "n", date(2024, 1, 1), text)])
    rows = stage.tagged_post_rows(df).orderBy("tag_pos").collect()
    return [(r["tag_pos"], r["tagged_account"]) for r in rows]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("@Foo.", [(1, "foo")]),
        ("@@foo", [(1, "@foo")]),
        ("@ foo", [(1, " foo")]),
        ("foo..", [(1, "foo")]),
        ("@", [(1, "")]),
        ("...", [(1, "")]),
        (" foo　", [(1, "foo")]),
        ("\tfoo", [(1, "\tfoo")]),
        ("a,, b ,", [(1, "a"), (3, "b")]),
        ("@A,@a", [(1, "a"), (2, "a")]),
        ("   ", []),
        ("", []),
        (None, []),
        (",", []),
    ],
)
def test_tag_rules(spark, text, expected):
    assert tags_of(spark, text) == expected


def test_stage_of_one_account_is_the_filtered_stage(spark):
    df = posts_of(
        spark,
        [
            ("p1", "i", "n", date(2024, 1, 1), "@Foo., bar"),
            ("p2", "i", "n", date(2024, 1, 1), "foobar"),
            ("p3", "i", "n", date(2024, 1, 1), None),
        ],
    )
    whole = stage.tagged_post_rows(df).filter("tagged_account = 'foo'").collect()
    assert stage.tagged_post_rows(df, "foo").collect() == whole
    assert len(whole) == 1


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="@.aB_ é1", max_size=8), min_size=1, max_size=40))
def test_cleaning_is_idempotent(spark, parts):
    parts = [p for p in parts if p.count("@") <= 1 and " " not in p.strip(" ")]
    df = spark.createDataFrame([(p,) for p in parts], "part string")
    once = clean_account(trim_spaces(F.col("part")))
    wrong = df.select(once.alias("one")).filter(
        (clean_account(F.col("one")) != F.col("one")) & ~F.col("one").startswith("@")
    )
    # "x.@" style parts may expose a second leading mark, which the rule keeps.
    assert wrong.filter(~F.col("one").contains("@")).count() == 0


def table_with_repeats(spark):
    return posts_of(
        spark,
        [
            ("p1", "a", "unknown", date(2024, 1, 5), "@X,@x, y"),
            ("p2", "a", "Ann", date(2024, 1, 9), "x"),
            ("p3", "a", "Anna", date(2024, 2, 1), "x.,X"),
            ("p4", "b", "unknown", None, "x,@"),
            ("p5", None, "n", date(2024, 2, 1), "y"),
            ("p6", "c", None, date(2024, 2, 1), "zz,z,a"),
        ],
    )


def test_edges_count_posts_not_rows(spark):
    df = table_with_repeats(spark)
    keyed = {
        (r["insta_id"], r["tagged_account"]): r for r in marts.account_tagged(df).collect()
    }
    assert keyed[("a", "x")]["tagged_post_count"] == 3
    assert keyed[("a", "x")]["insta_name"] == "Anna"
    assert keyed[("a", "y")]["insta_name"] == "unknown"
    assert keyed[("b", "x")]["first_tagged_date"] is None
    assert keyed[("b", "")]["tagged_post_count"] == 1
    assert keyed[("c", "z")]["insta_name"] == "unknown"
    assert (None, "y") in keyed


def test_both_plans_of_a_mart_agree(spark):
    df = table_with_repeats(spark)
    rows = stage.tagged_post_rows(df)
    for keyed, general in (
        (marts.account_tagged(df), marts.account_tagged_from_stage(rows)),
        (marts.brand_monthly_tagging(df), marts.brand_monthly_from_stage(rows)),
    ):
        assert keyed.exceptAll(general).count() == 0
        assert general.exceptAll(keyed).count() == 0


@pytest.mark.parametrize("start", ["", "all-alike-"])
@pytest.mark.parametrize("part_rows", [1, 7, 4096])
def test_long_lists_are_whole_and_ordered(spark, part_rows, start):
    tags = [f"{start}{c}{n}" for c in "badc" for n in range(300)] + ["", "b", "ba"]
    rows = [("hot", t) for t in tags] + [("cold", "z"), ("cold", "a"), (None, "q")]
    edges = spark.createDataFrame(rows, "insta_id string, tagged_account string").withColumn(
        "insta_name", F.lit("unknown")
    )
    got = {r["insta_id"]: r for r in marts.cross_brand_accounts(edges, part_rows).collect()}
    assert got["hot"]["brands_tagged"] == ", ".join(sorted(tags))
    assert got["hot"]["tagged_account_count"] == len(tags)
    assert got["cold"]["brands_tagged"] == "a, z"
    assert got[None]["brands_tagged"] == "q"


def test_a_hot_list_lies_in_many_parts(spark):
    edges = spark.range(5000).selectExpr(
        "'hot' as insta_id", "'n' as insta_name", "concat('alike-', lpad(id, 5, '0')) as tagged_account"
    )
    parts = marts.account_lists(edges, 500).orderBy("part").collect()
    assert len(parts) >= 10 and max(p["edges"] for p in parts) <= 500
    joined = ", ".join(p["tags"] for p in parts)
    assert joined == ", ".join(f"alike-{n:05}" for n in range(5000))


def test_list_without_accounts_is_null(spark):
    edges = spark.createDataFrame(
        [("a", None, "n"), ("b", None, "n"), ("b", "t", "n")],
        "insta_id string, tagged_account string, insta_name string",
    )
    got = {r["insta_id"]: r for r in marts.cross_brand_accounts(edges).collect()}
    assert got["a"]["brands_tagged"] is None
    assert got["a"]["tagged_account_count"] == 1
    assert got["b"]["brands_tagged"] == "t"
    assert got["b"]["tagged_account_count"] == 2


def test_mart_schemas(spark):
    from cotag import schemas

    df = table_with_repeats(spark)
    edges = marts.account_tagged(df)
    for frame, schema in (
        (stage.tagged_post_rows(df), schemas.STAGE),
        (edges, schemas.ACCOUNT_TAGGED),
        (marts.cross_brand_accounts(edges), schemas.CROSS_BRAND),
        (marts.brand_monthly_tagging(df), schemas.BRAND_MONTHLY),
        (marts.co_brand_stats(edges), schemas.CO_BRAND_STATS),
    ):
        assert [(f.name, f.dataType) for f in frame.schema] == [
            (f.name, f.dataType) for f in schema
        ]


def test_shares_without_any_account(spark):
    edges = marts.account_tagged(posts_of(spark, [("p", None, "n", date(2024, 1, 1), "@x")]))
    row = marts.co_brand_stats(edges).first()
    assert (row["tagged_account"], row["tagger_count"], row["tagger_ratio"]) == ("x", 0, None)


def test_tag_lists_are_cleaned_once_and_exploded_in_generated_code(spark):
    rows = [
        ("p1", "u", "n", date(2024, 1, 1), " @A., a ,b,,A"),
        ("p2", "u", "n", date(2024, 1, 1), " , ,"),
        ("p3", "u", "n", date(2024, 1, 1), "@"),
        ("p4", "u", "n", date(2024, 1, 1), None),
    ]
    found = stage.distinct_tags(posts_of(spark, rows))
    got = sorted((r["post_id"], r["tagged_account"]) for r in found.collect())
    assert got == [("p1", "a"), ("p1", "b"), ("p3", "")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_distinct") == 1
    (line,) = [text for text in plan.splitlines() if "Generate" in text]
    assert "*(" in line


def test_months_are_sorted_by_one_number_that_keeps_runs_together(spark, tmp_path, monkeypatch):
    days = [None, date(1, 1, 1), date(1969, 12, 1), date(1970, 1, 1), date(2024, 2, 1)]
    rows = [(t, d, f"u{n}", 1) for n in range(4) for d in days for t in (None, "", "a", "b", "é")]
    months = spark.createDataFrame(rows, "tagged_account string, month date, insta_id string, post_count long")
    monkeypatch.setattr(type(months), "repartitionByRange", lambda df, *_: df.coalesce(1))
    cluster = ("tagged_account", "month", "insta_id")
    stored = write_mart(months, str(tmp_path / "m"), *cluster, order=marts.month_runs())
    assert stored.columns == months.columns
    found = [tuple(r) for r in stored.collect()]
    assert sorted(map(str, found)) == sorted(map(str, rows))
    runs = [row[:2] for i, row in enumerate(found) if i == 0 or row[:2] != found[i - 1][:2]]
    assert len(runs) == 25
    assert len([i for i, run in enumerate(runs) if i == 0 or run[0] != runs[i - 1][0]]) == 5


def test_a_rebuild_sorts_months_by_one_number(spark, tmp_path, monkeypatch):
    orders = {}

    def spy(df, path, *cluster, lookup=None, order=None):
        orders[path.rsplit("/", 1)[1]] = order
        return write_mart(df, path, *cluster, lookup=lookup, order=order)

    monkeypatch.setattr(rebuild, "write_mart", spy)
    posts = table_with_repeats(spark)
    built = rebuild.Marts(spark, str(tmp_path / "marts")).rebuild(posts, check=False)
    assert [name for name, order in orders.items() if order is not None] == ["tagger_months"]
    want = marts.tagger_months(posts)
    got = built["tagger_months"]
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
