"""Serving rules on small edge tables, ranks, labels and the rebuild."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from cotag.functions import labels, ranking
from cotag.functions.joins import held, keep_matching
from cotag.functions.ranking import page_count, page_offset, rank_all, rank_page
from cotag.operators import co_brands, marts, quality, taggers
from cotag.operators.audience import (
    Audience, account_numbers, brand_bitmaps, selected_accounts, selected_by_bitmaps, selected_size,
)
from cotag.operators.freshness import freshness
from cotag.plans.rebuild import ExpectationError, Marts, expectations, require, stage_failures
from cotag.schemas import ACCOUNT_TAGGED, POSTS
from cotag.sources.tables import NotAQuery, brand_search, run_sql
from cotag.operators.stage import tagged_post_rows

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)


def edges_of(spark):
    rows = [
        ("a", "Ann", "x", D1, D1, 3),
        ("a", "unknown", "y", D1, D2, 2),
        ("a", "Zed", "z", D1, D1, 7),
        ("a", "Zed", "w", D1, D1, 1),
        ("b", "unknown", "x", D1, D1, 4),
        ("b", "unknown", "y", D1, D1, 1),
        ("c", "Cat", "x", D1, D1, 9),
        ("c", "Cat", "z", D1, D1, 9),
        (None, "No", "x", D1, D1, 50),
        (None, "No", "y", D1, D1, 50),
        (None, "No", "q", D1, D1, 50),
    ]
    return spark.createDataFrame(rows, ACCOUNT_TAGGED)


@pytest.fixture(scope="module", params=[1000, 0], ids=["broadcast", "shuffle"])
def audience(request, spark):
    return Audience(edges_of(spark), ["x", "y"], broadcast_rows=request.param)


def test_selection(spark):
    edges = edges_of(spark)

    def ids(brands):
        return {r["insta_id"] for r in selected_accounts(edges, brands).collect()}

    assert ids(["x", "y"]) == {"a", "b", None}
    assert ids(["x"]) == {"a", "b", "c", None}
    assert ids(["x", "x"]) == set()
    assert ids(["X"]) == set()
    assert ids(["x", "nobody"]) == set()
    assert ids(["o'brien"]) == set()
    with pytest.raises(ValueError, match="must not be empty"):
        selected_accounts(edges, [])


def test_kpi(audience):
    row = taggers.tagger_kpi(audience).first()
    assert tuple(row) == (2, 5.0, "a", "Ann", 5)
    assert taggers.tagger_count(audience).first()[0] == 3
    assert tuple(taggers.top_tagger(audience).first()) == ("a", "Ann", 5)


def test_kpi_of_nobody(spark):
    nobody = Audience(edges_of(spark), ["nobody"])
    assert tuple(taggers.tagger_kpi(nobody).first()) == (0, 0.0, None, None, None)
    assert tuple(taggers.kpi_defaults(taggers.tagger_kpi(nobody)).first()) == (0, 0.0, None, None, 0)
    assert co_brands.co_brand_ranking(nobody).count() == 0
    assert tuple(co_brands.co_brand_kpi(nobody).first()) == (0, 0)
    assert taggers.tagger_list(nobody).count() == 0


def test_listing_multiplies_by_other_brands(audience):
    rows = [tuple(r) for r in taggers.tagger_list(audience).collect()]
    assert rows == [(1, "a", "Ann", 10, D2, 2), (2, "b", "b", 5, D1, 0)]
    cross = marts.cross_brand_accounts(audience.edges)
    assert [tuple(r) for r in taggers.tagger_list(audience, cross_brand=cross).collect()] == rows
    by_mart = taggers.tagger_list_exact(audience, cross_brand=cross).orderBy("rank")
    assert [tuple(r) for r in by_mart.collect()] == [
        tuple(r) for r in taggers.tagger_list_exact(audience).orderBy("rank").collect()
    ]
    exact = [tuple(r) for r in taggers.tagger_list_exact(audience).orderBy("rank").collect()]
    assert exact == [(1, "a", "Ann", 5, D2, 2), (2, "b", "b", 5, D1, 0)]


def test_ranking(audience):
    rows = [tuple(r) for r in co_brands.co_brand_ranking(audience).orderBy("rank").collect()]
    assert rows == [(1, "z", 1, 7, 33.3), (2, "w", 1, 1, 33.3)]
    assert [tuple(r) for r in co_brands.co_brand_top(audience, 1).collect()] == rows[:1]
    assert tuple(co_brands.co_brand_kpi(audience).first()) == (3, 2)


def test_co_brand_detail(spark, audience):
    posts = spark.createDataFrame(
        [
            ("p1", "a", "n", "b", "b", D1, "", "@z"),
            ("p2", "a", "n", "b", "b", D1, "", "Z,z."),
            ("p3", "b", "n", "b", "b", D2, "", "z"),
            ("p4", "c", "n", "b", "b", D2, "", "z"),
            ("p5", "b", "n", "b", "b", None, "", "z"),
        ],
        "post_id string, insta_id string, insta_name string, brand_name string, brand_id string, "
        "post_date date, full_link string, tagged_insta_id string",
    )
    months = marts.tagger_months(posts)
    detail = {
        r["section"]: json.loads(r["data"])
        for r in co_brands.co_brand_detail(audience, months, "z").collect()
    }
    assert detail["taggers"] == [
        {"insta_id": "a", "display_name": "Ann", "tag_count": 7, "latest_tag_date": "2024-01-01"}
    ]
    assert detail["monthly"] == [
        {"month": "2024-01-01", "tagger_count": 1},
        {"month": "2024-02-01", "tagger_count": 1},
        {"month": None, "tagger_count": 1},
    ]
    nothing = {
        r["section"]: r["data"]
        for r in co_brands.co_brand_detail(audience, months, "nobody").collect()
    }
    assert nothing == {"taggers": "[]", "monthly": "[]"}


def post_rows(spark, rows):
    data = [
        (p, i, "n", "b", "b", link, "", d, seen, seen, True, tags, 0) for p, i, link, d, seen, tags in rows
    ]
    return spark.createDataFrame(data, POSTS)


def test_tagger_detail(spark):
    t1, t2 = (datetime(2024, 3, n, tzinfo=timezone.utc) for n in (1, 2))
    posts = post_rows(
        spark,
        [
            ("p1", "a", None, D1, t1, ""),
            ("p2", "a", "l2", D2, t1, "old"),
            ("p2", "a", "l2", D2, t2, "new"),
            ("p3", "a", "", None, t1, None),
            ("p4", "b", "", D2, t1, "x"),
        ],
    )
    detail = {
        r["section"]: json.loads(r["data"])
        for r in taggers.tagger_detail(edges_of(spark), posts, "a", ["x", "y"]).collect()
    }
    assert detail["profile"] == {"insta_id": "a", "display_name": "Zed"}
    assert detail["top_brands"] == [{"brand": "z", "count": 7}, {"brand": "w", "count": 1}]
    assert detail["recent_posts"] == [
        {"post_id": "p2", "post_date": "2024-02-01", "tagged_accounts": "new", "full_link": "l2"},
        {"post_id": "p1", "post_date": "2024-01-01", "tagged_accounts": "-", "full_link": ""},
        {"post_id": "p3", "post_date": None, "tagged_accounts": "-", "full_link": ""},
    ]
    missing = taggers.tagger_detail(edges_of(spark), posts, "o'brien", ["x"]).collect()
    assert {r["section"]: r["data"] for r in missing} == {"top_brands": "[]", "recent_posts": "[]"}


def test_ranks_over_many_partitions(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 3), rng.choice(["u", "v", None]), n) for n in range(2000)]
    df = spark.createDataFrame(rows, "k int, s string, n int").repartition(13)
    order = [F.desc("k"), F.asc_nulls_last("s"), F.asc("n")]
    want = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or "", r[2]))
    got = rank_all(df, order).orderBy("rank").collect()
    assert [(r["k"], r["s"], r["n"]) for r in got] == want
    assert [r["rank"] for r in got] == list(range(1, 2001))
    for top_rows in (10_000, 10):
        page = rank_page(df, order, 5, 20, top_rows=top_rows).orderBy("rank").collect()
        assert [(r["k"], r["s"], r["n"]) for r in page] == want[20:25]
        assert [r["rank"] for r in page] == [21, 22, 23, 24, 25]


def test_pages(spark):
    assert page_offset(3, 20) == 40
    df = spark.createDataFrame([(0,), (1,), (20,), (21,)], "n bigint")
    assert [r[0] for r in df.select(page_count(F.col("n"), 20)).collect()] == [0, 1, 1, 2]


def test_long_key_lists_split_a_hot_key(spark):
    before = {
        k: spark.conf.get(k)
        for k in (
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.autoBroadcastJoinThreshold",
        )
    }
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "128k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 300_000
        df = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias(
                "insta_id"
            ),
            F.md5(F.col("id").cast("string")).alias("payload"),
        )
        listed = spark.createDataFrame([("hot",), ("1",), ("2",)], "insta_id string")
        keys = held(listed.distinct())
        assert (keys.rows, keys.text_bytes) == (3, 5)
        kept = keep_matching(df, keys, "insta_id", broadcast_rows=0)
        assert kept.agg(F.count("payload")).first()[0] == n // 3 + 2
        query = kept.groupBy("payload").count()
        query.collect()
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_labels(spark):
    def now(text):
        return F.lit(text).cast("timestamp")

    df = spark.createDataFrame(
        [("2024-01-10T00:00:00Z", date(2024, 1, 10)), (None, date(2024, 1, 10))],
        "t string, d date",
    ).withColumn("t", F.col("t").cast("timestamp"))

    def tone(text):
        return df.select(labels.freshness_tone(F.col("t"), F.col("d"), now(text))).first()[0]

    def age(text):
        return df.select(labels.age_bucket(F.col("t"), now(text))).first()[0]

    assert tone("2024-01-10T12:00:00Z") == "healthy"
    assert tone("2024-01-10T12:00:01Z") == "watch"
    assert tone("2024-01-11T00:00:00Z") == "watch"
    assert tone("2024-01-11T00:00:01Z") == "stale"
    assert age("2024-01-10T00:59:59Z") == "방금 전"
    assert age("2024-01-10T01:00:00Z") == "1시간 전"
    assert age("2024-01-10T23:59:59Z") == "23시간 전"
    assert age("2024-01-12T05:00:00Z") == "2일 전"
    missing = df.filter("t is null").select(
        labels.freshness_tone(F.col("t"), F.col("d"), now("2024-01-10T12:00:00Z")),
        labels.age_bucket(F.col("t"), now("2024-01-10T12:00:00Z")),
        labels.date_label(F.col("t")),
        labels.date_label(F.col("d")),
        labels.month_label(F.col("d")),
    ).first()
    assert tuple(missing) == ("neutral", "-", "-", "2024-01-10", "2024-01")


def test_shares(spark):
    df = spark.createDataFrame([(1, 4), (2, 8), (3, 0)], "rank int, n bigint")
    bars = labels.with_bar_share(df, "n").orderBy("rank").collect()
    assert [r["share"] for r in bars] == [50.0, 100.0, 0.0]
    first = labels.with_first_row_share(df, "n").orderBy("rank").collect()
    assert [r["share"] for r in first] == [100.0, 200.0, 0.0]
    zero = spark.createDataFrame([(1, 0)], "rank int, n bigint")
    assert labels.with_first_row_share(zero, "n").first()["share"] == 0.0
    assert labels.with_bar_share(zero, "n").first()["share"] == 0.0


def test_run_sql_binds_and_upper_cases(spark):
    got = run_sql(
        spark, "select insta_id, 1 as one from {e} where insta_name = :n", {"n": "o'x"},
        e=edges_of(spark).withColumn("insta_name", F.lit("o'x")),
    )
    assert got.columns == ["INSTA_ID", "ONE"]
    assert got.count() == 11


@pytest.mark.parametrize("sql", [
    "create view v as select 1", "create or replace temp view v as select 1", "drop table t",
    "create table t as select 1 as a", "insert into {e} select 1", "insert overwrite t values (1)",
    "delete from t", "update t set a = 1", "truncate table t", "alter table t add column b int",
    "set spark.sql.shuffle.partitions = 3", "reset spark.sql.shuffle.partitions", "cache table t", "refresh table t",
    "add jar 'x.jar'", "load data inpath 'x' into table t", "merge into t using s on t.a = s.a "
    "when matched then delete", "from {e} insert into t select *", "analyze table t compute statistics",
    "select 1; drop table t", "select 1) drop table t --", "with a as (select 1) insert into t select * "
    "from a", "", "declare x int", "begin select 1; end", "explain select 1",
])
def test_run_sql_only_reads(spark, sql):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    tables = {"e": edges_of(spark)} if "{e}" in sql else {}
    with pytest.raises(NotAQuery):
        run_sql(spark, sql, **tables)
    assert not [t.name for t in spark.catalog.listTables() if t.name == "v"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_run_sql_takes_all_kinds_of_queries(spark):
    rows = [tuple(r) for r in run_sql(spark, "with a as (select 2 as x union all select 1) "
                                              "select x, x as y from a order by x -- last").collect()]
    assert rows == [(1, 1), (2, 2)]
    assert run_sql(spark, "values (1), (2);").columns == ["COL1"]


def test_pages_after_a_row_equal_pages_by_offset(spark):
    rng = random.Random(4)
    rows = [(rng.randint(1, 3), rng.choice([None, D1, D2]), rng.choice([f"u{i}", f"v{i}"]))
            for i in range(60)] + [(1, None, None)]
    df = spark.createDataFrame(rows, "n long, d date, id string")
    order = [("n", True), ("d", True), ("id", False)]
    sorting = [F.desc("n"), F.desc("d"), F.asc("id")]
    whole = ranking.rank_page(df, sorting, 100).orderBy("rank").collect()
    for at in (0, 1, 17, 40, 59, 60):
        page = ranking.rank_after(df, order, whole[at].asDict(), 7)
        assert page.orderBy("rank").collect() == whole[at + 1 : at + 8]
    up = [("d", False), ("id", False)]
    rising = ranking.rank_page(df, [F.asc("d"), F.asc("id")], 100).orderBy("rank").collect()
    for at in (0, 5, 30):
        page = ranking.rank_after(df, up, rising[at].asDict(), 5)
        assert page.orderBy("rank").collect() == rising[at + 1 : at + 6]
    plan = ranking.rank_after(df, order, whole[40].asDict(), 7)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("brands", [["x"], ["x", "y"], ["x", "x"], ["nobody"], ["x", "nobody"]])
def test_bitmaps_select_the_same_accounts(spark, brands):
    pairs = [(None, "x")] + [(f"u{i}", b) for i in range(70_000) for b, k in (("x", 2), ("y", 3))
                             if i % k == 0]
    edges = spark.createDataFrame(pairs, "insta_id string, tagged_account string").selectExpr(
        "*", "'n' as insta_name", "1L as tagged_post_count", "date '2024-01-01' as last_tagged_date")
    numbers = account_numbers(edges)
    bitmaps = brand_bitmaps(edges, numbers)
    want = {r[0] for r in selected_accounts(edges, brands).collect()}
    got = [r[0] for r in selected_by_bitmaps(bitmaps, numbers, brands).collect()]
    assert set(got) == want and len(got) == len(want)
    assert selected_size(bitmaps, brands).first()[0] == len(want)


def test_brand_search(spark):
    df = spark.createDataFrame([("Abc",), ("xbC",), ("d",)], "instagram_id string")
    assert {r[0] for r in brand_search(df, "BC").collect()} == {"Abc", "xbC"}


def test_freshness_of_nothing(spark):
    row = freshness(post_rows(spark, [])).first()
    assert tuple(row) == (None, None)


def good_posts(spark):
    t = datetime(2024, 3, 1, tzinfo=timezone.utc)
    return post_rows(
        spark,
        [("p1", "a", "l", D1, t, "@x,y"), ("p2", "b", "l", D2, t, "x"), ("p3", "b", "l", D2, t, None)],
    )


def test_rebuild(spark, tmp_path):
    store = Marts(spark, f"file://{tmp_path}/marts")
    store.rebuild(good_posts(spark))
    first = store.read("account_tagged_accounts")
    assert first.count() == 3
    assert {r["tagged_account"]: r["tagger_ratio"] for r in store.read("mart_co_brand_stats").collect()} == {
        "x": 100.0,
        "y": 50.0,
    }
    bad = good_posts(spark).withColumn("tagged_insta_id", F.lit("@"))
    with pytest.raises(ExpectationError, match="not blank: 3"):
        store.rebuild(bad)
    assert store.read("account_tagged_accounts").count() == 3
    assert first.count() == 3
    more = good_posts(spark).withColumn("tagged_insta_id", F.lit("q"))
    store.rebuild(more)
    assert store.read("account_tagged_accounts").count() == 2


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_of_one_account_open_one_folder(spark, tmp_path):
    posts = good_posts(spark)
    store = Marts(spark, f"file://{tmp_path}/marts")
    store.rebuild(posts)
    edges, recent = store.read("edges_by_account"), store.read("recent_posts")
    for plan in (
        executed(taggers.tagger_profile(edges, "b")),
        executed(taggers.tagger_top_brands(edges, "b", ["y"])),
        executed(taggers.tagger_recent_posts(recent, "b", keyed=True)),
    ):
        assert "PartitionFilters: [isnotnull(account_bucket" in plan and "Window" not in plan
    detail = taggers.tagger_detail(edges, recent, "b", ["y"], keyed=True).collect()
    assert detail == taggers.tagger_detail(
        store.read("account_tagged_accounts"), posts, "b", ["y"]
    ).collect()
    assert taggers.tagger_recent_posts(recent, "nobody", keyed=True).count() == 0


def test_recent_posts_mart(spark):
    t = datetime(2024, 3, 1, tzinfo=timezone.utc)
    rows = [(f"p{n:02}", "a", "l", D1 if n % 2 else D2, t, None) for n in range(30)]
    rows += [("q", "b", "l", None, t, "x"), ("r", None, "l", D1, t, "x")]
    got = marts.recent_posts(post_rows(spark, rows)).collect()
    ids = sorted(r["post_id"] for r in got if r["insta_id"] == "a")
    assert ids == [f"p{n:02}" for n in range(0, 20, 2)]
    assert len(got) == 12


def test_months_of_a_brand_come_from_the_mart(spark, tmp_path):
    store = Marts(spark, f"file://{tmp_path}/marts")
    store.rebuild(good_posts(spark))
    audience = Audience(store.read("account_tagged_accounts"), ["x"])
    months = co_brands.co_brand_monthly(audience, store.read("tagger_months"), "y")
    plan = executed(months)
    assert "PushedFilters: [IsNotNull(tagged_account), EqualTo(tagged_account,y)" in plan
    assert "post_id" not in plan
    assert [tuple(r) for r in months.collect()] == [(D1, 1)]


def test_shown_rows_are_computed_once(spark):
    df = spark.range(5).selectExpr("int(id) + 1 as rank", "id as n")
    plan = executed(labels.with_first_row_share(labels.with_bar_share(df, "n", "b"), "n", name="f"))
    assert "Subquery" not in plan


def test_expectations_name_what_fails(spark):
    posts = good_posts(spark).withColumns(
        {"brand_name": F.lit(None).cast("string"), "post_id": F.lit("p")}
    )
    stage = tagged_post_rows(posts)
    edges = edges_of(spark)
    cross = edges.select("insta_id", F.lit(0).alias("tagged_account_count"))
    found = expectations(
        posts, stage, {"account_tagged_accounts": edges, "cross_brand_accounts": cross}
    )
    failed = {r["check_name"]: r["failures"] for r in found.filter("failures > 0").collect()}
    assert failed["posts.brand_name not null"] == 3
    assert failed["posts unique post_id"] == 1
    assert failed["account_tagged_accounts.insta_id not null"] == 3
    assert failed["cross_brand_accounts.tagged_account_count positive"] == 11
    with pytest.raises(ExpectationError):
        require(found)
    assert quality.null_failures(posts, ["brand_name", "post_id"]).count() == 1


def test_stage_is_judged_without_deriving_it(spark):
    t = datetime(2024, 3, 1, tzinfo=timezone.utc)
    rows = [("p1", "a", "l", D1, t, "@x, @,y,,...,x"), ("p2", None, "l", None, t, " , "), ("p2", "b", "l", D1, t, "x,y"),
            ("p2", "b", "l", D1, t, "x,z"), ("none", None, "l", D2, t, "x"), ("none", "c", "l", D2, t, "x"),
            ("p4", "b", "l", D2, t, None), ("p5", None, "l", None, t, "@,@")]
    posts = post_rows(spark, rows)
    posts = posts.withColumn("post_id", F.nullif("post_id", F.lit("none"))).withColumn(
        "brand_id", F.when(F.col("post_id") == "p1", F.lit(None)).otherwise(F.col("brand_id"))
    )
    for table in (posts, good_posts(spark), posts.limit(0)):
        edges = edges_of(spark)
        built = {"account_tagged_accounts": edges,
                 "cross_brand_accounts": edges.select("insta_id", F.lit(0).alias("tagged_account_count"))}
        ways = [
            {r["check_name"]: r["failures"] for r in expectations(table, stage, built).collect()}
            for stage in (tagged_post_rows(table), None)
        ]
        assert ways[0] == ways[1]
    plan = stage_failures(good_posts(spark))._jdf.queryExecution().optimizedPlan().toString()
    # Nothing but an empty table is exploded where no id repeats.
    assert plan.count("posexplode") == 1 and "LocalRelation <empty>" in plan
