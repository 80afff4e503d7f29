"""Checks, upsert, versions and the file stream."""

from __future__ import annotations

import os
from datetime import date, datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cotag.operators import ingest
from cotag.operators.freshness import freshness
from cotag.plans.load import load_batch, load_runs, split_batch_by_period
from cotag.schemas import BATCH, POSTS
from cotag.sources.snapshots import PERIOD, Delivery, PostTable
from cotag.sources.tables import (
    brand_dim,
    brand_param,
    enabled_brands,
    read_brands,
    read_post_csv,
    routed,
    write_post_csv,
)
from cotag.sources.versions import CommitConflict, Pointer
from cotag.streaming.drops import upsert_drops

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def now():
    return F.lit("2024-02-01T00:00:00Z").cast("timestamp")


def target(spark, *ids, day=date(2024, 1, 1)):
    rows = [
        (i, "acc", "Name", "brand", "b1", "link", "img", day, T0, T0, False, "@x", 1) for i in ids
    ]
    return spark.createDataFrame(rows, POSTS)


def batch(spark, *ids, day="2024-01-05", tags=None):
    rows = [(i, "acc2", "New", "other", "b2", "l2", "i2", day, tags, 0) for i in ids]
    return spark.createDataFrame(rows, BATCH)


@pytest.mark.parametrize(
    ("ids", "message"),
    [
        ([], "no rows"),
        (["a", "a", "b"], r"a\(2\).*1 in all"),
        ([None, None, "a"], r"None\(2\)"),
        ([None, "a"], "1 rows have a blank"),
        (["", "a"], "1 rows have a blank"),
        (["  ", "　", "a"], "2 rows have a blank"),
    ],
)
def test_bad_batches(spark, ids, message):
    with pytest.raises(ingest.BatchError, match=message):
        ingest.validate_batch(batch(spark, *ids))


def test_good_batch(spark):
    assert ingest.validate_batch(batch(spark, "a", "b")).rows == 2


def test_bad_date_fails(spark):
    with pytest.raises(PySparkException):
        ingest.cast_post_date(batch(spark, "a", day="2024-13-01")).collect()


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_upsert_rules(spark, broadcast_rows):
    got = {
        r["post_id"]: r
        for r in ingest.upsert_posts(
            target(spark, "a", "b"), batch(spark, "b", "c"), now(), broadcast_rows=broadcast_rows
        ).collect()
    }
    assert set(got) == {"a", "b", "c"}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["insta_id"], a["active"], a["tagged_insta_id"]) == ("acc", False, "@x")
    kept = ("brand_name", "brand_id", "full_link", "img_src", "post_date", "first_seen_at")
    assert [b[k] for k in kept] == [a[k] for k in kept]
    assert (b["insta_id"], b["insta_name"], b["active"]) == ("acc2", "New", True)
    assert b["tagged_insta_id"] is None
    assert b["last_seen_at"] > a["last_seen_at"]
    assert c["post_date"] == date(2024, 1, 5)
    assert c["first_seen_at"] == c["last_seen_at"]
    assert c["active"] is True


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_only_new_posts_need_a_date(spark, broadcast_rows):
    bad = batch(spark, "a", day="2024-13-01")
    known = ingest.upsert_posts(target(spark, "a"), bad, now(), broadcast_rows=broadcast_rows)
    assert known.first()["post_date"] == date(2024, 1, 1)
    with pytest.raises(Exception, match="2024-13-01"):
        ingest.upsert_posts(target(spark, "b"), bad, now(), broadcast_rows=broadcast_rows).collect()


def test_upsert_twice_is_once_and_disjoint_batches_commute(spark):
    base = target(spark, "a", "b")
    one, two = batch(spark, "a", "c"), batch(spark, "b", "d", tags="@z")

    def apply(df, *batches):
        for x in batches:
            df = ingest.upsert_posts(df, x, now())
        return sorted(map(tuple, df.collect()))

    assert apply(base, one, one) == apply(base, one)
    assert apply(base, one, two) == apply(base, two, one)


def test_small_batch_does_not_shuffle_the_target(spark):
    plan = ingest.upsert_posts(target(spark, "a"), batch(spark, "a"), now())
    big = ingest.check_batch(batch(spark, "a", tags="x" * 1000))
    assert big.text_bytes == len("a" + "acc2" + "New" + "0") + 1000
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text
    assert "hashpartitioning" not in text


def table_of(spark, tmp_path, df):
    table = PostTable(spark, f"file://{tmp_path}/raw")
    table.write(df, table.snapshot(), [])
    return table


def test_load_rewrites_only_touched_periods(spark, tmp_path):
    undated = target(spark, "n", day=None)
    days = target(spark, "a").unionByName(target(spark, "b", day=date(2024, 2, 2)))
    table = table_of(spark, tmp_path, days.unionByName(undated))
    first = table.snapshot()
    second = load_batch(table, batch(spark, "b", "c", day="2024-03-05"), now())
    assert second.number == 2
    assert second.periods["2024-01"] == first.periods["2024-01"]
    assert second.periods["2024-02"] != first.periods["2024-02"]
    assert "2024-03" in second.periods
    rows = {r["post_id"]: r for r in table.read().collect()}
    assert set(rows) == {"a", "b", "c", "n"}
    assert rows["b"]["insta_name"] == "New"
    assert rows["b"]["post_date"] == date(2024, 2, 2)
    assert {r["post_id"] for r in table.read(first).collect()} == {"a", "b", "n"}
    third = load_batch(table, batch(spark, "n"), now())
    assert set(third.periods) == {"2024-01", "2024-02", "2024-03", "undated"}
    assert {r["post_id"]: r["insta_name"] for r in table.read().collect()}["n"] == "New"


def test_failed_load_leaves_the_table(spark, tmp_path):
    table = table_of(spark, tmp_path, target(spark, "a"))
    before = table.snapshot()
    with pytest.raises(ingest.BatchError):
        load_batch(table, batch(spark, "b", "b"), now())
    with pytest.raises(PySparkException):
        load_batch(table, batch(spark, "b", day="2024-13-01"), now())
    assert table.snapshot() == before
    assert table.read().count() == 1


def test_same_delivery_is_loaded_once(spark, tmp_path):
    table = table_of(spark, tmp_path, target(spark, "a"))
    first = Delivery("stream", 1)
    one = load_batch(table, batch(spark, "b"), now(), first)
    assert load_batch(table, batch(spark, "b"), now(), first) == one
    load_batch(table, batch(spark, "b", tags="@newer"), now())  # another writer
    two = load_batch(table, batch(spark, "c"), now(), Delivery("stream", 2))
    assert load_batch(table, batch(spark, "b", tags="@older"), now(), first) == two
    three = load_batch(table, batch(spark, "d"), now(), Delivery("other", 1))
    assert three.streams == {"stream": 2, "other": 1}
    rows = {r["post_id"]: r["tagged_insta_id"] for r in table.read().collect()}
    assert rows == {"a": "@x", "b": "@newer", "c": None, "d": None}


def test_interleaved_loads_both_end_up_in_the_table(spark, tmp_path, monkeypatch):
    table = table_of(spark, tmp_path, target(spark, "a"))
    write, others = PostTable.write, []

    def write_late(self, rows, base, days, *more):
        if not others:  # another writer commits between our read and our write
            others.append(1)
            load_batch(table, batch(spark, "other"), now())
        return write(self, rows, base, days, *more)

    monkeypatch.setattr(PostTable, "write", write_late)
    load_batch(table, batch(spark, "mine"), now(), pause=0.01)
    assert {r["post_id"] for r in table.read().collect()} == {"a", "mine", "other"}
    monkeypatch.setattr(PostTable, "write", lambda *a: (_ for _ in ()).throw(CommitConflict("x")))
    with pytest.raises(CommitConflict):
        load_batch(table, batch(spark, "z"), now(), tries=2, pause=0.01)


def test_known_posts_are_found_by_ids_alone(spark, tmp_path):
    table = table_of(spark, tmp_path, target(spark, *(f"k{n}" for n in range(200))))
    load_batch(table, batch(spark, "k1", "new1", day="2024-03-01"), now())
    plan = table.placed(table.snapshot()).select("post_id", PERIOD)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<post_id:string>" in text
    periods, added = split_batch_by_period(
        table, table.snapshot(), (rows := batch(spark, "k7", "new1", "nobody", day="2024-05-01")),
        ingest.check_batch(rows), 1000,
    )
    assert sorted(periods) == ["2024-01", "2024-03", "2024-05"]
    assert [r["post_id"] for r in added.collect()] == ["nobody"]


@pytest.mark.parametrize("grain", ["yyyy", "yyyy-MM", "yyyy-MM-dd"])
def test_freshness_and_cleaning(spark, tmp_path, grain):
    table = PostTable(spark, f"file://{tmp_path}/raw", grain)
    rows = target(spark, "a").unionByName(target(spark, "n", day=None))
    table.write(rows, table.snapshot(), [])
    # The last load has an earlier stamp than the one before.
    for i, stamp in enumerate(("2024-02-01", "2024-02-02", "2023-06-01")):
        at = F.lit(f"{stamp}T00:00:00Z").cast("timestamp")
        load_batch(table, batch(spark, "b", f"c{i}", day=f"2024-01-0{5 + i}"), at)
        assert table.freshness().collect() == freshness(table.read()).collect()
    before = sorted(map(tuple, table.read().collect()), key=str)
    assert table.clean() == []  # all of it is young
    assert table.clean(grace_hours=0)
    assert sorted(map(tuple, table.read().collect()), key=str) == before
    assert table.snapshot().number == 4
    empty = PostTable(spark, f"file://{tmp_path}/none")
    assert tuple(empty.freshness().first()) == (None, None)


def test_a_pointer_is_moved_once(spark, tmp_path):
    pointer = Pointer(spark, f"file://{tmp_path}/v")
    pointer.move(1, {"a": 1})
    with pytest.raises(CommitConflict):
        pointer.move(1, {"a": 2})
    assert pointer.read() == (1, {"a": 1})


def test_runs_loaded_together_equal_runs_one_by_one(spark, tmp_path):
    one_by_one = PostTable(spark, f"file://{tmp_path}/one")
    together = PostTable(spark, f"file://{tmp_path}/all")
    rows = target(spark, "a", "b")
    for table in (one_by_one, together):
        table.write(rows, table.snapshot(), [])
    runs = [
        batch(spark, "a", "x", "y", tags="@1"),
        batch(spark, "y", "z", day="2024-04-04", tags="@2").withColumn("brand_id", F.lit("b3")),
        batch(spark, "x", "y", "b", day="no date").withColumn("insta_name", F.lit("Newest")),
    ]
    for run in runs:
        load_batch(one_by_one, run, now())
    named = [run.withColumn("run", F.lit(f"r{i}")) for i, run in enumerate(runs)]
    before = together.snapshot().number
    load_runs(together, named[2].unionByName(named[0]).unionByName(named[1]), now())
    assert together.snapshot().number == before + 1
    assert sorted(map(tuple, together.read().collect())) == sorted(
        map(tuple, one_by_one.read().collect()))


def test_csv_round_trip(spark, tmp_path):
    rows = [
        ("a", "i", 'Say "hi", you', "b", "b1", "", "", "2024-01-01", "@x,@y", 2),
        ("b", "i", "two\nlines", "b", "b1", "l", "s", "2024-01-01", None, 0),
    ]
    path = f"{tmp_path}/drops"
    write_post_csv(spark.createDataFrame(rows, BATCH), path, F.lit("b"), F.lit("20240101"))
    got = {r["post_id"]: r for r in read_post_csv(spark, f"{path}/*/*").collect()}
    assert got["a"]["insta_name"] == 'Say "hi", you'
    assert got["a"]["full_link"] is None
    assert got["a"]["tagged_insta_id"] == "@x,@y"
    assert got["b"]["insta_name"] == "two\nlines"
    assert got["b"]["tagged_insta_id"] is None
    again = spark.createDataFrame([("c", *rows[0][1:])], BATCH)
    write_post_csv(again, path, F.lit("b"), F.lit("20240102"))
    write_post_csv(again, path, F.lit("b"), F.lit("20240101"))
    assert read_post_csv(spark, f"{path}/*/*").count() == 2


def csv_text(*lines):
    return ",".join(BATCH.fieldNames()) + "\n" + "".join(f"{line}\n" for line in lines)


def write_file(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_csv_with_byte_order_mark(spark, tmp_path):
    write_file(f"{tmp_path}/in/x.csv", csv_text('a,i,n,b,b1,"l,1",,2024-01-01,"@x,@y",2'), "utf-8-sig")
    row = read_post_csv(spark, f"{tmp_path}/in").first()
    assert (row["post_id"], row["full_link"], row["img_src"]) == ("a", "l,1", None)
    assert row["tagged_insta_id_cnt"] == 2


def test_csv_that_does_not_fit_fails(spark, tmp_path):
    write_file(f"{tmp_path}/in/x.csv", csv_text("a,i,n,b,b1,l,,2024-01-01,@x,two"))
    with pytest.raises(Exception, match="FAILFAST"):
        read_post_csv(spark, f"{tmp_path}/in").collect()


def test_file_stream(spark, tmp_path):
    table = table_of(spark, tmp_path, target(spark, "a"))
    drops = f"{tmp_path}/drops"
    write_file(f"{drops}/brand_key=b/dt=1/x.csv", csv_text("a,i,n,b,b1,l,,2024-01-01,@x,1"))
    write_file(f"{drops}/brand_key=b/dt=2/y.csv", csv_text("b,i,n,b,b1,l,,2024-01-02,@x,1"))
    write_file(f"{drops}/brand_key=b/dt=3/z.csv", csv_text("", "c,i,n,b,b1,l,,,,", "c,i,n,b,b1,l,,,,"))
    rejected = []

    def run():
        query = upsert_drops(
            spark, drops, table.root, f"{tmp_path}/checkpoint",
            now=lambda _: T0, rejected=lambda n, e: rejected.append(str(e)),
        )
        query.awaitTermination()

    run()
    assert {r["post_id"] for r in table.read().collect()} == {"a", "b"}
    assert len(rejected) == 1
    number = table.snapshot().number
    assert number == 2  # one commit for all runs of the backlog
    run()
    assert table.snapshot().number == number
    write_file(f"{drops}/brand_key=b/dt=4/w.csv", csv_text("d,i,n,b,b1,l,,2024-01-02,@x,1"))
    run()
    assert table.snapshot().number == number + 1
    assert table.read().count() == 3


def test_a_run_in_two_files_is_one_batch(spark, tmp_path):
    table = table_of(spark, tmp_path, target(spark, "a"))
    drops = f"{tmp_path}/drops"
    write_file(f"{drops}/brand_key=b/dt=1/x.csv", csv_text("b,i,n,b,b1,l,,2024-01-01,@x,1"))
    write_file(f"{drops}/brand_key=b/dt=1/y.csv", csv_text("b,i,n2,b,b1,l,,2024-01-01,@x,1"))
    write_file(f"{drops}/brand_key=b%23+1/dt=2/x.csv", csv_text("c,i,n,b,b1,l,,2024-01-01,@x,1"))
    write_file(f"{drops}/brand_key=b/dt=2/y.csv", csv_text("d,i,n,b,b1,l,,2024-01-01,@x,1"))
    rejected = []
    query = upsert_drops(
        spark, drops, table.root, f"{tmp_path}/checkpoint",
        now=lambda _: T0, rejected=lambda n, e: rejected.append(str(e)),
    )
    query.awaitTermination()
    with pytest.raises(ingest.BatchError) as direct:
        load_batch(table, read_post_csv(spark, f"{drops}/brand_key=b/dt=1"), now())
    assert rejected == [str(direct.value)]
    assert {r["post_id"] for r in table.read().collect()} == {"a", "c", "d"}


def test_the_stream_of_runs_reads_no_posts(spark, tmp_path):
    table = table_of(spark, tmp_path, target(spark, "a"))
    drops = f"{tmp_path}/drops"
    for day in (1, 2):
        lines = [f"p{day}{i},i,n,b,b1,l,,2024-01-01,@x,1" for i in range(30)]
        write_file(f"{drops}/brand_key=b/dt={day}/x.csv", csv_text(*lines))
    write_file(f"{drops}/brand_key=b/dt=3/x.csv", csv_text())
    query = upsert_drops(spark, drops, table.root, f"{tmp_path}/checkpoint", now=lambda _: T0)
    query.awaitTermination()
    assert table.read().count() == 61
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3  # files


def test_csv_keeps_outer_white_space(spark, tmp_path):
    row = (" p1 ", "i\t", "\tname ", "b", "b1", " l", "s ", "2024-01-01", " x , y ", 2)
    path = f"{tmp_path}/drops"
    write_post_csv(spark.createDataFrame([row], BATCH), path, F.lit("b"), F.lit("20240101"))
    assert tuple(read_post_csv(spark, f"{path}/*/*").first())[: len(row)] == row


def test_brand_records(spark, tmp_path):
    write_file(
        f"{tmp_path}/brands/b.json",
        '{"pos":1,"brand_key":"a","instagram_id":"a1","enabled":true}\n'
        '{"pos":2,"brand_key":"b","instagram_id":"b1"}\n'
        '{"pos":3,"brand_key":"a","instagram_id":"a2","enabled":false,"table":"T"}\n',
    )
    records = read_brands(spark, f"{tmp_path}/brands")
    dim = {r["brand_key"]: r for r in brand_dim(records).collect()}
    assert dim["a"]["instagram_id"] == "a2" and dim["a"]["enabled"] is False
    assert dim["a"]["table"] == "T" and dim["a"]["schema"] == "RAW_DATA"
    assert dim["b"]["enabled"] is True and dim["b"]["table"] == "INSTAGRAM_POSTS"
    assert [r["instagram_id"] for r in enabled_brands(records).collect()] == ["a1"]
    ingest_ids = [r["instagram_id"] for r in enabled_brands(records, True).collect()]
    assert ingest_ids == ["a1", "b1"]


def test_batches_go_to_the_table_of_their_brand(spark):
    dim = brand_dim(spark.createDataFrame(
        [(1, "a", "T1"), (2, "b", None)], "pos int, brand_key string, table string"
    ).selectExpr("pos", "brand_key", "'' as instagram_id", "'' as dag_id", "'' as schedule",
                 "true as enabled", "'S' as schema", "table"))
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("x", 3), (None, 4)], "brand_key string, n int")
    got = {r["n"]: (r["schema"], r["table"]) for r in routed(rows, dim).collect()}
    default = ("RAW_DATA", "INSTAGRAM_POSTS")
    assert got == {1: ("S", "T1"), 2: ("S", default[1]), 3: default, 4: default}


def test_brand_param(spark):
    df = spark.createDataFrame([(" a, ,b ,,c,\td\n,\u00a0e\u00a0,\t",)], "t string")
    assert df.select(brand_param(F.col("t"))).first()[0] == ["a", "b", "c", "d", "e"]
