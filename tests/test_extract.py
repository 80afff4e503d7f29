"""Page fields, filters and the end of a grid, against plain Python."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timezone
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from cotag.functions.joins import held
from cotag.operators import extract

IMAGES = "array<struct<alt: string, src: string>>"


def one(spark, value, kind, *columns):
    return spark.createDataFrame([(value,)], f"v {kind}").select(*columns).first()


def test_page_links(spark):
    html = (
        '<a href="/x/p/1/?a=1">1</a><a class="k" href=\'/x/p/2/\'>2</a>'
        '<a href="/x/p/1/">again</a><a href="/x/p/1/c/9/">comment</a>'
        '<a href="/about">no post</a><link href="/x/p/3/"><a data-href="/x/p/4/">'
    )
    row = one(spark, html, "string", extract.page_links(F.col("v")).alias("r"))
    assert row["r"] == ["/x/p/1/", "/x/p/2/"]


def test_page_links_as_a_browser_reads_them(spark):
    html = (
        "<A HREF=/u/p/1/>1</A><a href=/u/p/2/ class=x>2</a><!-- <a href='/u/p/3/'> -->"
        '<script>x = \'<a href="/u/p/4/">\'</script><a href="/u/p/5/&amp;b&lt;?q">5</a>'
        "<a\nHref = '/u/p/6/'>6</a><abbr href='/u/p/7/'>"
    )
    row = one(spark, html, "string", extract.page_links(F.col("v")).alias("r"))
    assert row["r"] == ["/u/p/1/", "/u/p/2/", "/u/p/5/&b<", "/u/p/6/"]


class Anchors(HTMLParser):
    """Links of a page by Python's own parser."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        href = dict(reversed(attrs)).get("href") or ""
        if tag == "a" and "/p/" in href and "/c/" not in (link := href.split("?")[0]):
            self.found.append(link)


HOSTILE = [
    '<a title="a>b" href="/u/p/1/">x</a>', "<a title='it is <b>' href='/u/p/2/'>",
    '<a title="<!--" href="/u/p/3/">x</a> --> <a href="/u/p/4/">',
    '<a data-x=\'href="/u/p/5/"\' href="/u/p/6/">', '<a href="/u/p/7/"class="k">', '<a/href="/u/p/8/">',
    '<img alt="> <a href=/u/p/9/>"><a href=/u/p/10/>', '<!-- <a href="/u/p/11/"> --><a href="/u/p/12/">',
    "<script>if (a<b) s = '<a href=\"/u/p/13/\">'</script ><a href='/u/p/14/'>",
    '<style>a{} <a href="/u/p/15/"></style><a\n\thref\n=\n"/u/p/16/">', '<abbr href="/u/p/17/"><A HREF="/u/p/18/">',
    '<a href="/u/p/19/" href="/u/p/20/">', '<a hreflang="x" href="/u/p/21/">', '<a x="1\'2" href="/u/p/22/">',
    '< a href="/u/p/23/">', '<!DOCTYPE html><a href="/u/p/24/?a>b">', '<a href="/u/p/25/">' * 3,
    '<a b=c/d e href="/u/p/26/"/>', '<p title=\'"\'><a href="/u/p/27/" t=\'"\'>', "no tags at all", "",
]


def test_links_of_hostile_pages_by_another_parser(spark):
    rng = random.Random(1)
    pages = [*HOSTILE, *("".join(rng.choices(HOSTILE, k=4)) for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(pages)), "n int, html string")
    got = {r["n"]: r["links"] for r in df.select("n", extract.page_links(F.col("html")).alias("links")).collect()}
    for n, page in enumerate(pages):
        parser = Anchors()
        parser.feed(page)
        assert got[n] == list(dict.fromkeys(parser.found)), page


def test_elements_of_plain_text_hold_no_links(spark):
    html = '<textarea><a href="/u/p/1/"></textarea><title><a href="/u/p/2/"></title><a href=/u/p/3/>'
    row = one(spark, html, "string", extract.page_links(F.col("v")).alias("r"))
    assert row["r"] == ["/u/p/3/"]


def test_long_pages_cost_no_stack(spark):
    pages = [
        "<a " + "x='1>' " * 50_000 + "href='/u/p/1/'>", "<!--" + "<a href='/u/p/2/'>" * 50_000 + "-->",
        "<a title=\"" + "y" * 500_000 + "\" href=/u/p/3/>", "<" * 200_000 + "<a href=/u/p/4/>",
        "<script>" + "</s" * 200_000 + "</script><a href=/u/p/5/>", "<a href=/u/p/6/>" * 50_000,
    ]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    rows = df.select(extract.page_links(F.col("html")).alias("l")).collect()
    assert [r["l"] for r in rows] == [["/u/p/1/"], [], ["/u/p/3/"], ["/u/p/4/"], ["/u/p/5/"], ["/u/p/6/"]]


def test_one_pattern_for_business_and_for_days(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "Our FASHION designer. (brand"), ("c", "clothing (Brand)")],
                               "insta_id string, body_text string")
    found = extract.business_accounts(df)
    assert {r[0] for r in found.collect()} == {"b", "c"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and "Contains" not in plan
    plan = df.select(extract.iso_instant(F.col("body_text")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan


def test_an_instant_is_cut_once_a_row(spark):
    df = spark.createDataFrame([("2024-03-28T23:30+0930",)], "v string")
    found = df.select(extract.iso_instant(F.col("v")).alias("r"))
    assert found.first()["r"].timestamp() == datetime(2024, 3, 28, 14, tzinfo=timezone.utc).timestamp()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and plan.count("split(") == 2


def test_a_grid_of_any_length_is_numbered_by_a_sort(spark):
    rows = [(b, s, f'<a href="/u/p/{(n * 7) % 50}/">') for b in ("a", "b") for s in range(30) for n in range(s, s + 9)]
    rows += [(None, 0, '<a href="/u/p/1/">')]
    df = spark.createDataFrame(rows, "brand_id string, scroll int, html string").repartition(7)
    want = {}
    for b, s, html in sorted(((b, s, h) for b, s, h in rows), key=lambda r: (str(r[0]), r[1])):
        grid = want.setdefault(b, {})
        grid.setdefault(html[9:-2], s)
    got = {}
    for r in extract.grid_positions(df).collect():
        got.setdefault(r["brand_id"], {})[r["grid_pos"]] = r["href"]
    for b, grid in want.items():
        assert sorted(got[b]) == list(range(1, len(grid) + 1))
        scrolls = [grid[got[b][n]] for n in sorted(got[b])]
        assert scrolls == sorted(scrolls)


def test_held_is_scanned_once(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("t"), F.array(F.lit("ab")).alias("a"))
    side = held(df, most=F.max("t"))
    assert (side.rows, side.metrics) == (1000, {"most": "999"})
    assert side.text_bytes == sum(len(str(i)) for i in range(1000)) + 4 * 1000  # "[ab]"
    assert held(df.limit(0)).rows == 0
    assert held(df.filter("t = 'x'"), n=F.count("t")).metrics == {"n": 0}


def expected_mentions(images):
    """Python's own reading of the rule."""
    tags = []
    for alt, _ in images:
        if (alt or "").startswith(("Photo by ", "Photo shared by ")):
            tags += [m.rstrip(".,!?:;") for m in re.findall(r"@[\w.]+", alt)]
    return list(dict.fromkeys(tags))


@pytest.mark.parametrize(
    "images",
    [
        [("Photo by A with @b.c., @D! @b.c", "s")],
        [("Photo by A @x", "s"), ("Photo shared by B @y @x", "t"), ("Photo @z", "u")],
        [("Photo by 가 @한글_계정. @é½² @áb @a-b", "s")],
        [("Photo by A @... @", "s")],
        [("", "s"), (None, "t")],
        [],
    ],
)
def test_mentions(spark, images):
    row = one(spark, images, IMAGES, extract.mentions(F.col("v")).alias("r"))
    assert row["r"] == expected_mentions(images)


@pytest.mark.parametrize(
    ("og", "images", "expected"),
    [
        ("og", [("Photo by x", "a")], "og"),
        ("", [("Photo by x", ""), ("Photo by x", "b"), ("no", "c")], "b"),
        (None, [("no", "c")], ""),
    ],
)
def test_image_src(spark, og, images, expected):
    df = spark.createDataFrame([(og, images)], f"og string, im {IMAGES}")
    assert df.select(extract.image_src(F.col("og"), F.col("im"))).first()[0] == expected


@pytest.mark.parametrize(
    ("href", "desc", "expected"),
    [
        ("/Ann/p/1/", "bob on May 1, 2024: x", "ann"),
        ("/p/1/", "Bob.x on May 1, 2024: x", "bob.x"),
        ("/p/1/", "  Bob ON may 1, 2024", "bob"),
        ("/ann/reel/1/", "nothing", "unknown"),
        ("/ann/p", "", "unknown"),
        ("", None, "unknown"),
        (None, None, "unknown"),
        ("//Ann//p//1", None, "ann"),
    ],
)
def test_owner(spark, href, desc, expected):
    df = spark.createDataFrame([(href, desc)], "h string, d string")
    assert df.select(extract.owner_id(F.col("h"), F.col("d"))).first()[0] == expected


@pytest.mark.parametrize(
    ("title", "owner", "expected"),
    [
        ("Ann B on Instagram: x", "ann", "Ann B"),
        (' " Ann " on instagram: x', "bob", "Ann"),
        ("ANN on Instagram: x", "ann", "unknown"),
        ("unknown on Instagram: x", "unknown", "unknown"),
        ('"" on Instagram: x', "ann", "unknown"),
        ("Ann", "ann", "unknown"),
        ("a\nb on Instagram: x", "ann", "unknown"),
        ("A on Instagram: b on Instagram: x", "ann", "A"),
        (None, "ann", "unknown"),
    ],
)
def test_display_name(spark, title, owner, expected):
    df = spark.createDataFrame([(title, owner)], "t string, o string")
    assert df.select(extract.display_name(F.col("t"), F.col("o"))).first()[0] == expected


@pytest.mark.parametrize(
    ("iso", "desc", "day", "failed"),
    [
        ("2024-03-01T15:30:00Z", "", date(2024, 3, 2), False),
        ("2024-03-01T14:59:59.000Z", "", date(2024, 3, 1), False),
        ("2024-03-01T10:00:00+00:00", "x", date(2024, 3, 1), False),
        (None, "a on March 5, 2024: x", date(2024, 3, 5), False),
        ("soon", "a on March 5, 2024: x", date(2024, 3, 5), False),
        ("10:00:00", "a on March 5, 2024: x", date(2024, 3, 5), False),
        ("2024-03", "", None, False),
        ("2024-3-1T10:00:00Z", "", None, False),
        ("20240328T010000Z", "", date(2024, 3, 28), False),
        ("20240328T153000+0000", "", date(2024, 3, 29), False),
        ("2024-03-01T16:00", "", date(2024, 3, 2), False),
        ("2024-03-01", "", date(2024, 3, 1), False),
        ("2024-03-01T23:30:00.5+09:00", "", date(2024, 3, 1), False),
        ("2024-03-01T23:30:00-01", "", date(2024, 3, 2), False),
        ("2024-13-01T10:00:00Z", "a on March 5, 2024: x", date(2024, 3, 5), False),
        (None, "nothing", None, False),
        (None, None, None, False),
        (None, "a on Octember 5, 2024", None, True),
        (None, "a on February 30, 2024", None, True),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_post_date(spark, iso, desc, day, failed, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(
            [(iso, desc, True)], "time_iso string, meta_desc string, page_ok boolean"
        )
        row = extract.dated_pages(df).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["post_date"] == day
    assert row["page_failed"] is failed


def test_run_days(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 12, 31, 18, 0, tzinfo=timezone.utc),)], "t timestamp"
    )
    row = df.select(
        extract.batch_day(F.col("t")),
        extract.file_day(F.col("t")),
        extract.next_day(F.to_date("t")),
        extract.last_day(F.to_date("t")),
    ).first()
    assert tuple(row) == ("2025-01-01", "20241231", date(2025, 1, 1), date(2024, 12, 30))


def python_end(days, target, streak):
    """Walks one grid as a crawler would."""
    run = 0
    for pos, day in days:
        if day is None:
            continue
        run = run + 1 if day < target else 0
        if run >= streak:
            return pos
    return None


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
@pytest.mark.parametrize("streak", [1, 2, 5])
def test_streak_ends_equal_a_sequential_walk(spark, block, streak):
    rng = random.Random(block * 10 + streak)
    target = date(2024, 1, 10)
    rows, expected = [], {}
    for b in range(60):
        older = rng.choice([0.2, 0.5, 0.8, 1.0])
        missing = rng.choice([0.0, 0.3])
        days = []
        for pos in range(1, rng.randint(1, 40)):
            if rng.random() < missing:
                days.append((pos, None))
            else:
                days.append((pos, date(2024, 1, 9 if rng.random() < older else 10)))
        rows += [(f"b{b}", pos, day) for pos, day in days]
        end = python_end(days, target, streak)
        if end is not None:
            expected[f"b{b}"] = end
    df = spark.createDataFrame(rows, "brand_id string, grid_pos bigint, post_date date")
    got = extract.streak_ends(df, "2024-01-10", streak, block).collect()
    assert {r["brand_id"]: r["end_pos"] for r in got} == expected
    for broadcast_rows in (1000, 0):
        cut = extract.cut_at_streak(df, "2024-01-10", streak, block, broadcast_rows)
        kept = {(r["brand_id"], r["grid_pos"]) for r in cut.collect()}
        assert kept == {(b, p) for b, p, _ in rows if p < expected.get(b, 10**9)}


def test_no_target_keeps_all(spark):
    df = spark.createDataFrame(
        [("b", 1, date(2024, 1, 1))], "brand_id string, grid_pos bigint, post_date date"
    )
    assert extract.cut_at_streak(df, None).count() == 1
    assert extract.on_day(df, None).count() == 1


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_business_filter(spark, broadcast_rows):
    posts = spark.createDataFrame(
        [(i, f"p{n}") for n, i in enumerate(["shop", "ann", "unknown", "unknown", "new", None])],
        "insta_id string, post_id string",
    )
    profiles = spark.createDataFrame(
        [
            ("shop", "12 posts VIEW SHOP"),
            ("shop", "nothing"),
            ("ann", "I like clothes"),
            ("unknown", "view shop"),
        ],
        "insta_id string, body_text string",
    )
    kept = extract.drop_business(posts, profiles, broadcast_rows)
    assert kept.columns == ["insta_id", "post_id"]
    assert sorted(r["post_id"] for r in kept.collect()) == ["p1", "p2", "p3", "p4", "p5"]


def fetched(spark):
    schema = (
        "brand_id string, brand_name string, grid_pos bigint, href string, meta_title string, "
        f"meta_desc string, og_image string, time_iso string, images {IMAGES}, page_ok boolean"
    )
    day, old, new = "2024-01-10T01:00:00Z", "2024-01-09T01:00:00Z", "2024-01-11T01:00:00Z"
    image = [("Photo by x with @A. @b", "src")]
    rows = [
        ("Brand", "B", 1, "/ann/p/1/", "Ann on Instagram: x", "", "", new, image, True),
        ("Brand", "B", 2, "/ann/p/2/", "Ann on Instagram: x", "", "", day, image, True),
        ("Brand", "B", 3, "/brand/p/3/", "", "", "", day, image, True),
        ("Brand", "B", 4, "/kasina/p/4/", "", "", "", day, image, True),
        ("Brand", "B", 5, "/shop/p/5/", "", "", "", day, image, True),
        ("Brand", "B", 6, "/ann/p/6/", "", "", "", None, image, True),
        ("Brand", "B", 7, "/ann/p/7/", "", "", "", day, image, False),
        *(("Brand", "B", p, f"/ann/p/{p}/", "", "", "", old, image, True) for p in range(8, 13)),
        ("Brand", "B", 13, "/ann/p/13/", "", "", "", day, image, True),
    ]
    profiles = [("shop", "View shop")]
    return (
        spark.createDataFrame(rows, schema),
        spark.createDataFrame(profiles, "insta_id string, body_text string"),
    )


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_collection_run(spark, broadcast_rows):
    pages, profiles = fetched(spark)
    got = extract.collect_posts(pages, profiles, "2024-01-10", broadcast_rows).collect()
    assert [tuple(r) for r in got] == [
        ("2", "ann", "unknown", "B", "Brand", "https://www.instagram.com/ann/p/2/", "src",
         "2024-01-10", "@A,@b", 2)
    ]
    judged = extract.judged_pages(pages, profiles, "2024-01-10", broadcast_rows)
    counts = {r["outcome"]: r["pages"] for r in extract.outcome_counts(judged).collect()}
    assert counts == {"collected": 1, "filtered": 3, "detail_failed": 1, "date_failed": 1}


def test_filter_switches(spark):
    pages, profiles = fetched(spark)

    def ids(**switches):
        return {r["post_id"] for r in extract.collect_posts(pages, profiles, "2024-01-10", **switches).collect()}

    assert ids() == {"2"}
    assert ids(filter_self_tag=False) == {"2", "3"}
    assert ids(filter_business=False) == {"2", "4", "5"}
    assert ids(filter_self_tag=False, filter_business=False) == {"2", "3", "4", "5"}


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_many_runs_equal_single_runs(spark, broadcast_rows):
    pages, profiles = fetched(spark)
    days = {0: "2024-01-10", 1: "2024-01-09", 2: None}
    in_runs = pages.select("*", F.explode(F.array(*map(F.lit, range(4)))).alias("run_id"))
    runs = spark.createDataFrame(
        [("Brand", n, d) for n, d in days.items()], "brand_id string, run_id int, target_day string"
    )
    got = extract.collect_runs(in_runs, runs, profiles, broadcast_rows).collect()
    for n, day in days.items():
        alone = {tuple(r) for r in extract.collect_posts(pages, profiles, day).collect()}
        assert {tuple(r)[1:] for r in got if r["run_id"] == n} == alone
    assert {r["run_id"] for r in got} <= set(days)


def test_repeated_links_take_one_position(spark):
    link = '<a href="/x/p/{}/">'.format
    rows = [
        ("b", 0, link(1) + link(2) + link(1)), ("b", 1, link(2) + link(3) + link(1) + link(4)),
        ("c", 0, link(2)), ("b", 2, None), ("b", 3, "no links"),
    ]
    df = spark.createDataFrame(rows, "brand_id string, scroll int, html string").repartition(3)
    got = sorted(map(tuple, extract.grid_positions(df).collect()))
    want = [("b", n, f"/x/p/{n}/") for n in range(1, 5)]
    assert got == [*want, ("c", 1, "/x/p/2/")]


def test_fields_of_missing_and_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "<main><IMG ALT=Photo SRC=\'a&amp;b\'><p></main><time>")]
    df = extract.page_fields(spark.createDataFrame(rows, "page_id int, html string"))
    got = {r["page_id"]: r for r in df.collect()}
    for n in (1, 2):
        assert tuple(got[n])[1:] == ("", "", "", None, [])
    assert [tuple(i) for i in got[3]["images"]] == [("Photo", "a&b")]
    assert got[3]["time_iso"] is None
