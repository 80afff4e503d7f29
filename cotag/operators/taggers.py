"""Questions about the accounts that tag a set of brands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotag.functions.joins import Side, held, keep_matching
from cotag.functions.layout import of_account
from cotag.functions.ranking import page_offset, rank_after, rank_page, rank_top
from cotag.functions.sections import list_section, object_section
from cotag.functions.text import known_name
from cotag.operators.audience import Audience, require_brands
from cotag.operators.marts import RECENT_POSTS

PAGE_SIZE = 20
TOP_BRANDS = 10
#: Bytes of text that a listed account is reckoned with when its list might be broadcast.
ACCOUNT_BYTES = 256


def _or_id(name: Column) -> Column:
    return F.coalesce(name, F.col("insta_id"))


def tagger_kpi(audience: Audience) -> DataFrame:
    """One row: accounts, mean tags per account, and the account with most tags."""
    best = F.min(
        F.struct(
            (-F.col("tag_count")).alias("order"),
            F.col("insta_id"),
            _or_id(F.col("known_name")).alias("name"),
            F.col("tag_count"),
        )
    )
    return audience.accounts.agg(
        F.count("insta_id").alias("total_accounts"),
        F.round(F.coalesce(F.avg("tag_count"), F.lit(0.0)), 1).alias("avg_tag_count"),
        best.alias("_best"),
    ).select(
        "total_accounts",
        "avg_tag_count",
        F.col("_best.insta_id").alias("top_tagger_id"),
        F.col("_best.name").alias("top_tagger_name"),
        F.col("_best.tag_count").alias("top_tagger_count"),
    )


def kpi_defaults(kpi: DataFrame) -> DataFrame:
    """Missing numbers of a figure row as 0, empty texts as NULL."""
    numbers = [f.name for f in kpi.schema if f.dataType.typeName() in ("long", "double")]
    texts = [f.name for f in kpi.schema if f.dataType.typeName() == "string"]
    return kpi.fillna(0, numbers).withColumns(
        {c: F.nullif(F.col(c), F.lit("")) for c in texts}
    )


def top_tagger(audience: Audience) -> DataFrame:
    """The account with most tags over the selected brands; the id where no name is known."""
    return (
        audience.accounts.orderBy(F.desc("tag_count"), F.asc("insta_id"))
        .limit(1)
        .select("insta_id", _or_id(F.col("known_name")).alias("display_name"), "tag_count")
    )


#: Columns that a list is ordered by, and whether they fall.
_LIST_ORDER = ("tag_count", True), ("latest_tag_date", True), ("insta_id", False)


def _list_order() -> list[Column]:
    return [F.desc(column) if falls else F.asc(column) for column, falls in _LIST_ORDER]


def _with_other_brands(
    audience: Audience, accounts: DataFrame, cross_brand: DataFrame | None, size: int
) -> DataFrame:
    """``accounts`` (``size`` selected ones) with ``other_brand_count``.

    A selected account tags every brand of the list, and edges are unique, so the number of
    others is its number of tagged accounts, which a mart holds, less the length of the list.
    Without that mart the edges of the accounts are counted.
    """
    ids = Side(accounts, size, size * ACCOUNT_BYTES)
    if cross_brand is not None:
        others = (F.col("tagged_account_count") - F.lit(len(audience.brands))).cast("bigint")
        known = cross_brand.select("insta_id", others.alias("other_brand_count"))
        return known.join(ids.prepared(audience.broadcast_rows), "insta_id")
    outside = audience.edges.filter(~F.col("tagged_account").isin(audience.brands))
    counted = (
        keep_matching(outside, ids, "insta_id", audience.broadcast_rows)
        .groupBy("insta_id")
        .agg(F.count(F.lit(1)).alias("other_brand_count"))
    )
    return accounts.join(counted, "insta_id", "left").withColumn(
        "other_brand_count", F.coalesce("other_brand_count", F.lit(0))
    )


def _listed(audience: Audience) -> DataFrame:
    return audience.accounts.select(
        "insta_id", _or_id(F.col("known_name")).alias("insta_name"), "tag_count", "latest_tag_date"
    )


_LISTED = ("insta_id", "insta_name", "tag_count", "latest_tag_date", "other_brand_count")


def _shown(audience: Audience, cross_brand: DataFrame | None) -> DataFrame:
    rows = _with_other_brands(audience, _listed(audience), cross_brand, audience.size)
    shown = F.col("tag_count") * F.greatest(F.col("other_brand_count"), F.lit(1))
    return rows.withColumn("tag_count", shown).select(*_LISTED)


def tagger_list(
    audience: Audience,
    limit: int = PAGE_SIZE,
    offset: int = 0,
    cross_brand: DataFrame | None = None,
) -> DataFrame:
    """A page of accounts by ``tag_count``.

    ``tag_count`` is the figure the serving layer has always shown: the tags over the selected
    brands *times* the number of other brands (at least once), because the listing joins both
    before it sums. :func:`tagger_list_exact` does not. With the ``cross_brand`` mart no edge is
    read again.
    """
    return rank_page(_shown(audience, cross_brand), _list_order(), limit, offset)


def tagger_list_after(
    audience: Audience,
    last: Mapping[str, object],
    limit: int = PAGE_SIZE,
    cross_brand: DataFrame | None = None,
) -> DataFrame:
    """The page of :func:`tagger_list` that follows the row ``last`` of the page before.

    ``last`` has that row's rank, tag count, day and id. However deep the page lies, it is a
    filtered top-k.
    """
    return rank_after(_shown(audience, cross_brand), _LIST_ORDER, last, limit)


def tagger_list_exact(
    audience: Audience,
    limit: int = PAGE_SIZE,
    offset: int = 0,
    cross_brand: DataFrame | None = None,
) -> DataFrame:
    """A page of accounts by their true tag count.

    The order needs the selection only, so other brands are looked up for the page alone.
    """
    page = held(rank_page(_listed(audience), _list_order(), limit, offset))
    rows = _with_other_brands(audience, page.df, cross_brand, page.rows)
    return rows.select("rank", *_LISTED).orderBy("rank")


def tagger_page(audience: Audience, page: int = 1, page_size: int = PAGE_SIZE) -> DataFrame:
    """:func:`tagger_list` by 1-based page."""
    return tagger_list(audience, page_size, page_offset(page, page_size))


def tagger_count(audience: Audience) -> DataFrame:
    """Size of the selection."""
    return audience.totals.agg(F.count(F.lit(1)).alias("total"))


def tagger_top_brands(edges: DataFrame, insta_id: str, brands: Sequence[str]) -> DataFrame:
    """The account's most tagged accounts outside the brand list."""
    return (
        of_account(edges, insta_id)
        .filter(~F.col("tagged_account").isin(require_brands(brands)))
        .select("tagged_account", "tagged_post_count")
        .orderBy(F.desc("tagged_post_count"), F.asc("tagged_account"))
        .limit(TOP_BRANDS)
    )


def tagger_recent_posts(posts: DataFrame, insta_id: str, keyed: bool = False) -> DataFrame:
    """The account's newest posts, one row per post id.

    ``keyed`` says that ``post_id`` is the key of ``posts`` (the raw table and the mart of recent
    posts keep it so); nothing is then grouped by it.
    """
    rows = of_account(posts, insta_id)
    if not keyed:
        newest = Window.partitionBy("post_id").orderBy(
            F.desc("post_date"), F.desc("last_seen_at")
        )
        rows = rows.withColumn("_n", F.row_number().over(newest)).filter("_n = 1")
    return (
        rows.orderBy(F.desc("post_date"), F.asc("post_id"))
        .limit(RECENT_POSTS)
        .select(
            "post_id",
            "post_date",
            F.coalesce(F.nullif("tagged_insta_id", F.lit("")), F.lit("-")).alias(
                "tagged_accounts"
            ),
            F.coalesce("full_link", F.lit("")).alias("full_link"),
        )
    )


def tagger_profile(edges: DataFrame, insta_id: str) -> DataFrame:
    """The account's id and best known name, the id where none is known."""
    return (
        of_account(edges, insta_id)
        .groupBy("insta_id")
        .agg(known_name(F.col("insta_name")).alias("_name"))
        .select("insta_id", _or_id(F.col("_name")).alias("display_name"))
    )


def tagger_detail(
    edges: DataFrame,
    posts: DataFrame,
    insta_id: str,
    brands: Sequence[str],
    keyed: bool = False,
) -> DataFrame:
    """Profile, top brands and recent posts of one account as (section, JSON).

    Both tables may be those in account folders; of each, one folder is then read.
    """
    top = rank_top(
        tagger_top_brands(edges, insta_id, brands).select(
            F.col("tagged_account").alias("brand"), F.col("tagged_post_count").alias("count")
        ),
        [F.desc("count"), F.asc("brand")],
        TOP_BRANDS,
        "_rank",
    )
    recent = rank_top(
        tagger_recent_posts(posts, insta_id, keyed),
        [F.desc("post_date"), F.asc("post_id")],
        RECENT_POSTS,
        "_rank",
    ).withColumn("post_date", F.col("post_date").cast("string"))
    return (
        object_section("profile", tagger_profile(edges, insta_id))
        .unionByName(list_section("top_brands", top, ["_rank"]))
        .unionByName(list_section("recent_posts", recent, ["_rank"]))
    )
