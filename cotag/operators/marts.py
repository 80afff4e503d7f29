"""Mart layer: account-to-tag edges and the summaries built on them.

Every mart has one plan with map-side partial aggregation in front of each shuffle, and no
shuffle carries all rows of one account or one tagged account to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotag.functions.text import best_name, known_name
from cotag.operators.stage import distinct_tags

#: Tagged accounts in one part of an account's list.
LIST_PART = 4096
#: Newest posts kept per account.
RECENT_POSTS = 10


def account_tagged(posts: DataFrame) -> DataFrame:
    """Per account and tagged account: name, first and last day, number of posts.

    Takes the raw table, whose key is ``post_id``: see :func:`distinct_tags`.
    """
    return _edges(distinct_tags(posts), F.count("post_id"))


def account_tagged_from_stage(stage: DataFrame) -> DataFrame:
    """The same mart from stage rows of any origin, counting distinct posts by shuffle."""
    return _edges(stage, F.count_distinct("post_id"))


def _edges(rows: DataFrame, posts: Column) -> DataFrame:
    return (
        rows.groupBy("insta_id", "tagged_account")
        .agg(
            best_name(F.col("insta_name")).alias("insta_name"),
            F.min("post_date").alias("first_tagged_date"),
            F.max("post_date").alias("last_tagged_date"),
            posts.alias("tagged_post_count"),
        )
        .select(
            "insta_id",
            "insta_name",
            "tagged_account",
            "first_tagged_date",
            "last_tagged_date",
            "tagged_post_count",
        )
    )


def account_lists(edges: DataFrame, part_rows: int = LIST_PART) -> DataFrame:
    """Each account's tagged accounts in order, as parts: (insta_id, part, name, edges, tags).

    Edges are range sorted by account and tagged account, so Spark's sampling sets the cuts and a
    hot account lies in many tasks, whatever its tags begin with. A part is at most ``part_rows``
    neighbours of one task; parts of an account are numbered in order, not densely. ``tags`` is
    NULL for a part without tags.
    """
    order = ("insta_id", "tagged_account")
    sorted_rows = edges.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # the partition above bit 33, the row below it
    placed = sorted_rows.select("insta_id", "insta_name", "tagged_account", place.alias("_at"))
    block = F.shiftright("_at", 33) * F.lit(1 << 33) + F.floor(
        F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(part_rows)
    )
    tag = F.col("tagged_account")
    return placed.groupBy("insta_id", block.alias("part")).agg(
        known_name(F.col("insta_name")).alias("name"),
        F.count(F.lit(1)).alias("edges"),
        F.when(F.count(tag) > 0, F.array_join(F.sort_array(F.collect_list(tag)), ", ")).alias("tags"),
    )


def cross_brand_accounts(edges: DataFrame, part_rows: int = LIST_PART) -> DataFrame:
    """Per account: name, number of tagged accounts and their ordered list as text.

    An account that holds a large part of all edges (posts without a known author share one)
    is not sorted in one task: only the finished parts of :func:`account_lists` meet in its row.
    """
    part = F.when(F.col("tags").isNotNull(), F.struct("part", "tags"))
    ordered = F.transform(F.sort_array(F.collect_list(part)), lambda p: p["tags"])
    return account_lists(edges, part_rows).groupBy("insta_id").agg(
        best_name(F.col("name")).alias("insta_name"),
        F.sum("edges").alias("tagged_account_count"),
        F.when(F.count("tags") > 0, F.array_join(ordered, ", ")).alias("brands_tagged"),
    )


def tagger_months(posts: DataFrame) -> DataFrame:
    """Per tagged account, month and tagger: distinct posts.

    Its key spreads a hot tagged account over tasks. Stored, it also serves the months of one
    brand for any selection of taggers.
    """
    return (
        distinct_tags(posts)
        .groupBy("tagged_account", F.trunc("post_date", "month").alias("month"), "insta_id")
        .agg(F.count("post_id").alias("post_count"))
    )


def month_runs() -> Column:
    """One number per tagged account and month, by which rows of :func:`tagger_months` are sorted.

    It keeps the rows of an account together, and of a month in it. Spark sorts a single number by
    radix, whereas texts that begin alike (and accounts are alike in nearly all rows of a task) are
    compared row by row.
    """
    month = F.coalesce(F.unix_date("month"), F.lit(-(1 << 31))).cast("long")
    low = month.bitwiseAND(F.lit((1 << 32) - 1))
    return F.shiftleft(F.hash("tagged_account").cast("long"), 32).bitwiseOR(low)


def months_of_brands(months: DataFrame) -> DataFrame:
    """Per tagged account and month: distinct taggers and distinct posts, from finer rows."""
    return months.groupBy("tagged_account", "month").agg(
        F.count("insta_id").alias("unique_tagger_count"),
        F.sum("post_count").alias("post_count"),
    )


def brand_monthly_tagging(posts: DataFrame) -> DataFrame:
    """Per tagged account and month: distinct taggers and distinct posts.

    Two plain steps instead of two distinct counts, so no row is expanded.
    """
    return months_of_brands(tagger_months(posts))


def recent_posts(posts: DataFrame, rows: int = RECENT_POSTS) -> DataFrame:
    """The newest posts of every account, by day, then post id.

    ``post_id`` is the key of ``posts``. Each task first cuts its own rows of an account, so an
    account with very many posts sends few of them on.
    """
    newest = Window.partitionBy("insta_id").orderBy(F.desc("post_date"), F.asc("post_id"))
    return (
        posts.select("insta_id", "post_id", "post_date", "tagged_insta_id", "full_link")
        .withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") <= rows)
        .drop("_n")
    )


def brand_monthly_from_stage(stage: DataFrame) -> DataFrame:
    """The same mart from stage rows of any origin."""
    return stage.groupBy("tagged_account", F.trunc("post_date", "month").alias("month")).agg(
        F.count_distinct("insta_id").alias("unique_tagger_count"),
        F.count_distinct("post_id").alias("post_count"),
    )


def co_brand_stats(edges: DataFrame) -> DataFrame:
    """Per tagged account: taggers, tags, and taggers in percent of all accounts.

    ``edges`` holds one row per account and tagged account, so counting rows with an account
    counts distinct taggers. The one total is a scalar subquery; without any account the share is
    NULL.
    """
    total = edges.agg(F.count_distinct("insta_id")).scalar()
    return (
        edges.groupBy("tagged_account")
        .agg(
            F.count("insta_id").alias("tagger_count"),
            F.sum("tagged_post_count").alias("total_tag_count"),
        )
        .withColumn(
            "tagger_ratio",
            F.round(F.try_divide(F.col("tagger_count") * F.lit(100.0), total), 1),
        )
    )
