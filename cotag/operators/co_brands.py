"""Questions about what else the accounts behind a set of brands tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotag.functions.ranking import rank_all, rank_top
from cotag.functions.sections import list_section
from cotag.operators.audience import Audience

TOP_CO_BRANDS = 10
TOP_TAGGERS = 50


def co_brand_kpi(audience: Audience) -> DataFrame:
    """One row: selected accounts, and distinct other accounts they tag."""
    return audience.other_edges().agg(
        F.lit(audience.size).cast("bigint").alias("total_accounts"),
        F.count_distinct("tagged_account").alias("co_brand_count"),
    )


def _co_brands(audience: Audience) -> DataFrame:
    """Per other account: taggers, tags, and taggers in percent of the selection."""
    return (
        audience.other_edges()
        .groupBy("tagged_account")
        .agg(
            F.count("insta_id").alias("tagger_count"),
            F.sum("tagged_post_count").alias("total_tag_count"),
        )
        .withColumn(
            "tagger_ratio",
            F.round(F.col("tagger_count") * F.lit(100.0) / F.lit(audience.size), 1),
        )
    )


def _ranking_order() -> list[Column]:
    return [F.desc("tagger_count"), F.desc("total_tag_count"), F.asc("tagged_account")]


def co_brand_ranking(audience: Audience) -> DataFrame:
    """All other accounts the selection tags, ranked by taggers, then tags."""
    return rank_all(_co_brands(audience), _ranking_order())


def co_brand_top(audience: Audience, rows: int = TOP_CO_BRANDS) -> DataFrame:
    """The head of :func:`co_brand_ranking`."""
    return rank_top(_co_brands(audience), _ranking_order(), rows)


def co_brand_taggers(audience: Audience, tagged_account: str) -> DataFrame:
    """Selected accounts that also tag ``tagged_account``, by tags of that account.

    Just the edges of that account are read; membership and names come from the selection, which
    is already held.
    """
    edges = audience.edges.filter(F.col("tagged_account") == tagged_account)
    return (
        audience.with_totals(edges.select("insta_id", "tagged_post_count", "last_tagged_date"))
        .select(
            "insta_id",
            F.coalesce("known_name", "insta_id").alias("display_name"),
            F.col("tagged_post_count").alias("tag_count"),
            F.col("last_tagged_date").alias("latest_tag_date"),
        )
        .orderBy(F.desc("tag_count"), F.asc("insta_id"))
        .limit(TOP_TAGGERS)
    )


def co_brand_monthly(audience: Audience, months: DataFrame, tagged_account: str) -> DataFrame:
    """Selected taggers of ``tagged_account`` per month.

    ``months`` has one row per tagged account, month and tagger (:func:`marts.tagger_months`). As
    a mart it is clustered by the account, so only its row groups are read, and no raw post is.
    """
    taggers = months.filter(F.col("tagged_account") == tagged_account).select("month", "insta_id")
    return (
        audience.members_of(taggers)
        .groupBy("month")
        .agg(F.count("insta_id").alias("tagger_count"))
        .orderBy(F.asc_nulls_last("month"))
    )


def co_brand_detail(audience: Audience, months: DataFrame, tagged_account: str) -> DataFrame:
    """Taggers and months of one account as (section, JSON)."""
    taggers = rank_top(
        co_brand_taggers(audience, tagged_account),
        [F.desc("tag_count"), F.asc("insta_id")],
        TOP_TAGGERS,
        "_rank",
    ).withColumn("latest_tag_date", F.col("latest_tag_date").cast("string"))
    by_month = co_brand_monthly(audience, months, tagged_account).select(
        F.col("month").isNull().alias("_undated"),
        F.col("month").cast("string").alias("month"),
        "tagger_count",
    )
    return list_section("taggers", taggers, ["_rank"]).unionByName(
        list_section("monthly", by_month, ["_undated", "month"])
    )
