"""The accounts that tag every brand of a list: the base of all overlap questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotag.functions.joins import BROADCAST_ROWS, Side, held, keep_matching
from cotag.functions.ranking import rank_all
from cotag.functions.text import known_name


def require_brands(brands: Sequence[str]) -> list[str]:
    """The brand list as given; an empty one is an error."""
    if not brands:
        raise ValueError("brands must not be empty")
    return list(brands)


def brand_totals(edges: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Accounts that tag all ``brands``, with their figures over just these brands.

    ``edges`` (the account-to-tag mart) holds one row per account and tagged account, so the
    number of rows is the number of distinct brands. It is compared with the length of the list
    as given: a repeated brand, or one that nobody tags, leaves no account. The brand filter
    reaches the scan and each account costs one shuffled row.
    """
    wanted = require_brands(brands)
    return (
        edges.filter(F.col("tagged_account").isin(wanted))
        .groupBy("insta_id")
        .agg(
            F.count("tagged_account").alias("_brands"),
            known_name(F.col("insta_name")).alias("known_name"),
            F.sum("tagged_post_count").alias("tag_count"),
            F.max("last_tagged_date").alias("latest_tag_date"),
        )
        .filter(F.col("_brands") == len(wanted))
        .drop("_brands")
    )


def selected_accounts(edges: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Just the account ids of :func:`brand_totals`."""
    return brand_totals(edges, brands).select("insta_id")


def account_numbers(edges: DataFrame) -> DataFrame:
    """Every account with a number from 1 on, without gaps; a missing id is an account too."""
    return rank_all(edges.select("insta_id").distinct(), [F.asc("insta_id")], "account_number")


def brand_bitmaps(edges: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per tagged account and bucket of account numbers, the bitmap of its taggers.

    A bucket holds 32,768 numbers, so a group is bounded and its bitmap has 4 kB, whatever the
    brand. Few brands are read per question, and runs of zero bytes compress well.
    """
    numbered = edges.join(
        numbers.withColumnRenamed("insta_id", "_id"), F.col("insta_id").eqNullSafe(F.col("_id"))
    )
    return numbered.groupBy(
        "tagged_account", F.bitmap_bucket_number("account_number").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("account_number")).alias("taggers"))


def selected_bitmaps(bitmaps: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Per bucket the accounts that tag all ``brands``: a bitwise AND of their bitmaps, in place
    of a grouping of all edges of the brands by account."""
    wanted = require_brands(brands)
    return (
        bitmaps.filter(F.col("tagged_account").isin(wanted))
        .groupBy("bucket")
        .agg(F.count("tagged_account").alias("_brands"), F.bitmap_and_agg("taggers").alias("taggers"))
        .filter(F.col("_brands") == len(wanted))
        .select("bucket", "taggers")
    )


def selected_size(bitmaps: DataFrame, brands: Sequence[str]) -> DataFrame:
    """How many accounts tag all ``brands``, from bitmaps alone."""
    chosen = selected_bitmaps(bitmaps, brands)
    return chosen.agg(
        F.coalesce(F.sum(F.bitmap_count("taggers")), F.lit(0)).alias("total")
    )


def selected_by_bitmaps(
    bitmaps: DataFrame, numbers: DataFrame, brands: Sequence[str]
) -> DataFrame:
    """:func:`selected_accounts` from bitmaps; only the ids of the chosen numbers are looked up."""
    byte = F.conv(F.hex(F.substring("taggers", F.col("_at") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    places = F.sequence(F.lit(0), F.length("taggers") - F.lit(1))
    bits = F.array(*(F.lit(i) for i in range(8)))
    chosen = (
        selected_bitmaps(bitmaps, brands)
        .select("bucket", "taggers", F.explode(places).alias("_at"))
        .select("bucket", "_at", byte.alias("_byte"))
        .filter("_byte > 0")
        .select("bucket", "_at", "_byte", F.explode(bits).alias("_bit"))
        .filter("getbit(_byte, _bit) = 1")
        .select(((F.col("bucket") - 1) * 32768 + F.col("_at") * 8 + F.col("_bit") + 1)
                .cast("bigint").alias("account_number"))
    )
    ids = held(chosen)
    return numbers.join(ids.prepared(), "account_number", "left_semi").select("insta_id")


class Audience:
    """One selection, computed once and shared by the figures, lists and rankings over it.

    ``totals`` holds :func:`brand_totals` and ``size`` its rows (a NULL account counts as one).
    The measured size decides whether the ids may be broadcast.
    """

    def __init__(
        self, edges: DataFrame, brands: Sequence[str], broadcast_rows: int = BROADCAST_ROWS
    ) -> None:
        self.brands = require_brands(brands)
        self.edges = edges
        self.broadcast_rows = broadcast_rows
        self._side = held(brand_totals(edges, self.brands))
        self.totals, self.size = self._side.df, self._side.rows

    @property
    def accounts(self) -> DataFrame:
        """Figures of the selected accounts that have an id (a join never finds the others)."""
        return self.totals.filter(F.col("insta_id").isNotNull())

    def members_of(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose ``insta_id`` is selected."""
        ids = Side(self.accounts.select("insta_id"), self.size, self._side.text_bytes)
        return keep_matching(df, ids, "insta_id", self.broadcast_rows)

    def with_totals(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose ``insta_id`` is selected, with the account's known name."""
        names = self.accounts.select("insta_id", "known_name")
        side = Side(names, self.size, self._side.text_bytes)
        return df.join(side.prepared(self.broadcast_rows), "insta_id")

    def other_edges(self) -> DataFrame:
        """Edges from selected accounts to accounts outside the brand list."""
        outside = self.edges.filter(~F.col("tagged_account").isin(self.brands))
        return self.members_of(outside)
