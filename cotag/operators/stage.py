"""Stage layer: one row per post and tag position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotag.functions.text import clean_account, is_blank, trim_spaces
from cotag.schemas import STAGE_COLUMNS

_POST_FIELDS = (
    "post_id",
    "insta_id",
    "insta_name",
    "brand_name",
    "brand_id",
    "post_date",
    "full_link",
)


def tagged_posts(posts: DataFrame) -> DataFrame:
    """Posts that carry a tag list, cut to the columns the stage needs."""
    return posts.filter(~is_blank(F.col("tagged_insta_id"))).select(
        *_POST_FIELDS, "tagged_insta_id"
    )


def tag_parts(tag_list: Column) -> Column:
    """A comma list as an array; empty parts stay and keep their position."""
    return F.split(tag_list, ",", -1)


def explode_tags(posts: DataFrame) -> DataFrame:
    """One row per part of the tag list: 1-based ``tag_pos`` and the trimmed part."""
    parts = posts.select(
        *_POST_FIELDS,
        F.posexplode(tag_parts(F.col("tagged_insta_id"))).alias("_pos", "_part"),
    )
    return parts.select(
        *_POST_FIELDS,
        (F.col("_pos") + 1).cast("bigint").alias("tag_pos"),
        trim_spaces(F.col("_part")).alias("tagged_account_raw"),
    )


def drop_blank_parts(parts: DataFrame) -> DataFrame:
    """Drop empty parts before cleaning; a part such as ``@`` stays and becomes empty later."""
    return parts.filter(F.col("tagged_account_raw") != "")


def clean_tags(parts: DataFrame) -> DataFrame:
    """Turn raw parts into ``tagged_account``."""
    return parts.withColumn(
        "tagged_account", clean_account(F.col("tagged_account_raw"))
    ).drop("tagged_account_raw")


def surrogate_key(post_id: Column, tag_pos: Column, tagged_account: Column) -> Column:
    """Key of a stage row: MD5 over post, position and account; NULL parts are skipped."""
    return F.md5(F.concat_ws("||", post_id, tag_pos.cast("string"), tagged_account))


def tagged_post_rows(posts: DataFrame, tagged_account: str | None = None) -> DataFrame:
    """The whole stage model.

    With ``tagged_account`` only the rows of that account come back. A filter on the cleaned
    account cannot cross the generator, so a test that its text occurs in the tag list is put
    in front of it and reaches the scan.
    """
    source = tagged_posts(posts)
    if tagged_account is not None and tagged_account.isascii():
        source = source.filter(F.lower("tagged_insta_id").contains(tagged_account))
    rows = clean_tags(drop_blank_parts(explode_tags(source)))
    if tagged_account is not None:
        rows = rows.filter(F.col("tagged_account") == tagged_account)
    key = surrogate_key(F.col("post_id"), F.col("tag_pos"), F.col("tagged_account"))
    return rows.withColumn("pk_tagged_post", key).select(*STAGE_COLUMNS)


def distinct_tags(posts: DataFrame) -> DataFrame:
    """One row per post and *distinct* cleaned account, without position and key.

    ``post_id`` is the key of ``posts``, so repeats of an account can only occur inside one tag
    list and are removed inside the row. Counting rows of this frame counts distinct posts,
    and no shuffle on ``post_id`` is needed for it.

    The cleaned list is a column of its own, as Spark generates no code for an ``explode`` over
    lambdas. It is exploded with an outer ``explode``: before an inner one Spark would test the size
    of the list, and so clean every list twice. The row of an empty list has no account.
    """
    fields = [c for c in _POST_FIELDS if c != "full_link"]
    raw = F.transform(tag_parts(F.col("tagged_insta_id")), trim_spaces)
    cleaned = F.transform(raw, lambda part: F.when(part != "", clean_account(part)))
    lists = tagged_posts(posts).select(*fields, F.array_distinct(cleaned).alias("_accounts"))
    return lists.select(
        *fields, F.explode_outer("_accounts").alias("tagged_account")
    ).filter(F.col("tagged_account").isNotNull())
