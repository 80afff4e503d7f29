"""Expectations: each returns the failing rows, or counts of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotag.functions.text import trim_spaces

# The columns that must hold a value, per table.
REQUIRED = {
    "posts": ("brand_name", "post_id"),
    "stage": (
        "pk_tagged_post",
        "tagged_account",
        "insta_id",
        "brand_name",
        "brand_id",
        "post_date",
    ),
    "account_tagged_accounts": ("insta_id", "tagged_account"),
    "cross_brand_accounts": ("insta_id", "tagged_account_count"),
}

# The columns that must be unique, per table.
UNIQUE = {
    "posts": ("post_id",),
    "stage": ("pk_tagged_post",),
    "account_tagged_accounts": ("insta_id", "tagged_account"),
    "cross_brand_accounts": ("insta_id",),
}


def failure_counts(df: DataFrame, checks: Mapping[str, Column], label: str) -> DataFrame:
    """Rows that meet each failing condition, all in one pass: (``label``, failures)."""
    counted = df.agg(*(F.count_if(c).alias(f"_{i}") for i, c in enumerate(checks.values())))
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias(label), F.col(f"_{i}").alias("failures"))
            for i, name in enumerate(checks)
        )
    )
    return counted.select(F.inline(pairs))


def key_failures(
    df: DataFrame, checks: Mapping[str, Column], keys: Sequence[str], unique: str, label: str,
    with_nulls: bool = False,
) -> DataFrame:
    """:func:`failure_counts` and, named ``unique``, the number of keys that occur more than once.

    One grouping finds both, so ``df`` is derived once; a hot or missing key is collapsed before the
    shuffle. Keys with a NULL count only ``with_nulls``.
    """
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(c).alias(f"_{i}") for i, c in enumerate(checks.values())),
    )
    repeated = F.col("_rows") > 1
    for key in () if with_nulls else keys:
        repeated = repeated & F.col(key).isNotNull()
    counts = {name: F.sum(f"_{i}") for i, name in enumerate(checks)} | {unique: F.count_if(repeated)}
    found = grouped.agg(
        *(F.coalesce(c, F.lit(0).cast("long")).alias(f"_{i}") for i, c in enumerate(counts.values()))
    )
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias(label), F.col(f"_{i}").alias("failures"))
            for i, name in enumerate(counts)
        )
    )
    return found.select(F.inline(pairs))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one pass: (column_name, null_count)."""
    return failure_counts(
        df, {c: F.col(c).isNull() for c in columns}, "column_name"
    ).withColumnRenamed("failures", "null_count")


def null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns of :func:`null_counts` that hold a NULL."""
    return null_counts(df, columns).filter("null_count > 0")


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys without a NULL that occur more than once, with their row count."""
    present = df
    for column in columns:
        present = present.filter(F.col(column).isNotNull())
    return (
        present.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
    )


def duplicate_pairs(edges: DataFrame) -> DataFrame:
    """Account and tagged account pairs that occur more than once, NULLs included."""
    return (
        edges.groupBy("insta_id", "tagged_account")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter("row_count > 1")
    )


def is_blank_account() -> Column:
    return trim_spaces(F.col("tagged_account")) == ""


def is_without_tags() -> Column:
    return F.col("tagged_account_count") < 1


def blank_accounts(stage: DataFrame) -> DataFrame:
    """Stage rows whose cleaned account is empty."""
    return stage.filter(is_blank_account())


def accounts_without_tags(cross_brand: DataFrame) -> DataFrame:
    """Accounts whose tag count is below one."""
    return cross_brand.filter(is_without_tags())
