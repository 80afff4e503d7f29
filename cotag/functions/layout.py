"""How tables are laid out for readers that ask about one account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "account_bucket"
#: Folders of a table that is read by account.
ACCOUNT_BUCKETS = 128


def account_bucket(insta_id: Column) -> Column:
    """Folder of an account; a missing account has one of its own."""
    return F.coalesce(
        F.pmod(F.xxhash64(insta_id), F.lit(ACCOUNT_BUCKETS)).cast("int"), F.lit(-1)
    )


def of_account(df: DataFrame, insta_id: str) -> DataFrame:
    """Rows of one account; of a table in account folders, only its folder is read."""
    rows = df.filter(F.col("insta_id") == insta_id)
    if BUCKET in df.columns:
        rows = rows.filter(F.col(BUCKET) == account_bucket(F.lit(insta_id))).drop(BUCKET)
    return rows
