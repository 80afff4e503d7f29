"""How recent the raw table is."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F


def freshness(posts: DataFrame | GroupedData) -> DataFrame:
    """Last load and newest post day: one row, or one per group of grouped posts."""
    return posts.agg(
        F.max("last_seen_at").alias("last_loaded_at"),
        F.max("post_date").alias("latest_post_date"),
    )
