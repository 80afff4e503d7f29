"""Results of several parts as (section, JSON text) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WITH_NULLS = {"ignoreNullFields": "false"}


def object_section(name: str, df: DataFrame) -> DataFrame:
    """One JSON object per row of ``df``."""
    return df.select(
        F.lit(name).alias("section"),
        F.to_json(F.struct(*df.columns), _WITH_NULLS).alias("data"),
    )


def list_section(name: str, df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One JSON list of the rows of ``df``, ascending in the columns ``order``.

    For parts of bounded length only (top-k lists, calendar months). Columns named in ``order``
    that start with ``_`` sort the list but stay out of it. No rows give ``[]``.
    """
    shown = [c for c in df.columns if not c.startswith("_")]
    item = F.struct(*(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)),
                    F.struct(*shown).alias("item"))
    items = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["item"])
    return df.agg(F.to_json(items, _WITH_NULLS).alias("data")).select(
        F.lit(name).alias("section"), "data"
    )
