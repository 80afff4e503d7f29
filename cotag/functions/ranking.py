"""Row numbers and pages over whole results, without pulling a result into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotag.functions.joins import held
from cotag.session import ensure_checkpoints

#: Pages that end within this row are cut from a top-k; deeper ones use the ranked table.
TOP_ROWS = 10_000

# ``monotonically_increasing_id`` holds the partition above bit 33 and the row below it.
_PARTITION_SHIFT = 33
_ROW_MASK = (1 << _PARTITION_SHIFT) - 1


def rank_all(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number every row of ``df`` from 1 in ``order``; ``order`` must leave no ties.

    A window without partition keys would sort the result in one task. Here the rows are range
    sorted over all tasks and checkpointed with their place inside their partition; one short
    table of partition sizes (a row per sort partition, so never more than
    ``spark.sql.shuffle.partitions``) then turns places into ranks.
    """
    ensure_checkpoints(df.sparkSession)
    placed = (
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    )
    partition = F.shiftright("_place", _PARTITION_SHIFT)
    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    rank = F.col("_start") + F.col("_place").bitwiseAND(F.lit(_ROW_MASK)) + F.lit(1)
    return placed.join(
        F.broadcast(starts), partition == F.col("_partition")
    ).select(rank.alias(name), *df.columns)


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank"
) -> DataFrame:
    """Number the rows of each value of ``keys`` from 1 in ``order``, which must leave no ties.

    A window would sort all rows of a key in one task. Here rows are range sorted by keys and order,
    so a large key spans tasks; one row per key and sort partition then says where it starts.
    """
    ensure_checkpoints(df.sparkSession)
    placed = (
        df.orderBy(*keys, *order).withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_partition", F.shiftright("_place", _PARTITION_SHIFT)).checkpoint()
    )
    pieces = placed.groupBy("_partition", *keys).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(*keys).orderBy("_partition").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = held(pieces.select(
        F.col("_partition").alias("_p"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    ))
    same = F.col("_partition") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return placed.join(starts.prepared(), same).select(
        *df.columns, (F.col("_place") + F.col("_shift")).alias(name)
    )


def rank_top(
    df: DataFrame, order: Sequence[Column], rows: int, name: str = "rank"
) -> DataFrame:
    """The first ``rows`` rows of ``df`` in ``order``, numbered from 1.

    The limit comes first, so the window sees no more than ``rows`` rows.
    """
    top = df.orderBy(*order).limit(rows)
    rank = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return top.select(rank.alias(name), *df.columns)


def rank_page(
    df: DataFrame,
    order: Sequence[Column],
    limit: int,
    offset: int = 0,
    name: str = "rank",
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` of ``df`` in ``order``, with their rank."""
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    last = offset + limit
    ranked = rank_top(df, order, last, name) if last <= top_rows else rank_all(df, order, name)
    return ranked.filter((F.col(name) > offset) & (F.col(name) <= last))


def rank_after(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    last: Mapping[str, object],
    limit: int,
    name: str = "rank",
) -> DataFrame:
    """The ``limit`` rows of ``df`` that come after the row ``last``, with their ranks.

    ``order`` gives columns and whether they fall; as in Spark, missing values come first in a
    rising column and last in a falling one. ``last`` holds the columns of ``order``, which must
    leave no ties, and its own rank. A page deep in a result thus costs a filter and a top-k like
    the first one; nothing is sorted as a whole.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    beyond, same = F.lit(False), F.lit(True)
    for column, falls in order:
        value = F.lit(last[column]).cast(df.schema[column].dataType)
        here = F.col(column)
        if last[column] is None:
            further = F.lit(False) if falls else here.isNotNull()
        else:
            further = F.coalesce(here < value, F.lit(True)) if falls else here > value
        beyond = beyond | (same & F.coalesce(further, F.lit(False)))
        same = same & here.eqNullSafe(value)
    sorting = [F.desc(c) if falls else F.asc(c) for c, falls in order]
    top = rank_top(df.filter(beyond), sorting, limit, name)
    return top.withColumn(name, F.col(name) + F.lit(last[name]).cast("bigint"))


def page_offset(page: int, page_size: int) -> int:
    """Rows before a 1-based page."""
    return (page - 1) * page_size


def page_count(total: Column, page_size: int) -> Column:
    """Pages that ``total`` rows fill."""
    return F.ceil(total / F.lit(page_size)).cast("bigint")
