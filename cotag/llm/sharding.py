"""Shards of near-equal bytes by Karmarkar-Karp differencing of indivisible groups.

Equal texts form a group that stays together. Differencing starts with one partial partition per
group (its bytes in one of the parts, nothing in the others) and again and again combines the two
with the largest spread, the fullest part of one with the emptiest of the other. At scale this is
done in levels: each bucket of groups is differenced in a task of its own and leaves one partial
partition; these are differenced in turn, until one is left. A partial partition that comes out of
a bucket has a small spread, so the next level loses next to nothing.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cotag.llm.common import by_group, text_key
from cotag.session import ensure_checkpoints

SHARDS = 40
#: Bytes that a row costs besides its text.
ROW_BYTES = 16
#: Partial partitions that one task differences at a level.
BUCKET = 20_000
#: Rows, on average, that one task numbers within a shard.
SLOT_ROWS = 50_000


def difference(sizes: list[list[int]], parts: int) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions: bytes per part, and for each input the part of its parts.

    ``sizes[i]`` are the bytes of the ``i``-th partial partition's parts, in any order. Ties go to
    the earlier input. The result is the same for the same input.
    """
    count = len(sizes)
    loads = [np.sort(np.array(s, np.int64))[::-1] for s in sizes]
    orders = [np.argsort(-np.array(s, np.int64), kind="stable") for s in sizes]
    heap = [(int(load[-1] - load[0]), i) for i, load in enumerate(loads)]
    heapq.heapify(heap)
    joins: list[tuple[int, int, np.ndarray]] = []  # left, right, order of the joined parts
    while len(heap) > 1:
        _, left = heapq.heappop(heap)
        _, right = heapq.heappop(heap)
        joined = loads[left] + loads[right][::-1]  # the fullest with the emptiest
        order = np.argsort(-joined, kind="stable")
        loads[left] = loads[right] = None
        loads.append(joined[order])
        joins.append((left, right, order))
        heapq.heappush(heap, (int(loads[-1][-1] - loads[-1][0]), len(loads) - 1))
    # Down again: where does each part of a partial partition end up?
    ends: list = [None] * len(loads)
    ends[-1] = np.arange(parts)
    for k in range(len(joins) - 1, -1, -1):
        left, right, order = joins[k]
        place = np.empty(parts, np.int64)
        place[order] = ends[count + k]
        ends[left], ends[right], ends[count + k] = place, place[::-1], None
    final = []
    for i in range(count):
        where = np.empty(parts, np.int64)
        where[orders[i]] = ends[i]
        final.append(where.tolist())
    return loads[-1].tolist(), final


def _level(partials: DataFrame, bucket: str, parts: int) -> DataFrame:
    """Difference each bucket: (bucket, node, loads of the node's parts' new places, ...)."""

    def work(rows: list[dict]):
        rows.sort(key=lambda r: r["node"])
        sizes = [r["loads"] + [0] * (parts - len(r["loads"])) for r in rows]
        total, places = difference(sizes, parts)
        for i, (row, where) in enumerate(zip(rows, places, strict=True)):
            yield {
                "up": row[bucket],
                "node": row["node"],
                "places": where[: len(row["loads"])],
                "loads": total if i == 0 else None,
            }

    return by_group(
        partials, [bucket], work, "up long, node long, places array<long>, loads array<long>"
    )


def balance(groups: DataFrame, shards: int = SHARDS, bucket: int = BUCKET) -> DataFrame:
    """A shard for each group: (key, n, shard) from (key, n, bytes).

    The number of levels grows with the logarithm of the number of groups. Every level is a
    reliable checkpoint; its parts are joined back from the top.
    """
    ensure_checkpoints(groups.sparkSession)
    first = groups.withColumn("node", F.xxhash64("key")).checkpoint()
    count = first.count()
    current = first.groupBy("node").agg(  # keys that share a hash move together
        F.array(F.sum("bytes").cast("long")).alias("loads")
    )
    levels = []
    while True:
        buckets = max(1, math.ceil(count / bucket))
        done = _level(
            current.withColumn("up", F.pmod(F.xxhash64("node", F.lit(len(levels))), F.lit(buckets))),
            "up", shards,
        ).checkpoint()
        levels.append(done)
        if buckets == 1:
            break
        current = done.filter(F.col("loads").isNotNull()).select(F.col("up").alias("node"), "loads")
        count = buckets
    shard = levels[-1].select("node", "places")
    for lower in reversed(levels[:-1]):
        moved = F.transform("below", lambda p: F.element_at("places", (p + 1).cast("int")))
        shard = (
            lower.select(F.col("up").alias("_up"), F.col("node").alias("_node"),
                         F.col("places").alias("below"))
            .join(shard, F.col("_up") == F.col("node"))
            .select(F.col("_node").alias("node"), moved.alias("places"))
        )
    return first.join(shard, "node").select(
        "key", "n", F.element_at("places", 1).cast("int").alias("shard")
    )


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, bucket: int = BUCKET, slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """Every row's shard and place in it, by the ``bytes`` law.

    (doc_id, size, text_crc32, law, shard, slot, grown_shard). ``size`` is the text's UTF-8 bytes
    plus 16; a missing text counts as empty and shares its group. Rows of equal texts get one
    shard. Slots run from 0 without gaps within a shard; repeated rows get slots of their own. No
    text is shuffled. ``grown_shard`` is null, as it belongs to another law.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("key"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    ensure_checkpoints(docs.sparkSession)
    groups = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")
    )
    placed = balance(groups, shards, bucket)
    # Both sides are shuffled for this join alone, so that Spark may split a group of many rows.
    dealt = rows.join(placed.select("key", "shard").hint("merge"), "key")
    # Slots: rows of a shard are spread over sub-buckets by hash; their sizes give each a start.
    dealt = dealt.withColumn("_hash", F.xxhash64("doc_id", "key")).checkpoint()
    subs = max(1, math.ceil(dealt.count() / (shards * slot_rows)))
    dealt = dealt.withColumn("_sub", F.pmod("_hash", F.lit(subs)))
    before = Window.partitionBy("shard").orderBy("_sub").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        dealt.groupBy("shard", "_sub").agg(F.count(F.lit(1)).alias("_rows"))
        .select("shard", "_sub", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(
        Window.partitionBy("shard", "_sub").orderBy("_hash", "doc_id", "key")
    )
    return (
        dealt.withColumn("_inside", inside)
        .join(starts.hint("shuffle_hash"), ["shard", "_sub"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("_start") + F.col("_inside") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
