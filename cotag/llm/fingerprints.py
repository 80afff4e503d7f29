"""Document fingerprints from closed syncmers.

A k-mer of characters is a closed syncmer if the least of its inner s-mers (by hash) is its first
or its last one. That depends on the k-mer alone, so an edit changes no anchor outside of it, and
every window of ``k - s`` k-mers in a row holds an anchor. The fingerprint stands for all anchors of a
text in their order; its string is a digest of them, and the ``size`` least anchor hashes are kept
beside it as a sketch, for lookups. Two texts are compared by position: their equal anchors are
paired, and the longest chain of pairs that keeps the order of both texts counts.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotag.llm.common import arrow_fields, small_batches, texts_of

K = 20
S = 8
#: Anchors in a fingerprint.
SIZE = 64

FINGERPRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, sketch string"
)
ANCHORS = "doc_id long, position long, anchor long"

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M1
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(31))


def _rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every window of ``width`` codes: a polynomial built by doubling."""
    total, done, base = codes, 1, _M2
    result, covered = None, 0
    bits = width
    while True:
        if bits & 1:
            # windows of ``covered`` followed by windows of ``done``
            if result is None:
                result, covered = total, done
            else:
                n = len(codes) - covered - done + 1
                result = result[:n] * base + total[covered : covered + n]
                covered += done
        bits >>= 1
        if not bits:
            return _mixed(result)
        n = len(total) - done
        total = total[:n] * base + total[done : done + n]
        base, done = np.uint64(int(base) ** 2 % 2**64), done * 2


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the closed syncmers; a text shorter than k is one anchor."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(codes) < k:
        return np.zeros(1, np.int64), _rolled(codes, len(codes))
    inner = _rolled(codes, s)
    span = k - s
    least = _window_min(inner, span + 1)
    edge = (inner[: len(least)] == least) | (inner[span:] == least)
    at = np.flatnonzero(edge)
    # The k-mer's hash from its inner s-mers' hashes, at the anchors only.
    value = inner[at]
    for shift in range(s, k - s, s):
        value = value * _M2 + inner[at + shift]
    return at, _mixed(value * _M2 + inner[at + span])


Anchors = tuple[np.ndarray, np.ndarray]


def sketch(found: Anchors, size: int = SIZE) -> np.ndarray:
    """The ``size`` least distinct anchor hashes (upper 32 bits), sorted."""
    values = (found[1] >> np.uint64(32)).astype(np.uint32)
    if len(values) > 4 * size:  # those that matter, before sorting
        part = np.partition(values, 3 * size)[: 3 * size + 1]
        least = np.unique(part)
        if len(least) >= size:
            return least[:size]
    return np.unique(values)[:size]


def digest(found: Anchors) -> str:
    """All anchors of a text with their places, as 128 bits in hex."""
    places, values = (x.astype("<u8").tobytes() for x in found)
    return hashlib.md5(places + values, usedforsecurity=False).hexdigest()


def _numbered(values: np.ndarray) -> np.ndarray:
    """A key for each anchor: its hash with how many equal ones come before it."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    place = np.arange(len(values))
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    before = place - np.repeat(first, np.diff(np.append(first, len(values))))
    if not before.any():
        return values
    keys = np.empty(len(values), np.uint64)
    again = _mixed(ordered + before.astype(np.uint64) * _M1)
    keys[order] = np.where(before == 0, ordered, again)
    return keys


def _chain(a: np.ndarray, b: np.ndarray) -> int:
    """Longest chain of equal keys in the order of both; keys are unique on each side."""
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    targets = to[np.argsort(at)].tolist()
    tails: list[int] = []
    for t in targets:
        if not tails or t > tails[-1]:
            tails.append(t)
        else:
            tails[bisect.bisect_left(tails, t)] = t
    return len(tails)


def likeness(one: Anchors, other: Anchors) -> float:
    """Anchors of both texts that are matched in order, as a share of all; 1 for two empty texts.

    Equal anchors are paired as first with first, second with second and so on; if anything is left
    over, also from the end on, and the longer chain counts. So no pairs of repeats are tried.
    Matching what both texts have in common at their beginnings is always best, and is done first.
    """
    a, b = one[1], other[1]
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    same = int(unlike[0]) if len(unlike) else n
    total = len(a) + len(b)
    a, b = a[same:], b[same:]
    best = 0
    if len(a) and len(b):
        best = _chain(_numbered(a), _numbered(b))
        if best < min(len(a), len(b)):
            best = max(best, _chain(_numbered(a[::-1])[::-1], _numbered(b[::-1])[::-1]))
    return 2 * (same + best) / total


def _hex(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def anchor_positions(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Every anchor of whole texts with its place: (doc_id, position, anchor), for matching."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, texts_of(batch), strict=True):
                at, value = anchors(text, k, s)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id] * len(at), pa.int64()), pa.array(at, pa.int64()),
                         pa.array(value.view(np.int64), pa.int64())],
                        names=["doc_id", "position", "anchor"],
                    )

    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, ANCHORS)


def _stretches(spark: SparkSession, ids: DataFrame) -> tuple[list[int], dict[int, int]]:
    """Bounds of stretches of ids, and the least id of each that has rows."""
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    probabilities = [i / count for i in range(1, count)]
    found = ids.approxQuantile("doc_id", probabilities, 0.25 / count)
    bounds = sorted({int(b) for b in found})
    least = ids.groupBy(_stretch(bounds).alias("_s")).agg(F.min("doc_id").alias("least")).collect()
    return bounds, {r["_s"]: r["least"] for r in least}


def _stretch(bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``doc_id``: first in strides, then inside."""
    if not bounds:
        return F.lit(0)
    stride = math.isqrt(len(bounds) - 1) + 1
    edges = F.array(*(F.lit(b).cast("long") for b in bounds))
    strides = F.array(*(F.lit(b).cast("long") for b in [*bounds[stride - 1 :: stride], 2**63 - 1]))
    passed = F.size(F.filter(strides, lambda b: b <= F.col("doc_id"))) * F.lit(stride)
    inside = F.slice(edges, passed + F.lit(1), F.lit(stride))
    return (passed + F.size(F.filter(inside, lambda b: b <= F.col("doc_id")))).cast("int")


def fingerprint_documents(docs: DataFrame, k: int = K, s: int = S, size: int = SIZE) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, compared with its neighbours.

    The edited text has its last floor(n / 4) code points replaced by as many first ones of the
    next document by ascending doc_id, the last document taking the first one. Rows without an id
    come first; rows that share an id are ordered by text. A missing text is empty; one row per
    input row, other columns are not read.

    Ids are cut into stretches, and each text is shuffled once to its stretch; the least id of a
    stretch is also sent to the one before, so that every row meets its successor in its task. The
    driver sees one bound and one least id per stretch, whose number is set by the session.
    """
    spark = docs.sparkSession
    small_batches(spark)
    missing = -(2**63)  # before every id
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(missing)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    bounds, least = _stretches(spark, rows.select("doc_id"))
    if not least:
        return spark.createDataFrame([], FINGERPRINTS)
    own = _stretch(bounds)
    # A guest is the first row of the next filled stretch; the last stretch gets the first of all.
    order = sorted(least)
    guest_of = F.create_map(
        *(part for i, at in enumerate(order)
          for part in (F.lit(least[at]).cast("long"), F.lit(order[i - 1]).cast("int")))
    )
    guest = F.element_at(guest_of, F.col("doc_id"))
    dealt = rows.select(
        F.explode(F.array_compact(F.array(
            F.struct(own.alias("_s"), F.lit(0).alias("_guest")),
            F.when(guest.isNotNull(), F.struct(guest.alias("_s"), F.lit(1).alias("_guest"))),
        ))).alias("_to"), "doc_id", "text",
    ).select("_to._s", "_to._guest", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]):
        names, types = zip(*arrow_fields(FINGERPRINTS), strict=True)
        done: list[tuple] = []
        stretch, current, current_anchors = None, None, None
        closed = False
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("_s", "_guest", "doc_id", "text"))
            for at, is_guest, doc_id, text in zip(*columns, strict=True):
                if at != stretch:
                    stretch, current, closed = at, None, False
                if closed:
                    continue  # further guests of the same id
                own = anchors(text, k, s)
                if current is not None:
                    done.append(_row(*current, current_anchors, text, own, k, s, size))
                if is_guest:
                    closed = True
                current, current_anchors = (doc_id, text), own
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)],
                    names=list(names),
                )
                done = []

    return (
        dealt.repartition("_s")
        .sortWithinPartitions("_s", "_guest", "doc_id", "text")
        .mapInArrow(run, FINGERPRINTS)
        .withColumn("doc_id", F.nullif("doc_id", F.lit(missing)))
    )


def _row(doc_id, text, own, after, after_anchors, k, s, size) -> tuple:
    take = min(len(text) // 4, len(after))
    cut = len(text) // 4
    edited = text[: len(text) - cut] + after[:take]
    new = own if edited == text else anchors(edited, k, s)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        digest(own),
        digest(new),
        likeness(own, new),
        likeness(own, after_anchors),
        _hex(sketch(own, size)),
    )
