"""Periodic runs of words by descending-LCP merging of suffix classes.

A run of period q and length n starts where the suffixes at ``i`` and ``i + q`` share a prefix of
n - q >= q words. Suffix classes are united by falling length of the longest common prefix (LCP) of
neighbours in suffix order, as Kruskal's algorithm unites trees. Every class keeps its positions in
order, so a union finds the pairs that become neighbours in the text's order: a pair at a distance
within the LCP seeds a run. No third position of the class lies between the two, so the distance is
the smallest period, and every run shows up as such a pair at its first word.

A run of ``least`` words has an LCP of at least ``least / 2``. Merging stops there, and a text in
which no window of so many words occurs twice needs no suffix order at all.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotag.llm.common import small_batches

#: Fewest words of a run.
LEAST = 12

RUNS = (
    "doc_id long, n_words long, starts array<int>, lengths array<int>, periods array<int>, "
    "collapsed string"
)

_BLOCK = 1024


class Positions:
    """An ordered set of integers in blocks of bounded size."""

    def __init__(self, first: int):
        self._blocks, self._least = [[first]], [first]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for block in self._blocks:
            yield from block

    def add(self, value: int) -> None:
        at = max(bisect_right(self._least, value) - 1, 0)
        block = self._blocks[at]
        insort(block, value)
        self._least[at] = block[0]
        if len(block) > _BLOCK:
            half = len(block) // 2
            self._blocks.insert(at + 1, block[half:])
            self._least.insert(at + 1, block[half])
            del block[half:]
        self.size += 1

    def around(self, value: int) -> tuple[int | None, int | None]:
        """The members before and after ``value``, a member; None at an end."""
        at = bisect_right(self._least, value) - 1
        block = self._blocks[at]
        i = bisect_left(block, value)
        before = block[i - 1] if i else (self._blocks[at - 1][-1] if at else None)
        if i + 1 < len(block):
            return before, block[i + 1]
        return before, self._least[at + 1] if at + 1 < len(self._least) else None


def _ranks(first: np.ndarray, second: np.ndarray, shift: int) -> tuple[np.ndarray, int]:
    """Ranks of the pairs (first[i], second[i + shift]), a missing second part before all others;
    and how many differ."""
    n = len(first)
    later = np.zeros(n, np.int64)
    if shift < n:
        later[: n - shift] = second[shift:] + 1
    pairs = first.astype(np.int64) * (n + 2) + later
    order = np.argsort(pairs)
    ordered = pairs[order]
    new = np.empty(n, np.int64)
    steps = np.empty(n, np.int64)
    steps[0] = 0
    np.cumsum(ordered[1:] != ordered[:-1], out=steps[1:])
    new[order] = steps
    return new, int(steps[-1]) + 1


def _windows(ids: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Ranks of the windows of ``size`` words, shorter at the end, put together from halves."""
    ranks, differ = ids, 0
    width = 1
    for bit in bin(size)[3:]:
        ranks, differ = _ranks(ranks, ranks, width)
        width *= 2
        if bit == "1":
            ranks, differ = _ranks(ranks, ids, width)
            width += 1
    return ranks, differ


def _common_prefixes(ids: list[int], order: list[int], rank: list[int], least: int) -> list[int]:
    """LCP of each suffix in ``order`` with the one before it, where it is at least ``least``; else
    0. Going through the text, the LCP falls by at most one per word."""
    n = len(ids)
    found = [0] * n
    size = 0
    for i in range(n):
        at = rank[i]
        if not at:
            size = 0
            continue
        j = order[at - 1]
        end = n - max(i, j)
        while size < end and ids[i + size] == ids[j + size]:
            size += 1
        if size >= least:
            found[at] = size
        size = size - 1 if size else 0
    return found


def find_runs(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All maximal runs of at least ``least`` words and two periods: (start, length, period), by
    start, then period."""
    n = len(words)
    if n < max(least, 2):
        return []
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    prefix = max((least + 1) // 2, 1)
    ranks, differ = _windows(ids, prefix)
    if differ == n:
        return []
    # Windows cut by the end of the text can't hold a pair, but they keep the order of suffixes.
    width = prefix
    while differ < n:
        ranks, differ = _ranks(ranks, ranks, width)
        width *= 2
    order = np.empty(n, np.int64)
    order[ranks] = np.arange(n)
    plain = ids.tolist()
    suffixes = order.tolist()
    rank = ranks.tolist()
    common = _common_prefixes(plain, suffixes, rank, prefix)
    parent: dict[int, int] = {}  # over ranks; only those that meet others are entered
    classes: dict[int, Positions] = {}

    def root(at: int) -> int:
        if at not in parent:
            parent[at] = at
            classes[at] = Positions(suffixes[at])
            return at
        while parent[at] != at:
            parent[at] = at = parent[parent[at]]
        return at

    runs = []
    lcps = np.asarray(common)
    joins = np.nonzero(lcps >= prefix)[0]
    falling = joins[np.argsort(-lcps[joins], kind="stable")].tolist()
    for size, level in groupby(falling, common.__getitem__):
        arrived = []
        for at in level:
            a, b = root(at - 1), root(at)
            if classes[a].size < classes[b].size:
                a, b = b, a
            kept, moved = classes[a], classes.pop(b)
            parent[b] = a
            for place in moved:
                kept.add(place)
                arrived.append(place)
        # Neighbours are looked up when all unions of the level are done, as a later one may put a
        # position between two others.
        for place in arrived:
            before, after = classes[root(rank[place])].around(place)
            for i, j in ((before, place), (place, after)):
                if i is None or j is None or j - i > size:
                    continue
                # A pair that agrees one word earlier too belongs to a run that starts earlier; one
                # that agrees beyond this level became neighbours before.
                earlier = i and plain[i - 1] == plain[j - 1]
                beyond = j + size < n and plain[i + size] == plain[j + size]
                if not earlier and not beyond:
                    runs.append((i, j - i + size, j - i))
    return sorted(r for r in set(runs) if r[1] >= max(least, 2 * r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The runs of every whole text, and the text with each run collapsed to its first period.

    Words are what stands between spaces and the controls 9 to 13; the collapsed text joins the
    kept words by one space. One row per input row in one scan without a shuffle; a missing text
    is empty and has no runs, ids are carried as they are, other columns are not read. Work per
    text is n log n in its words, and memory is a few arrays of its words.
    """
    small_batches(docs.sparkSession)
    kinds = [("doc_id", pa.int64()), ("n_words", pa.int64())]
    kinds += [(c, pa.list_(pa.int32())) for c in ("starts", "lengths", "periods")]
    fields = pa.schema([*kinds, ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")),
                                    strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                runs = find_runs(words, least)
                if runs:
                    keep = kept_words(len(words), runs).tolist()
                    kept = [w for w, stays in zip(words, keep, strict=True) if stays]
                else:
                    kept = words
                starts, lengths, periods = zip(*runs, strict=True) if runs else ((), (), ())
                rows.append((doc_id, len(words), starts, lengths, periods,
                             b" ".join(kept).decode("utf-8", "surrogatepass")))
            columns = zip(*rows, strict=True) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
            )

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, RUNS)


def repeat_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, some texts made periodic from a place on.

    With h the CRC-32 of the decimal id and g = floor(h / 10): where h is a multiple of ten, each
    word i from a = g % n on becomes word a + (i - a) % p, with p = 1 + floor((n - a) / (3 + g % 8)).
    A missing id has no digits and stays as it is; a missing text is empty.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    chosen = docs.select(
        "doc_id", "text", h.alias("_h"), F.when(h % 10 == 0, words).alias("_words")
    ).withColumn("_n", F.size("_words"))
    g, n = F.floor(F.col("_h") / 10), F.col("_n")
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    placed = chosen.select("doc_id", "text", "_words", "_n", a.alias("_a"), p.alias("_p"))
    source = F.transform(
        F.sequence(F.col("_a"), F.col("_n") - 1),
        lambda i: F.get("_words", F.col("_a") + (i - F.col("_a")) % F.col("_p")),
    )
    tail = F.concat(F.slice("_words", F.lit(1), F.col("_a")), source)
    return placed.select(
        "doc_id",
        F.when(F.col("_n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"),
    )


def run_digests(found: DataFrame) -> DataFrame:
    """Counts and digests of :func:`periodic_runs`; the run shown is the longest, of equal ones the
    one that starts first, then the one of least period."""
    runs = F.arrays_zip("starts", "lengths", "periods")
    best = F.array_max(F.transform(
        runs, lambda r: F.struct(r["lengths"].alias("n"), (-r["starts"]).alias("s"),
                                 (-r["periods"]).alias("p"))
    ))
    lines = F.transform(
        runs, lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("starts", "lengths", "periods")))
    )
    shown = found.withColumns({"_best": best, "_lines": lines})
    length, period = F.col("_best.n").cast("long"), (-F.col("_best.p")).cast("long")
    return shown.select(
        "doc_id",
        F.size("starts").cast("long").alias("n_runs"),
        (-F.col("_best.s")).cast("long").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("_lines", lambda x: F.concat(x, F.lit("\n"))), ""), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
