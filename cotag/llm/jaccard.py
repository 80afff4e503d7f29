"""N-gram Jaccard join with Bayesian candidate pruning.

Equal texts are one class and are represented by their key. Representatives whose MinHash
values agree in a whole band are candidates. A candidate pair's MinHash values are compared a few
at a time; after each step the pair is dropped if the posterior probability that its similarity
reaches the threshold, given the matches so far, falls below a tolerance. Shingle sets of what is
left are compared exactly.

Pairs are never written as rows. Surviving candidates of a bucket leave a spanning forest, whose
components are families; the shingle sets of a family then meet block by block, where the pairs of
two blocks are compared with a matrix product and leave only counts and, again, a forest.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotag.functions.joins import held, keep_matching
from cotag.llm.common import (
    WordTable, arrow_fields, by_group, components, release_kept, small_batches, text_key, texts_of,
)
from cotag.session import ensure_checkpoints

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: MinHash values compared between two looks at the posterior.
STEP = 16
#: A pair is dropped when it reaches the threshold with a lower probability than this.
TOLERANCE = 1e-9
#: Representatives in one block of a bucket or of a family, and shingle bytes in one block.
BLOCK = 512
BLOCK_BYTES = 8 << 20

_rng = np.random.default_rng(20240501)
_A = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes() -> WordTable:
    """Hashes of words; each task makes its own table and frees it at its end."""
    release_kept()
    return WordTable(xxhash.xxh3_64_intdigest)


def shingles(text: str, words: WordTable, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the text's word n-grams, sorted.

    Words are the lower-cased parts between white space. A text with fewer words is one shingle;
    a text without words has none.
    """
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    width = min(size, len(parts))
    n = len(codes) - width + 1
    value = codes[:n].copy()
    for j in range(1, width):
        value = (value ^ (value >> np.uint64(32))) * _MIX + codes[j : j + n]
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(value ^ (value >> np.uint64(27)))


def minhash(values: np.ndarray) -> np.ndarray:
    """The ``HASHES`` MinHash values (32 bits each) of a set of shingles."""
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for k in range(0, len(values), 2048):
        part = values[k : k + 2048]
        mixed = (part[None, :] * _A[:, None] + _B[:, None]) >> np.uint64(32)
        least = np.minimum(least, mixed.min(axis=1).astype(np.uint32))
    return least


def bands(values: np.ndarray) -> np.ndarray:
    """One hash for each band of MinHash values."""
    rows = values.reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for j in range(ROWS):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F) + rows[:, j]
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(31))


@lru_cache(maxsize=8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For each number of compared values, the matches below which a pair is dropped.

    Values are compared by their low byte, so unequal ones agree once in 256. With a uniform
    prior, the posterior of the match rate after m of n matches is Beta(m + 1, n - m + 1), and the
    chance that it is at least x equals that of at most m successes in n + 1 trials of rate x.
    """
    rate = threshold + (1 - threshold) / 256
    least = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * rate**m * (1 - rate) ** (n + 1 - m)
        least.append(m)
    return tuple(least)


def survivors(one: np.ndarray, many: np.ndarray, needed: tuple[int, ...]) -> np.ndarray:
    """Places in ``many`` whose values could still reach the threshold against ``one``."""
    at = np.arange(len(many))
    matched = np.zeros(len(many), np.int32)
    for step, least in enumerate(needed):
        cut = slice(step * STEP, (step + 1) * STEP)
        matched = matched + (many[at, cut] == one[cut]).sum(axis=1)
        keep = matched >= least
        at, matched = at[keep], matched[keep]
        if not len(at):
            break
    return at


class _Forest:
    """Components of the rows of a block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _bytes(rows: list[dict], name: str) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), np.uint8).reshape(len(rows), -1)


def candidate_forest(rows: list[dict], needed: tuple[int, ...]):
    """Edges (a, b) that connect what the surviving candidate pairs of a bucket block connect.

    Every member is compared with those that it isn't connected with yet, so a tight bucket costs
    one pass, and no surviving pair is left unconnected.
    """
    rows = list({r["rep"]: r for r in rows}.values())
    rows.sort(key=lambda r: r["rep"])
    values = _bytes(rows, "sig")
    forest = _Forest(len(rows))
    label = np.arange(len(rows))
    for i in range(len(rows) - 1):
        others = np.flatnonzero(label != label[i])
        others = others[others > i]
        if not len(others):
            continue
        met = others[survivors(values[i], values[others], needed)]
        if len(met):
            for j in np.unique(label[met]).tolist():
                label[label == j] = label[i]
            for j in met.tolist():
                if forest.root(j) != forest.root(i):
                    forest.join(i, j)
                    yield {"a": rows[i]["rep"], "b": rows[j]["rep"]}


def exact_links(rows: list[dict], cell: tuple[int, int], threshold: float, needed: tuple[int, ...]):
    """Exact links between two blocks of a family (or within one), as counts and a forest.

    For each row with a link: its number of linked texts and of documents that have them, and the
    least representative that it is connected with here.
    """
    rows.sort(key=lambda r: r["rep"])
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    sizes = np.array([len(s) for s in sets])
    side = np.array([r["block"] for r in rows])
    copies = np.array([r["n"] for r in rows], np.int64)
    values = _bytes(rows, "sig")
    count = len(rows)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(count), sizes)
    shared = np.bincount(ids) > 1  # a shingle of one row alone is in no intersection
    fresh = np.cumsum(shared) - 1
    owner, ids = owner[shared[ids]], fresh[ids[shared[ids]]]
    order = np.argsort(ids, kind="stable")
    owner, ids = owner[order], ids[order]
    inter = np.zeros((count, count), np.float32)
    for low in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(ids, [low, low + 4096])
        held_by = np.zeros((count, min(4096, int(shared.sum()) - low)), np.float32)
        held_by[owner[a:b], ids[a:b] - low] = 1
        inter += held_by @ held_by.T
    forest = _Forest(count)
    texts, docs = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for i in range(count):
        later = np.arange(i + 1, count)
        if cell[0] != cell[1]:
            later = later[side[i + 1 :] != side[i]]
        if not len(later):
            continue
        met = later[survivors(values[i], values[later], needed)]
        common = inter[i, met].astype(np.int64)
        union = sizes[i] + sizes[met] - common
        met = met[common >= threshold * union - 1e-9]
        if len(met):
            texts[i] += len(met)
            docs[i] += copies[met].sum()
            texts[met] += 1
            docs[met] += copies[i]
            for j in met.tolist():
                forest.join(i, j)
    for i in np.flatnonzero(texts).tolist():
        yield {
            "rep": rows[i]["rep"], "texts": int(texts[i]), "docs": int(docs[i]),
            "root": rows[forest.root(i)]["rep"],
        }


_SKETCH = "bands array<long>, sig binary"
_SETS = "key binary, doc_id long, shingles binary, sig binary"


def _sketched(docs: DataFrame) -> DataFrame:
    schema = "key binary, doc_id long, " + _SKETCH
    names, types = zip(*arrow_fields(schema), strict=True)

    def run(batches):
        words = word_hashes()
        for batch in batches:
            found, sigs = [], []
            for text in texts_of(batch):
                values = shingles(text, words)
                if len(values):
                    values = minhash(values)
                    found.append(bands(values).view(np.int64))
                    sigs.append(values.astype(np.uint8).tobytes())
                else:
                    found.append([])
                    sigs.append(b"")
            columns = [batch.column("key"), batch.column("doc_id"), found, sigs]
            yield pa.RecordBatch.from_arrays(
                [c if i < 2 else pa.array(c, types[i]) for i, c in enumerate(columns)],
                names=list(names),
            )

    return docs.mapInArrow(run, schema)


def _with_sets(docs: DataFrame) -> DataFrame:
    names, types = zip(*arrow_fields(_SETS), strict=True)

    def run(batches):
        words = word_hashes()
        for batch in batches:
            sets = [shingles(t, words) for t in texts_of(batch)]
            sigs = [minhash(s).astype(np.uint8).tobytes() for s in sets]
            columns = [batch.column("key"), batch.column("doc_id"), [s.tobytes() for s in sets], sigs]
            yield pa.RecordBatch.from_arrays(
                [c if i < 2 else pa.array(c, types[i]) for i, c in enumerate(columns)],
                names=list(names),
            )

    return docs.mapInArrow(run, _SETS)


def _cells(df: DataFrame, blocks: Column, id_col: str) -> DataFrame:
    """Each row once for every pair of blocks that its own is part of: (low, high, block)."""
    block = F.pmod(F.xxhash64(id_col), blocks).cast("int")
    dealt = df.withColumn("block", block).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    )
    return dealt.withColumns(
        {"low": F.least("block", "_other"), "high": F.greatest("block", "_other")}
    ).drop("_other")


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """Near-duplicate classes: (doc_id, class_id, copy_id, n_copies, n_links, n_linked_docs).

    One row per input row. ``class_id`` is the least id that chains of links reach, ``copy_id`` the
    least id with the same text, ``n_copies`` the rows with that text, ``n_links`` the number of
    other texts with a similarity of ``threshold`` or more, ``n_linked_docs`` the rows that have
    them. A missing text counts as empty; texts without words link to nothing but their copies.

    Texts, not ids, are what is compared: rows without an id are judged like all others, and their
    class has no id only if none of its rows has one; rows that share an id are each in the class of
    their own text, so two classes can then have the same least id.

    Candidates need one equal band: at 0.8 a pair is missed with a probability of about 5e-8.
    """
    rows, classes = _text_classes(docs, threshold, tolerance)
    return rows.select("doc_id", "key").join(classes.hint("merge"), "key").select(
        "doc_id", "class_id", F.col("rep").alias("copy_id"), F.col("n").alias("n_copies"),
        "n_links", "n_linked_docs",
    )


def _text_classes(
    docs: DataFrame, threshold: float, tolerance: float
) -> tuple[DataFrame, DataFrame]:
    """Rows as (key, doc_id, text), and per text key its least id ``rep``, rows ``n``, links, class
    id and the key of its class's ``leader``, the text with the least id."""
    spark = docs.sparkSession
    ensure_checkpoints(spark)
    small_batches(spark)
    needed = least_matches(threshold, tolerance)
    rows = docs.select(
        F.unhex(text_key()).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    classes = (
        rows.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    )
    firsts = classes.select(F.col("key").alias("_key"), "rep", "n")
    # Every copy is sketched where it is read; the one with the least id goes on.
    chosen = (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    reps = (
        firsts.join(_sketched(rows), chosen)
        .select("key", "n", "bands", "sig")
        .dropDuplicates(["key"])
        .checkpoint()
    )
    # Buckets of at least two; those with the same members are looked at once.
    banded = reps.select("key", F.explode("bands").alias("band"))
    buckets = (
        banded.groupBy("band")
        .agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("first"),
             F.bit_xor(F.xxhash64("key")).alias("xor"), F.max("key").alias("last"))
        .filter("size > 1")
        .groupBy("size", "first", "last", "xor").agg(F.min("band").alias("band"))
        .select("band", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    )
    members = banded.join(buckets.hint("merge"), "band").join(
        reps.select("key", "sig"), "key"
    ).withColumnRenamed("key", "rep")
    edges = by_group(
        _cells(members, F.col("blocks"), "rep"), ["band", "low", "high"],
        lambda group: candidate_forest(group, needed), "a binary, b binary",
    )
    families = components(edges).checkpoint()
    # Shingle sets of the texts in families meet block by block.
    wanted = held(families.select(F.col("node").alias("key")))
    once = firsts.withColumnRenamed("rep", "_rep").select("_key", "_rep")
    sets = (
        _with_sets(keep_matching(rows, wanted, "key"))
        .join(once, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_rep")))
        .select("key", "shingles", "sig")
        .join(families.withColumnRenamed("node", "key"), "key")
        .join(reps.select("key", "n"), "key")
        .withColumnRenamed("key", "rep")
        .dropDuplicates(["rep"])
        .checkpoint()
    )
    sizes = held(sets.groupBy("root").agg(
        F.count(F.lit(1)).alias("texts"), F.sum(F.octet_length("shingles")).alias("bytes")
    ).select("root", F.greatest(
        F.ceil(F.col("texts") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)
    ).alias("blocks")))
    cells = _cells(sets.join(sizes.prepared(), "root"), F.col("blocks"), "rep")
    counted = by_group(
        cells, ["root", "low", "high"],
        lambda group: exact_links(group, (group[0]["low"], group[0]["high"]), threshold, needed),
        "rep binary, texts long, docs long, root binary",
    ).checkpoint()
    return rows, _classes(classes, counted)


def _classes(classes: DataFrame, counted: DataFrame) -> DataFrame:
    """Texts with their class, from copies and counted links."""
    links = counted.groupBy("rep").agg(
        F.sum("texts").cast("long").alias("n_links"), F.sum("docs").cast("long").alias("n_linked_docs")
    ).withColumnRenamed("rep", "key")
    roots = components(counted.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = classes.join(roots.withColumnRenamed("node", "key"), "key").checkpoint()
    least = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("_l")
    leaders = held(
        linked.groupBy("root").agg(least)
        .select("root", F.col("_l.rep").alias("class_id"), F.col("_l.key").alias("leader"))
    )
    classed = linked.select("key", "root").join(leaders.prepared(), "root").drop("root")
    zero = F.lit(0).cast("long")
    return classes.join(links, "key", "left").join(classed, "key", "left").select(
        "key", "rep", "n", F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("n_linked_docs", zero).alias("n_linked_docs"),
        F.when(F.col("leader").isNull(), F.col("rep")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("leader", "key").alias("leader"),
    )


def keep_one_of_each(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """``docs`` with one row of each class: one with the least id, and the least text key if two
    texts have that id. A row without an id stays only where its class has none with one."""
    rows, classes = _text_classes(docs, threshold, tolerance)
    found = rows.select("key", "doc_id").join(
        classes.select("key", "rep", "leader").hint("merge"), "key")
    stays = (F.col("key") == F.col("leader")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    judged = found.withColumn("_stays", stays).groupBy("key", "doc_id", "_stays").agg(
        F.count(F.lit(1)).alias("_n")
    ).checkpoint()
    named = [F.col("key").alias("__dealt_key"), F.col("doc_id").alias("__dealt_id")]
    gone = held(judged.filter(~F.col("_stays")).select(*named))
    repeated = held(judged.filter("_stays and _n > 1").select(*named))
    own = F.unhex(text_key(docs["text"]))
    same = (own == F.col("__dealt_key")) & docs["doc_id"].cast("long").eqNullSafe(F.col("__dealt_id"))
    kept = docs.join(gone.prepared(), same, "left_anti")
    if not repeated.rows:
        return kept
    single = kept.join(repeated.prepared(), same, "left_anti")
    twice = kept.join(repeated.prepared(), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(twice)
