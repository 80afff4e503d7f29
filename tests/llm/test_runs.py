from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cotag.llm import runs
from cotag.llm.queries import QUERIES


def by_hand(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """Every period tried: stretches of equal words that far apart, unless a smaller period fits."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if j > i and length >= max(least, 2 * q) and not any(
                part[r:] == part[:-r] for r in range(1, q)
            ):
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=50), st.integers(2, 13), st.integers(0, 49),
       st.integers(1, 9))
def test_equals_brute_force(words, least, a, p):
    assert runs.find_runs(words, least) == by_hand(words, least)
    tail = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)
            if i < a or a + (i - a) % p < len(words)]
    assert runs.find_runs(tail, least) == by_hand(tail, least)


def test_many_positions():
    assert runs.find_runs(["a"] * 30_000) == [(0, 30_000, 1)]
    assert runs.find_runs([str(i % 700) for i in range(30_000)]) == [(0, 30_000, 700)]
    a, b = ["a"], ["a", "b"]
    while len(b) < 500:
        a, b = b, b + a
    assert runs.find_runs(b, 4) == by_hand(b, 4)
    rng = random.Random(1)
    plain = rng.sample(range(10**6), 40_000)
    assert runs.find_runs([*plain, *plain[5000:5020], *plain[5000:5020], 7]) == [(40_000, 40, 20)]


def test_positions_in_blocks():
    rng = random.Random(2)
    values = rng.sample(range(10**5), 5000)
    own = runs.Positions(values[0])
    for v in values[1:]:
        own.add(v)
    ordered = sorted(values)
    assert list(own) == ordered and own.size == 5000
    for i in range(0, 5000, 97):
        before = ordered[i - 1] if i else None
        assert own.around(ordered[i]) == (before, ordered[i + 1] if i < 4999 else None)


def _want(doc_id: int, text: str | None) -> tuple:
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = by_hand(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = best[1] * 1000 // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256")


def test_query_equals_brute_force(spark, sf_dir):
    got = QUERIES["op11_periodic_runs"](spark, sf_dir)
    assert tuple(got.columns) == COLUMNS
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    short = {d["doc_id"]: d["text"] for d in docs if len((d["text"] or "").split()) < 1500}
    rows = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(rows) == len(docs)
    for doc_id, text in short.items():
        assert rows[doc_id] == _want(doc_id, text)
    assert any(r[1] for r in rows.values()) and len(short) > len(docs) / 2


def test_messy(messy):
    rows = runs.run_digests(runs.periodic_runs(messy)).collect()
    assert len(rows) == messy.count()
    none = [r for r in rows if r["doc_id"] in (2, 3, 4)]
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r["n_runs"], r["start"], r["runs_sha256"]) for r in none] == [(0, None, empty)] * 3
    assert [r["n_runs"] for r in rows if r["doc_id"] == 5] == [0]
    assert runs.periodic_runs(messy.limit(0)).count() == 0
    assert runs.repeat_tails(messy).count() == messy.count()


@pytest.mark.parametrize("text, kept", [
    ("a b " * 6, "a b"), ("x " + "a b " * 6 + "a y", "x a b y"), ("a b " * 5, "a b a b a b a b a b"),
    ("e " * 12 + "f " * 12, "e f"),
])
def test_collapsed(make_docs, text, kept):
    row = runs.periodic_runs(make_docs([(1, text)])).first()
    assert row["collapsed"] == kept
