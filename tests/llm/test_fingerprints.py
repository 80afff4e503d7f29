from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pytest

from cotag.llm import fingerprints as fp
from cotag.llm.queries import QUERIES


def anchors_by_hand(text: str) -> list[int]:
    """Every window looked at by itself."""
    codes = np.array([ord(c) for c in text], np.uint64)
    inner = [int(fp._rolled(codes[i : i + fp.S], fp.S)[0]) for i in range(len(text) - fp.S + 1)]
    last = fp.K - fp.S
    return [
        i for i in range(len(text) - fp.K + 1)
        if min(inner[i : i + last + 1]) in (inner[i], inner[i + last])
    ]


def test_anchors_are_closed_syncmers():
    rng = random.Random(1)
    for n in (20, 21, 33, 300):
        text = "".join(rng.choices("abcé 😀", k=n))
        at, _ = fp.anchors(text)
        assert at.tolist() == anchors_by_hand(text)


def test_anchors_are_context_free_and_dense():
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=400))
    at, values = fp.anchors(text)
    inside, same = fp.anchors("other words before " + text)
    shift = len("other words before ")
    moved = dict(zip((inside - shift).tolist(), same.tolist(), strict=True))
    assert all(moved[p] == v for p, v in zip(at.tolist(), values.tolist(), strict=True))
    gaps = np.diff(np.concatenate([[-1], at, [len(text) - fp.K + 1]]))
    assert gaps.max() <= fp.K - fp.S + 1


def likeness_by_hand(a: list, b: list) -> float:
    """Longest chain over paired anchors by trying all smaller chains, both ways of pairing."""
    if not a or not b:
        return float(len(a) == len(b))

    def chain(x, y):
        def numbered(z):
            return [(v, z[:i].count(v)) for i, v in enumerate(z)]

        place = {k: j for j, k in enumerate(numbered(y))}
        targets = [place[k] for k in numbered(x) if k in place]
        best = []
        for i, t in enumerate(targets):
            best.append(1 + max((best[j] for j in range(i) if targets[j] < t), default=0))
        return max(best, default=0)

    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    x, y = a[same:], b[same:]
    return 2 * (same + max(chain(x, y), chain(x[::-1], y[::-1]))) / (len(a) + len(b))


def test_likeness_by_hand():
    rng = np.random.default_rng(3)
    for _ in range(400):
        high = int(rng.integers(2, 40))
        a = rng.integers(0, high, rng.integers(0, 30)).astype(np.uint64)
        b = rng.integers(0, high, rng.integers(0, 30)).astype(np.uint64)
        if rng.random() < 0.5 and len(a):
            b = np.concatenate([a[: len(a) // 2], b[:3], a[len(a) // 2 + 1 :]])
        places = np.arange(30)
        assert fp.likeness((places[: len(a)], a), (places[: len(b)], b)) == likeness_by_hand(
            a.tolist(), b.tolist())


def _like(a: str, b: str) -> float:
    return fp.likeness(fp.anchors(a), fp.anchors(b))


def test_likeness_of_texts_is_about_positions():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    for n in (400, 20_000):
        left, right = (" ".join(rng.choices(words, k=n)) for _ in range(2))
        assert _like(left + right, left + right) == 1
        assert 0.4 < _like(f"{left} {right}", f"{right} {left}") < 0.6  # swapped halves
        assert _like(left, f"a new beginning {left}") > 0.95
        assert _like(left, right) < 0.05
        cut = left[: n // 2] + left[n:]
        shared = 1 - (n // 2) / len(left)
        assert abs(_like(left, cut) - 2 * shared / (1 + shared)) < 0.05


def test_likeness_of_long_texts_is_exact_and_quick():
    rng = random.Random(6)
    shared = " ".join(str(rng.random()) for _ in range(300))
    one, two = (" ".join(str(rng.random()) for _ in range(26_000)) for _ in range(2))  # half a MB
    a, b = fp.anchors(f"{one} {shared} {one[:9999]}"), fp.anchors(f"{two} {shared} {two[:9999]}")
    start = time.process_time()
    got = fp.likeness(a, b)
    assert time.process_time() - start < 3
    want = 2 * len(fp.anchors(shared)[0]) / (len(a[0]) + len(b[0]))
    assert want * 0.98 < got < want * 1.05
    same = fp.anchors("the same line again\n" * 50_000)
    start = time.process_time()
    assert fp.likeness(same, fp.anchors("x" + "the same line again\n" * 49_000)) > 0.97
    assert time.process_time() - start < 5


def by_hand(rows: list[tuple]) -> list[tuple]:
    """The contract, over a list sorted by id."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        one, two, three = (fp.anchors(t) for t in (text, edited, after))
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.digest(one), fp.digest(two),
            fp.likeness(one, two), fp.likeness(one, three), fp._hex(fp.sketch(one)),
        ))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_query_equals_contract(spark, sf_dir, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
        got = [tuple(r) for r in QUERIES["op10_fingerprints"](spark, sf_dir).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(got, key=key) == sorted(by_hand([tuple(d) for d in docs]), key=key)
    assert np.mean([r[5] for r in got]) > 0.4 > np.mean([r[6] for r in got])


def test_messy(messy, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    got = [tuple(r) for r in fp.fingerprint_documents(messy).collect()]
    assert sorted(got, key=key) == sorted(by_hand(rows), key=key)
    assert fp.fingerprint_documents(messy.limit(0)).count() == 0
    one = fp.fingerprint_documents(make_docs([(4, "all alone in here")])).collect()
    assert [tuple(r) for r in one] == by_hand([(4, "all alone in here")])
    same = make_docs([(1, "equal"), (1, "equal"), (1, "equal")])
    assert len({r["fingerprint"] for r in fp.fingerprint_documents(same).collect()}) == 1


def test_positions(messy):
    rows = [r for r in fp.anchor_positions(messy).collect() if r["doc_id"] == 10]
    assert [r["position"] for r in rows] == anchors_by_hand("7" * 5000)
