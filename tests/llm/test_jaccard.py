from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import plain

from cotag.llm import jaccard
from cotag.llm.common import components
from cotag.llm.queries import QUERIES


def sets_by_hand(text: str) -> frozenset:
    words = text.lower().split()
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def classes_by_hand(rows: list[tuple], threshold: float = 0.8) -> set:
    """All pairs of different texts, and a search over their links."""
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[text or ""].append(doc_id)
    reps = [(min(ids), sets_by_hand(t), len(ids)) for t, ids in texts.items()]
    links = defaultdict(set)
    for i, (_, a, _) in enumerate(reps):
        for j in range(i):
            b = reps[j][1]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    out, seen = set(), {}
    for i in range(len(reps)):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()] - group:
                    group.add(j)
                    todo.append(j)
            root = min(reps[j][0] for j in group)
            seen.update(dict.fromkeys(group, root))
    for i, (rep, _, n) in enumerate(reps):
        for doc_id in texts[[t for t in texts][i]]:
            out.add((doc_id, seen[i], rep, n, len(links[i]), sum(reps[j][2] for j in links[i])))
    return out


def edited(rng, text: str, changes: int) -> str:
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def family(rng, base: str, count: int, changes: int) -> list[str]:
    return [edited(rng, base, rng.randint(0, changes)) for _ in range(count)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    prose = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    passage = prose(60)
    out = [t for _ in range(12) for t in family(rng, prose(rng.randint(30, 150)), 4, 4)]
    out += family(rng, prose(100), 150, 2)  # a large family, some of it copies
    out += [f"{prose(60)} {passage} {prose(60)}" for _ in range(60)]  # a shared passage
    chain = [prose(200)]
    for _ in range(12):
        chain.append(edited(rng, chain[-1], 3))
    return [*out, *chain, "one two", "one two", "One two", "a b c d e", "a b c d e ", "x"]


def test_against_all_pairs(make_docs, texts, monkeypatch):
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    names = "doc_id class_id copy_id n_copies n_links n_linked_docs".split()
    want = classes_by_hand(rows)
    docs = make_docs(rows)
    assert set(plain(jaccard.near_duplicates(docs), *names)) == want
    monkeypatch.setattr(jaccard, "BLOCK", 16)  # many blocks per bucket and family
    assert set(plain(jaccard.near_duplicates(docs), *names)) == want


def test_query_equals_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    names = "doc_id class_id copy_id n_copies n_links n_linked_docs".split()
    got = plain(QUERIES["op8_ngram_jaccard_join"](spark, sf_dir), *names)
    assert set(got) == classes_by_hand([tuple(d) for d in docs]) and len(got) == len(docs)


def test_pruning_keeps_pairs_at_the_threshold():
    """Simulated comparisons: none of many pairs at 0.8 is dropped, almost all at 0.3 are, early."""
    rng = np.random.default_rng(1)
    needed = jaccard.least_matches()
    one = rng.integers(0, 256, jaccard.HASHES).astype(np.uint8)

    def others(rate, n):
        fresh = rng.integers(0, 256, (n, jaccard.HASHES)).astype(np.uint8)
        return np.where(rng.random(fresh.shape) < rate, one, fresh)

    assert len(jaccard.survivors(one, others(0.8, 50_000), needed)) == 50_000
    assert len(jaccard.survivors(one, others(0.3, 50_000), needed)) == 0
    assert len(jaccard.survivors(one, others(0.3, 5_000), needed[:2])) < 2_500


def test_messy_and_kept(messy, make_docs, spark):
    got = plain(jaccard.near_duplicates(messy), "doc_id", "class_id", "n_copies", "n_links")
    by = {}
    for doc_id, *rest in got:
        by.setdefault(doc_id, []).append(tuple(rest))
    assert by.pop(None) == [(None, 1, 0), (2, 3, 0)]  # a text of its own, and one more empty text
    by = {doc_id: rows[-1] for doc_id, rows in by.items()}
    assert by[1] == by[6] == (1, 2, 0) and by[7] == (7, 2, 0) and by[3] == (2, 3, 0)
    assert len(got) == messy.count()
    kept = jaccard.keep_one_of_each(messy)
    assert kept.columns == messy.columns
    assert plain(kept, "doc_id") == [(None,), (1,), (2,), (4,), (5,), (7,), (8,), (9,), (10,)]
    assert jaccard.near_duplicates(messy.limit(0)).count() == 0
    assert jaccard.keep_one_of_each(messy.limit(0)).count() == 0
    mixed = make_docs([(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (3, "a b c d e f")])
    rows = plain(jaccard.near_duplicates(mixed), "doc_id", "class_id")
    assert rows == [(1, 1), (1, 1), (2, 1), (3, 1)]


def test_rows_without_ids_and_with_repeated_ones(make_docs, texts):
    """A third of the ids is missing and some repeat: classes are those of the texts."""
    rng = random.Random(12)
    rows = [(None if rng.random() < 0.34 else i // 2 if rng.random() < 0.2 else i, t)
            for i, t in enumerate(texts)]
    unique = list(dict.fromkeys(t for _, t in rows))
    copies, least = Counter(t for _, t in rows), {}
    for i, t in rows:
        least[t] = min((x for x in (least.get(t), i) if x is not None), default=None)
    by_number = {r[0]: r for r in classes_by_hand(list(enumerate(unique)))}
    members = {}
    for number, row in by_number.items():
        members.setdefault(row[1], []).append(unique[number])
    want, leaders = [], []
    for own in members.values():
        ids = [least[t] for t in own if least[t] is not None]
        leaders.append((min(ids, default=None), own))
    for i, t in rows:
        class_id, own = next(x for x in leaders if t in x[1])
        want.append((i, class_id, least[t], copies[t], by_number[unique.index(t)][4]))
    docs = make_docs(rows)
    names = "doc_id class_id copy_id n_copies n_links".split()
    order = lambda r: tuple((x is not None, x) for x in r)
    assert plain(jaccard.near_duplicates(docs), *names) == sorted(want, key=order)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_one_of_each(docs).collect()]
    assert len(kept) == len(leaders)
    for doc_id, text in kept:
        assert next(x for x in leaders if text in x[1])[0] == doc_id


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 40)]
    noise = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    edges = [*chain, *star, *noise, (5, 5), (None, 3), (7, None)]
    rng.shuffle(edges)
    got = dict(plain(components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in up}
