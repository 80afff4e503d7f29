from __future__ import annotations

import random

from cotag.llm import pieces, token_counts
from cotag.llm.queries import MODEL, QUERIES


def greedy(pieces_set: frozenset, word: str) -> int:
    """Longest piece first, by trying; 0 if it gets stuck."""
    at = total = 0
    longest = max(map(len, pieces_set), default=0)
    while at < len(word):
        for size in range(min(longest, len(word) - at), 0, -1):
            if word[at : at + size] in pieces_set:
                at += size
                total += 1
                break
        else:
            return 0
    return total


def test_small_vocabularies():
    rng = random.Random(2)
    for _ in range(300):
        vocabulary = frozenset(
            "".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 9))
        )
        matcher = token_counts.LongestMatch(vocabulary)
        for _ in range(40):
            word = "".join(rng.choices("abcd" if rng.random() < 0.1 else "abc", k=rng.randint(1, 12)))
            assert matcher.count(word) == greedy(vocabulary, word), (vocabulary, word)


def test_query_equals_brute_force(spark, sf_dir):
    known = frozenset(token_counts.word_pieces(pieces.read_model(MODEL)))
    got = {r["doc_id"]: r for r in QUERIES["op4_token_counts"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        counts = [greedy(known, "▁" + w) for w in (d["text"] or "").split()]
        r = got[d["doc_id"]]
        assert r["n_words"] == len(counts)
        assert r["n_unknown_words"] == counts.count(0)
        assert r["n_tokens"] == sum(c or 1 for c in counts)


def test_messy(messy):
    known = token_counts.word_pieces(pieces.read_model(MODEL))
    rows = token_counts.count_tokens(messy, known).collect()
    assert len(rows) == messy.count()
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)] == [0, 0, 0]
    assert [r["n_words"] for r in rows if r["doc_id"] == 5] == [60_000]
    assert [r["n_unknown_words"] for r in rows if r["doc_id"] == 8] == [1]
    assert token_counts.count_tokens(messy.limit(0), known).count() == 0
    assert token_counts.LongestMatch([]).count("a") == 0
