from __future__ import annotations

import random
import re
import time

from conftest import plain

from cotag.llm import decontamination as dc
from cotag.llm.queries import QUERIES


def _tokens(text: str, fold_case: bool) -> list[tuple]:
    """(kind, value, words) of each canonical token, put together word by word."""
    out: list[list] = []
    for word in text.split():
        code = dc.coded(word)
        kind, core = code & 7, word.strip(dc._EDGES).lower() or word.lower()
        if fold_case:
            out.append([0, core, 1])
        elif kind == dc.NAME and out and out[-1][0] == dc.NAME:
            out[-1] = [dc.NAME, (*out[-1][1], core), out[-1][2] + 1]
        elif kind == dc.UNIT and out and out[-1][0] == dc.NUMBER:
            out[-1] = [dc.MEASURE, (*out[-1][1], core), 2]
        elif kind == dc.MEASURE:
            number = re.match(r"[$€£]?[+-]?\d[\d.,:/]*", core)[0]
            out.append([kind, (number, core[len(number):]), 1])
        else:
            out.append([kind, (core,), 1])
    return [tuple(t) for t in out]


def matches_by_hand(text: str, item: str) -> int:
    """Words of the longest agreeing run, by trying every pair of places and growing it token by
    token, in both readings."""
    return max(_matches(_tokens(text, fold), _tokens(item, fold)) for fold in (False, True))


def _matches(a: list[tuple], b: list[tuple]) -> int:
    size = min(dc.WINDOW, len(b))
    if not size or len(a) < size:
        return 0

    def windows(tokens):
        out = []
        for i in range(len(tokens) - size + 1):
            part = tokens[i : i + size]
            poor = sum(kind == 0 for kind, *_ in part) < dc.LEAST_PLAIN
            out.append(tuple((k, v) if poor or not k else k for k, v, _ in part) + (poor,))
        return out

    wa, wb, best = windows(a), windows(b), 0
    for i in range(len(wa)):
        for j in range(len(wb)):
            end = 0
            while i + end < len(wa) and j + end < len(wb) and wa[i + end] == wb[j + end]:
                end += 1
            if not end:
                continue
            pairs: list = []
            for k in range(end + size - 1):
                x, y = ((t[0], t[1]) if t[0] else None for t in (a[i + k], b[j + k]))
                if x and any(p and (p == x) != (q == y) for p, q in pairs):
                    break
                pairs.append((x, y))
            if len(pairs) >= size:
                best = max(best, sum(t[2] for t in b[j : j + len(pairs)]))
    return best


ITEM = "If Anna buys 12 apples for 3 dollars each and gives Ben 4 of them how much has Anna spent on 12 fruits?"


def test_reparameterised_questions(make_docs, spark):
    bench = spark.createDataFrame([(0, ITEM), (1, "short but Anna has 12 whole words here now"), (2, None),
                                   (3, "")], "item_id long, text string")
    other = ITEM.replace("Anna", "Carla").replace("12", "77").replace("Ben", "Otto").replace("4", "9")
    clash = other.replace("77 fruits", "78 fruits")
    docs = make_docs([
        (1, f"some words before it {ITEM} and after"), (2, f"now {other} and so on"),
        (3, f"now {clash} and so on"), (4, "If Anna buys 12 apples for"), (5, None), (6, ""),
        (7, "we saw: short but Otto has 15 whole words here now."), (8, ITEM.upper()),
        (None, ITEM), (9, "many Apples Here Are Not Words At All " * 40), (10, ITEM), (10, ITEM),
    ])
    got = {(r["doc_id"], r["item_id"]): r["matched_tokens"] for r in dc.find_contamination(docs, bench).collect()}
    size = len(ITEM.split())
    assert got[1, 0] == got[2, 0] == got[10, 0] == got[None, 0] == size
    assert got[3, 0] == size - 2  # up to the slot that clashes
    assert got[7, 1] == 9
    assert got[8, 0] == size  # a copy in capitals
    assert not {4, 5, 6, 9} & {i for i, _ in got}
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 9}  # the row without an id goes too


def test_copies_in_any_case_and_with_values_of_other_lengths(make_docs, spark):
    item = ("A train leaves Paris for Berlin at 5 km per hour and Mary pays 20 dollars for it, so what "
            "does the trip cost when it takes 3 hours more?")
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    swapped = item.replace("Paris", "New York City").replace("5 km", "5km").replace("Mary", "John Smith")
    mixed = swapped.replace("20 dollars", "35kg").replace("Berlin", "San Marino")
    clash = mixed.replace("3 hours", "35 kg")
    texts = [item.lower(), item.upper(), f"we read: {swapped}", f"and {mixed} too", f"and {clash} too",
             item.title()]
    found = dc.find_contamination(make_docs(list(enumerate(texts))), bench)
    got = {r["doc_id"]: r["matched_tokens"] for r in found.collect()}
    assert got == {i: matches_by_hand(t, item) for i, t in enumerate(texts)}
    size = len(item.split())
    assert [got[i] for i in (0, 1, 2, 3, 5)] == [size] * 5
    assert 13 <= got[4] < size  # one value can't stand for two


def test_rows_are_judged_by_their_own_text(make_docs, spark):
    bench = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    rows = [(None, f"{i} {ITEM}") if i % 3 else (None, f"clean text {i}") for i in range(30)]
    rows += [(1, ITEM), (1, "clean under the same id"), (2, "clean")]
    kept = dc.decontaminate(make_docs(rows), bench).collect()
    assert sorted(r["text"] for r in kept) == sorted(t for _, t in rows if "Anna" not in t)


def test_agreement_is_linear():
    n = 100_000
    rows = [{"position": i, "slots": [i % 977 * 8 + 1, 0], "theirs": [i % 977 * 8 + 9, 0],
             "words": [i, i + 1, i + 2], "their_words": [i, i + 1, i + 2]} for i in range(n)]
    start = time.process_time()
    assert dc.longest_agreeing(rows, 2) == (n + 1, 0)
    assert time.process_time() - start < 5


def test_against_brute_force(make_docs, spark):
    rng = random.Random(11)
    words = "alpha beta gamma delta Anna Ben 12 15 3kg 4kg km Rome".split()
    items = [" ".join(rng.choices(words, k=rng.randint(5, 25))) for _ in range(12)]
    texts = []
    for _ in range(40):
        item = rng.choice(items).split()
        part = item[rng.randint(0, 3) :]
        if rng.random() < 0.5:
            part = [w.replace("Anna", "Zoe").replace("12", "9") for w in part]
        texts.append(" ".join(rng.choices(words, k=10) + part + rng.choices(words, k=10)))
    docs = make_docs(list(enumerate(texts)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["matched_tokens"] for r in dc.find_contamination(docs, bench).collect()}
    want = {}
    for i, text in enumerate(texts):
        for j, item in enumerate(items):
            size = matches_by_hand(text, item)
            if size >= min(dc.LEAST_TOKENS, len(item.split())):
                want[i, j] = size
    assert got == want and want


def test_query_finds_whole_items_and_nothing_else(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    got = {(r["doc_id"], r["item_id"]): r for r in QUERIES["op3_benchmark_decontamination"](spark, sf_dir).collect()}
    for d in docs:
        for item in items:
            size = matches_by_hand(d["text"], item["text"]) if (d["doc_id"], item["item_id"]) in got else 0
            whole = item["text"] in d["text"]
            assert not whole or (d["doc_id"], item["item_id"]) in got
            if size:
                assert got[d["doc_id"], item["item_id"]]["matched_tokens"] == size


def test_empty_tables_and_hot_window(make_docs, messy, spark):
    bench = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    assert dc.find_contamination(messy.limit(0), bench).count() == 0
    assert dc.find_contamination(messy, bench.limit(0)).count() == 0
    assert plain(dc.decontaminate(messy, bench), "doc_id") == plain(messy, "doc_id")
    hot = make_docs([(i, f"{i} {ITEM} {i}" if i % 3 == 0 else f"clean text number {i}") for i in range(300)])
    assert {r["doc_id"] for r in dc.find_contamination(hot, bench).collect()} == set(range(0, 300, 3))


def test_short_items_inside_longer_texts(make_docs, spark):
    """Items of fewer tokens than a window, at every length, against a search for their tokens."""
    items = ["Gutenberg", "prime meridian", "who painted Guernica", "Who wrote the famous Iliad?",
             "in which year was Rome founded", "how many of them have 12 legs"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"a rather long and plain text before it {item} and as many words after it, so on" for item in items]
    texts += [*items, "who wrote the Iliad and who did not write it, one asks", "we ask how many of them have 15 legs then",
              "in which year was Oslo founded", "", "who"]
    got = {(r["doc_id"], r["item_id"]): (r["matched_tokens"], r["item_tokens"], r["position"])
           for r in dc.find_contamination(make_docs(list(enumerate(texts))), bench).collect()}
    want = {}
    for i, text in enumerate(texts):
        a = [dc.coded(w) for w in text.split()]
        for j, item in enumerate(items):
            b = [dc.coded(w) for w in item.split()]
            typed = sum(c & 7 == 0 for c in b) >= dc.LEAST_PLAIN
            like = (lambda c: c & 7 or c) if typed else (lambda c: c)
            at = [k for k in range(len(a) - len(b) + 1) if [*map(like, a[k : k + len(b)])] == [*map(like, b)]]
            if at:
                want[i, j] = len(b), len(b), at[0]
    assert got == want and {(i, i) for i in range(6)} <= set(got) and (13, 5) in got and (14, 4) in got
    kept = dc.decontaminate(make_docs(list(enumerate(texts))), bench)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {i for i, _ in got}
