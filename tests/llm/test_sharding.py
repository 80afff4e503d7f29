from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from conftest import plain

from cotag.llm import sharding
from cotag.llm.queries import QUERIES


def difference_by_hand(sizes: list[int], parts: int) -> list[int]:
    """Karmarkar-Karp with plain lists: the sorted sums of the parts."""
    partial = [sorted([s] + [0] * (parts - 1)) for s in sizes]
    while len(partial) > 1:
        partial.sort(key=lambda p: p[-1] - p[0])
        a, b = partial.pop(), partial.pop()
        partial.append(sorted(x + y for x, y in zip(a, reversed(b), strict=True)))
    return partial[0]


def test_two_way_differencing_by_hand():
    loads, places = sharding.difference([[s, 0] for s in (4, 5, 6, 7, 8)], 2)
    assert sorted(loads) == [14, 16] == difference_by_hand([4, 5, 6, 7, 8], 2)


def test_loads_are_those_of_the_places():
    rng = random.Random(1)
    for _ in range(100):
        parts = rng.randint(1, 6)
        sizes = [[rng.randint(0, 50) for _ in range(parts)] for _ in range(rng.randint(1, 20))]
        loads, places = sharding.difference(sizes, parts)
        sums = [0] * parts
        for size, where in zip(sizes, places, strict=True):
            assert sorted(where) == list(range(parts))
            for s, w in zip(size, where, strict=True):
                sums[w] += s
        assert sums == loads


def test_spread_is_that_of_the_plain_algorithm():
    rng = random.Random(4)
    for _ in range(30):
        sizes = rng.sample(range(1, 10**6), 60)  # no ties
        loads, _ = sharding.difference([[s, 0, 0, 0] for s in sizes], 4)
        assert sorted(loads) == difference_by_hand(sizes, 4)


def check_contract(docs, rows):
    assert len(rows) == len(docs)
    want = Counter(
        (d["doc_id"], len((d["text"] or "").encode()) + 16, zlib.crc32((d["text"] or "").encode()))
        for d in docs
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, loads = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r["shard"] < 40 and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    shards = defaultdict(set)
    texts = {d["doc_id"]: d["text"] or "" for d in docs}
    for r in rows:
        shards[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())
    return loads


def test_query_balances_bytes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = QUERIES["op6_sharding"](spark, sf_dir).collect()
    loads = check_contract(docs, rows)
    groups = Counter()
    for r, in zip(rows, strict=True):
        groups[r["text_crc32"], r["size"]] += r["size"]
    largest, mean = max(groups.values()), sum(loads.values()) / 40
    if largest <= mean:  # no group alone exceeds a shard
        assert max(loads.values()) <= mean + largest


def test_levels_give_balance_too(spark, make_docs):
    rng = random.Random(3)
    texts = ["x" * rng.randint(1, 400) + str(i) for i in range(3000)]
    docs = make_docs(list(enumerate(texts)))
    rows = sharding.shard_documents(docs, bucket=50, slot_rows=10).collect()  # three levels
    loads = check_contract(docs.collect(), rows)
    assert max(loads.values()) - min(loads.values()) < 60


def test_messy_and_hot_group(make_docs, messy):
    rows = sharding.shard_documents(messy).collect()
    ids = [r["doc_id"] for r in rows]
    assert len(rows) == messy.count() and ids.count(7) == 2 and ids.count(None) == 2
    empty = {r["shard"] for r in rows if r["doc_id"] in (2, 3)}
    assert len(empty) == 1 and {r["size"] for r in rows if r["doc_id"] == 2} == {16}
    assert sharding.shard_documents(messy.limit(0)).count() == 0
    hot = make_docs([(i, "same" if i % 3 == 0 else f"t{i}" * 3) for i in range(600)])
    check_contract(hot.collect(), sharding.shard_documents(hot, slot_rows=2).collect())


def test_repeatable(messy):
    names = ("doc_id", "size", "shard", "slot")
    assert plain(sharding.shard_documents(messy), *names) == plain(
        sharding.shard_documents(messy.repartition(5)), *names
    )
