from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cotag.llm import conversations as cv
from cotag.llm.queries import QUERIES

#: Columns that clash with names used inside of the operator.
CLASHING = "_here _k _n _long _part _at _first _copies _kind state before part_edits _id".split()

GOOD = re.compile("(s?(ua)+)?")


def every_repair(rows):
    """The least (cost, edits, initials) of all lists of edits, tried one by one. Rows are
    (initial, must go, truncated)."""
    n, best = len(rows), [(3 * len(rows) + 1, "", "")]

    def go(i, cost, edits, out, inserted):
        if cost > best[0][0] or not re.fullmatch("s?(ua)*u?", out):
            return
        if i == n and GOOD.fullmatch(out):
            best[0] = min(best[0], (cost, edits, out))
        if inserted < n + 2:
            for r in "ua":
                go(i, cost + 2, edits + "I", out + r, inserted + 1)
        if i < n:
            initial, gone, cut = rows[i]
            go(i + 1, cost + 3, edits + "D", out, inserted)
            if not gone:
                go(i + 1, cost + cut, edits + "K", out + initial, inserted)
                for r in "ua":
                    go(i + 1, cost + 2 + cut, edits + "R", out + r, inserted)

    go(0, 0, "", "", 0)
    return best[0]


def by_search(rows):
    """The same by uniform-cost search over (turns read, last initial)."""
    heap = [(0, "", 0, "")]
    done = set()
    while heap:
        cost, edits, i, out = heapq.heappop(heap)
        if (i, out[-1:]) in done:
            continue
        done.add((i, out[-1:]))
        if i == len(rows) and GOOD.fullmatch(out):
            return cost, edits, out
        steps = [(2, "I", 0, r) for r in "ua"]
        if i < len(rows):
            initial, gone, cut = rows[i]
            steps.append((3, "D", 1, ""))
            if not gone:
                steps += [(cut, "K", 1, initial)] * bool(initial)
                steps += [(2 + cut, "R", 1, r) for r in "ua"]
        for more, letter, read, r in steps:
            if re.fullmatch("s?(ua)*u?", out + r):
                heapq.heappush(heap, (cost + more, edits + letter, i + read, out + r))


def _random_rows(rng, n):
    return [(rng.choice("uauasx"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]


def _parsed(rows):
    spans = cv.Spans()
    for row in rows:
        spans.add(cv.turn_cell(*row))
    return cv.cheapest(spans.whole())[:2]


def test_equals_every_repair():
    rng = random.Random(3)
    for _ in range(600):
        rows = _random_rows(rng, rng.randint(0, 5))
        want = every_repair(rows)
        assert _parsed(rows) == want[:2]
        assert by_search(rows) == want


def test_long_spans_equal_search():
    rng = random.Random(4)
    for n in (15, 16, 17, 33, 80, 300):
        rows = _random_rows(rng, n)
        assert _parsed(rows) == by_search(rows)[:2]


def _report(rows):
    """What is due for the damaged rows (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                       hashlib.md5(r[2].encode()).hexdigest()))
    counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    seen, parsed = set(), []
    for _, role, text in rows:
        end = re.findall("[^\x20\x09-\x0d]", text)[-1:]
        fault = None
        if not end:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif end[0] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        parsed.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, edits, out = by_search(parsed)
    left, lines = iter(rows), []
    for letter in edits:
        _, role, text = (None, "", "") if letter == "I" else next(left)
        if letter != "D":
            new = {"u": "user", "a": "assistant"}.get(out[len(lines)])
            lines.append(f"{role if letter == 'K' else new}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(), illegal,
            cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _damage(rows):
    """Damaged rows by conversation."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return found


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256")


def test_query_equals_brute_force(spark, sf_dir):
    got = QUERIES["op12_conversation_repair"](spark, sf_dir)
    assert tuple(got.columns) == COLUMNS
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    want = _damage((r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {c: _report(t) for c, t in want.items()}


@pytest.fixture(scope="module")
def untidy(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No", "Why?", "", " \t", None, "A long one!  ", "ünï 日本.", "x" * 50_000]
    roles = ["user", "assistant", "system", None, "", "tool", "umpire"]
    rows = [
        (rng.choice([1, 2, 2, 2, 3, None]), rng.choice([None, *range(12)]), rng.choice(roles),
         rng.choice(texts)) for _ in range(300)
    ]
    rows += [(7, 3, "user", "Same.")] * 120 + [(8, t, "user", "Same.") for t in range(90)]
    rows += [(9, None, None, None), (10, 0, "user", "Hi."), (10, 1, "assistant", "Hello.")]
    rows += [(i, t, "user", "Go.") for i in range(100, 120) for t in (0,)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return rows, df.repartition(5).withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.mark.parametrize("long_turns", [1000, 60, 0])
def test_untidy_at_all_lengths(untidy, long_turns):
    rows, df = untidy
    want = {c: _report(t) for c, t in _damage(rows).items()}
    got = cv.repair_conversations(cv.damaged(df), F.col("present"), long_turns)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(want)
    assert {r[0]: r[1:] for r in found} == want


@pytest.mark.parametrize("long_turns", [1000, 0])
def test_repaired_turns(untidy, long_turns):
    _, df = untidy
    turns = cv.damaged(df)
    report = {r["conv_id"]: r for r in
              cv.repair_conversations(turns, F.col("present"), long_turns).collect()}
    lines = {}
    for r in cv.repaired_turns(turns, F.col("present"), long_turns).collect():
        lines.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"], r["edit"]))
    for conv, row in report.items():
        own = sorted(lines.get(conv, []))
        assert [p for p, *_ in own] == list(range(len(own)))
        assert "".join(e for *_, e in own) == row["audit"].replace("D", "")
        assert GOOD.fullmatch("".join(r[:1] for _, r, _, _ in own))
        text = "\n".join(f"{r}:{t}" for _, r, t, _ in own)
        assert hashlib.sha256(text.encode()).hexdigest() == row["repaired_sha256"]


def test_empty_table(untidy):
    _, df = untidy
    assert cv.repair_conversations(df.limit(0)).count() == 0
    assert cv.repair_conversations(df.limit(0), long_turns=0).count() == 0
    assert cv.repaired_turns(df.limit(0)).count() == 0
