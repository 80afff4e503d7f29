"""Repair of conversation structure by weighted parsing of spans.

A well-formed conversation is empty or an optional system turn and then pairs of a user and an
assistant turn. The repair grammar is in Chomsky normal form: its nonterminals are [p, r], "the span
leads from state p to state r", with rules [p, r] -> [p, q] [q, r], and [p, q] -> one turn for each
edit of a turn. A cell of the parse table holds, for each nonterminal, the least (cost, edits) of
its span; a cell is closed under insertion, which derives turns from nothing. Cells are combined
bottom-up by span length.

Two parses of a span between the same states that have equal costs never have edits of which one
begins with the other: the states an edit text passes through are determined, so the rest would be
insertions, which cost something. Hence the order by (cost, edits) holds in every context and cells
need one entry per nonterminal. The grammar being regular, every split of a span gives the same
cell. Spans of up to ``BLOCK`` turns try all splits; longer ones are put together from blocks,
neighbours of equal length first, which keeps the work linear, and lets the parts of a very long
conversation be parsed in different tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotag.functions.joins import held
from cotag.llm.common import small_batches, text_key
from cotag.session import ensure_checkpoints

#: Turns of a span whose splits are all tried.
BLOCK = 16
#: Conversations of more turns are parsed in parts.
LONG_TURNS = 1000

# The costs of edits, and what ends a sentence and what counts as blank.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ENDS = ".!?"
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_AFTER_TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_PAIRS = [(p, r) for p in range(4) for r in range(4) if r >= p or (p, r) == (ASSISTANT, USER)]
_AT = {pair: i for i, pair in enumerate(_PAIRS)}
_RULES = [
    (_AT[p, r], _AT[p, q], _AT[q, r], q)
    for p, r in _PAIRS for q in range(4) if (p, q) in _AT and (q, r) in _AT
]

#: (cost, edits, state in the middle) for each nonterminal, None where it derives nothing.
Cell = list


def joined(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """The cell of two neighbouring spans, or ``into`` improved by this split."""
    cell = [None] * len(_PAIRS) if into is None else into
    for target, a, b, q in _RULES:
        x, y = left[a], right[b]
        if x is None or y is None:
            continue
        cost, best = x[0] + y[0], cell[target]
        if best is None or cost < best[0]:
            cell[target] = (cost, x[1] + y[1], q)
        elif cost == best[0]:
            edits = x[1] + y[1]
            if edits < best[1]:
                cell[target] = (cost, edits, q)
    return cell


def _insertions() -> Cell:
    cell: Cell = [None] * len(_PAIRS)
    for p in range(4):
        cell[_AT[p, p]] = (0, "", p)
    for p in range(4):
        one = _AFTER_TURN[p]
        for steps, r in ((1, one), (2, _AFTER_TURN[one])):
            if cell[_AT[p, r]] is None:
                cell[_AT[p, r]] = (INSERT * steps, "I" * steps, p)
    return cell


_INSERTED = _insertions()


def turn_cell(initial: str, must_go: bool, truncated: bool, copies: int = 1) -> Cell:
    """The closed cell of one turn, or of ``copies`` neighbours that must all go."""
    cell: Cell = [None] * len(_PAIRS)
    for p in range(4):
        cell[_AT[p, p]] = (DELETE * copies, "D" * copies, p)
    if not must_go:
        extra = TRUNCATED if truncated else 0
        for p, r in _AFTER_TURN.items():
            kept = initial == _NEXT_ROLE[p][0]
            cell[_AT[p, r]] = (extra, "K", p) if kept else (REROLE + extra, "R", p)
        if initial == "s":
            cell[_AT[START, SYSTEM]] = (extra, "K", START)
    return joined(joined(_INSERTED, cell), _INSERTED)


def parse_block(leaves: list[Cell]) -> Cell:
    """The cell of the whole of ``leaves``: all spans by length, all their splits."""
    n = len(leaves)
    spans = {(i, i + 1): leaf for i, leaf in enumerate(leaves)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell = None
            for k in range(i + 1, i + length):
                cell = joined(spans[i, k], spans[k, i + length], cell)
            spans[i, i + length] = cell
    return spans[0, n]


class Spans:
    """Neighbouring spans that are combined when they are of equal length, then at the end."""

    def __init__(self) -> None:
        self._leaves: list[Cell] = []
        self._stack: list[tuple[int, Cell]] = []

    def add(self, leaf: Cell) -> None:
        self._leaves.append(leaf)
        if len(self._leaves) == BLOCK:
            self._close()

    def _close(self) -> None:
        size, cell = 1, parse_block(self._leaves)
        self._leaves = []
        while self._stack and self._stack[-1][0] == size:
            before = self._stack.pop()[1]
            size, cell = 2 * size, joined(before, cell)
        self._stack.append((size, cell))

    def whole(self) -> Cell:
        """The cell of all that was added."""
        if self._leaves:
            self._close()
        if not self._stack:
            return _INSERTED
        cell = self._stack.pop()[1]
        while self._stack:
            cell = joined(self._stack.pop()[1], cell)
        return cell


def cheapest(cell: Cell) -> tuple[int, str, int]:
    """(cost, edits, last state) of the best well-formed repair."""
    found = [(*cell[_AT[START, r]][:2], r) for r in (START, ASSISTANT) if cell[_AT[START, r]]]
    return min(found)


@dataclass
class Turns:
    """What is known of neighbouring turns of one conversation, in order."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    least: int | None = None
    most: int | None = None
    first: tuple | None = None  # (turn, initial)
    last: tuple | None = None
    spans: Spans = field(default_factory=Spans)

    def add(self, turn: int | None, role: str, text: str, seen: bool, copies: int = 1) -> None:
        """The next turn, with ``copies - 1`` equal ones behind it; ``seen`` if one came before."""
        initial, end = role[:1], text.rstrip(BLANKS)[-1:]
        self._step((turn, initial), copies)
        if not end:
            self.blank += copies
            self.spans.add(turn_cell(initial, True, False, copies))
            return
        again = copies if seen else copies - 1
        if not seen:
            cut = end not in ENDS
            self.truncated += cut
            self.spans.add(turn_cell(initial, False, cut))
        if again:
            self.duplicate += again
            self.spans.add(turn_cell(initial, True, False, again))

    def _step(self, here: tuple, copies: int) -> None:
        turn, initial = here
        if self.first is None:
            self.first = here
        else:
            self.illegal += self.last[1] + initial not in LEGAL
        self.illegal += copies - 1  # an initial beside itself
        if turn is not None:
            if self.last is None or self.last[0] != turn:
                self.distinct += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.last = here

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.distinct


def replay(state: int, edits: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple]:
    """(edit, role, text) of each turn that ``edits`` leave or insert, from ``state`` on."""
    rest = iter(turns)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rest)
        if edit == "D":
            continue
        if edit == "K":
            state = SYSTEM if role[:1] == "s" else _AFTER_TURN[state]
        else:
            role, state = _NEXT_ROLE[state], _AFTER_TURN[state]
        yield edit, role, text


class _Digest:
    """SHA-256 of lines joined by line ends, fed line by line."""

    def __init__(self) -> None:
        self._hash, self._any = hashlib.sha256(), False

    def add(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self._hash.update((f"\n{line}" if self._any else line).encode("utf-8", "surrogatepass"))
        self._any = True

    def hex(self) -> str:
        return self._hash.hexdigest()


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_COUNT_FIELDS = [(c, pa.int64()) for c in _COUNTS]
REPORT = (
    "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, "
    "repaired_sha256 string"
)
TURNS = "conv_id long, place long, role string, text string, edit string"
_REPORT = pa.schema([("conv_id", pa.int64()), *_COUNT_FIELDS, ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])
_TURNS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()),
                    ("text", pa.string()), ("edit", pa.string())])
_ORDER = ("conv_id", "turn", "role", "_k")


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _groups(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with equal first ``width`` fields; a run is read before the next one."""
    pending = next(rows, None)
    while pending is not None:
        key = pending[:width]

        def run():
            nonlocal pending
            while pending is not None and pending[:width] == key:
                row, pending = pending, next(rows, None)
                yield row[width:]

        yield key, run()


def _batches(rows: Iterator[tuple], fields: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    for row in rows:
        done.append(row)
        if len(done) == size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*done), fields)], schema=fields)
            done = []
    if done:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*done), fields)], schema=fields)


def _prepared(turns: DataFrame, present: Column | None) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        (F.lit(True) if present is None else present).alias("_here"),
    ).withColumn("_k", text_key(F.col("text")))


def _split(rows: DataFrame, long_turns: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the usual conversations and of the long ones, if there are any."""
    many = held(
        rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > long_turns).select(F.col("conv_id").alias("_long"))
    )
    if not many.rows:
        return rows, None
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    return rows.join(many.prepared(), same, "left_anti"), rows.join(many.prepared(), same, "left_semi")


def _short(rows: DataFrame, texts: bool) -> DataFrame:
    """Whole conversations of bounded length, one after the other in each task."""

    def work(batches):
        stream = _rows(batches, "conv_id", "turn", "role", "text", "_here", "_k")
        for (conv_id,), run in _groups(stream, 1):
            known, seen, kept = Turns(), set(), []
            for turn, role, text, here, key in run:
                if here:
                    known.add(turn, role, text, (role, key) in seen)
                    seen.add((role, key))
                    kept.append((role, text))
            cost, edits, _ = cheapest(known.spans.whole())
            left = replay(START, edits, kept)
            if texts:
                for place, (edit, role, text) in enumerate(left):
                    yield conv_id, place, role, text, edit
            else:
                digest = _Digest()
                for _, role, text in left:
                    digest.add(role, text)
                yield (conv_id, known.gaps(), known.blank, known.duplicate, known.truncated,
                       known.illegal, cost, edits, digest.hex())

    dealt = rows.repartition("conv_id").sortWithinPartitions(*_ORDER)
    return dealt.mapInArrow(lambda batches: _batches(work(batches), _TURNS if texts else _REPORT),
                            TURNS if texts else REPORT)


_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("_part", pa.int64()),
    *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "distinct", "least",
                                "most", "turn1", "turn2")),
    ("initial1", pa.string()), ("initial2", pa.string()),
    ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string())),
])
_SEGMENT_DDL = (
    "conv_id long, _part long, blank long, duplicate long, truncated long, illegal long, "
    "distinct long, least long, most long, turn1 long, turn2 long, initial1 string, "
    "initial2 string, costs array<long>, edits array<string>"
)
_PLAN = pa.schema([("conv_id", pa.int64()), ("_part", pa.int64()), ("state", pa.int64()),
                   ("before", pa.int64()), ("part_edits", pa.string()), *_COUNT_FIELDS,
                   ("audit", pa.string())])
_PLAN_DDL = (
    "conv_id long, _part long, state long, before long, part_edits string, "
    + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string"
)


def _segments(placed: DataFrame) -> DataFrame:
    """One row per conversation and part: counts and the cell of its span."""

    def work(batches):
        stream = _rows(batches, "conv_id", "_part", "turn", "role", "text", "_first", "_copies")
        for (conv_id, part), run in _groups(stream, 2):
            known = Turns()
            for turn, role, text, first, copies in run:
                known.add(turn, role, text, not first, copies)
            cell = known.spans.whole()
            yield (conv_id, part, known.blank, known.duplicate, known.truncated, known.illegal,
                   known.distinct, known.least, known.most, known.first[0], known.last[0],
                   known.first[1], known.last[1],
                   [c and c[0] for c in cell], [c and c[1] for c in cell])

    return placed.mapInArrow(lambda b: _batches(work(b), _SEGMENT, 10), _SEGMENT_DDL)


def _choose(cells: list[Cell], start: int, end: int) -> list[tuple[int, str]]:
    """State before and edits of each of ``cells`` in the best parse from ``start`` to ``end``."""
    levels = [cells]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([
            joined(below[i], below[i + 1]) if i + 1 < len(below) else below[i]
            for i in range(0, len(below), 2)
        ])
    spans = [(start, end)]
    for level, below in zip(levels[:0:-1], levels[-2::-1], strict=True):
        halves = []
        for i, (p, r) in enumerate(spans):
            if 2 * i + 1 < len(below):
                q = level[i][_AT[p, r]][2]
                halves += [(p, q), (q, r)]
            else:
                halves.append((p, r))
        spans = halves
    return [(p, cell[_AT[p, r]][1]) for cell, (p, r) in zip(cells, spans, strict=True)]


def _plans(segments: DataFrame) -> DataFrame:
    """The best parse of each conversation, as the edits of its parts. The counts and the edits of
    the whole stand beside its first part. A conversation has at most one segment per part."""

    def work(batches):
        stream = _rows(batches, *_SEGMENT.names)
        for (conv_id,), run in _groups(stream, 1):
            parts = [dict(zip(_SEGMENT.names[1:], row, strict=True)) for row in run]
            cells = [[None if c is None else (c, e, None) for c, e in
                      zip(p["costs"], p["edits"], strict=True)] for p in parts]
            illegal = sum(p["illegal"] for p in parts)
            distinct = sum(p["distinct"] for p in parts)
            for a, b in zip(parts, parts[1:], strict=False):
                illegal += a["initial2"] + b["initial1"] not in LEGAL
                distinct -= a["turn2"] is not None and a["turn2"] == b["turn1"]
            whole = Spans()
            for cell in cells:
                whole.add(cell)
            cost, edits, end = cheapest(whole.whole())
            least = [p["least"] for p in parts if p["least"] is not None]
            gaps = max(p["most"] for p in parts if least and p["most"] is not None) - min(
                least) + 1 - distinct if least else 0
            counts = (gaps, *(sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")),
                      illegal, cost, edits)
            before = 0
            for i, (part, (state, own)) in enumerate(
                zip(parts, _choose(cells, START, end), strict=True)
            ):
                yield (conv_id, part["_part"], state, before, own,
                       *(counts if not i else (None,) * len(counts)))
                before += len(own) - own.count("D")

    dealt = segments.repartition("conv_id").sortWithinPartitions("conv_id", "_part")
    return dealt.mapInArrow(lambda b: _batches(work(b), _PLAN, 10), _PLAN_DDL)


def _long(rows: DataFrame, texts: bool) -> DataFrame:
    """Very long conversations, cut into parts by a range sort and parsed part by part.

    Equal turns are counted before they are sorted, so repeats of one row make no hot key. Cells
    meet in one task per conversation, at most one for each part. The repaired lines run through
    one task in order for the digest, which can't be had otherwise, but are never held there.
    """
    ensure_checkpoints(rows.sparkSession)
    keys = ["conv_id", "turn", "role", "_k"]
    there = rows.filter("_here").groupBy(*keys).agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("_copies")
    )
    firsts = there.groupBy("conv_id", "role", "_k").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("t"), "turn")).alias("m")
    ).select(*(F.col(c).alias(f"_f{c}") for c in ("conv_id", "role", "_k")),
             F.col("m.turn").alias("_fturn"), F.lit(True).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_f{c}")) for c in keys]
    placed = (
        there.join(firsts, same, "left")
        .select(*keys, "text", "_copies", F.coalesce("_first", F.lit(False)).alias("_first"))
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id().cast("long"),
                      "_at": F.monotonically_increasing_id()})
        .checkpoint()
    )
    plans = _plans(_segments(placed)).checkpoint()
    both = placed.select(
        "conv_id", "_part", "_at", "role", "text", "_copies", F.lit(None).cast("long").alias("state"),
        F.lit(None).cast("long").alias("before"), F.lit(None).cast("string").alias("part_edits"),
    ).unionByName(plans.select("conv_id", "_part", F.lit(-1).cast("long").alias("_at"), "state",
                               "before", "part_edits"), allowMissingColumns=True)
    names = ("conv_id", "_part", "state", "before", "part_edits", "role", "text", "_copies")

    def repaired(run) -> Iterator[tuple]:
        state, before, edits, *_ = next(run)
        turns = (pair for *_, role, text, copies in run for pair in [(role, text)] * copies)
        for i, (edit, role, text) in enumerate(replay(state, edits, turns)):
            yield before + i, role, text, edit
        for _ in run:  # turns that are deleted at the end
            pass

    def rows_of(batches):
        for (conv_id, _), run in _groups(_rows(batches, *names), 2):
            for row in repaired(run):
                yield conv_id, *row

    def digests(batches):
        last, digest = None, None
        for (conv_id, _), run in _groups(_rows(batches, *names), 2):
            if digest is None or conv_id != last:
                if digest is not None:
                    yield last, digest.hex()
                last, digest = conv_id, _Digest()
            for _, role, text, _ in repaired(run):
                digest.add(role, text)
        if digest is not None:
            yield last, digest.hex()

    if texts:
        dealt = both.repartition("conv_id", "_part").sortWithinPartitions("conv_id", "_part", "_at")
        return dealt.mapInArrow(lambda b: _batches(rows_of(b), _TURNS), TURNS)
    hashes = pa.schema([("_id", pa.int64()), ("repaired_sha256", pa.string())])
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "_part", "_at")
    hashed = dealt.mapInArrow(lambda b: _batches(digests(b), hashes),
                              "_id long, repaired_sha256 string")
    # A long conversation none of whose rows is there has no part.
    ids = rows.select("conv_id").distinct()
    found = (
        plans.filter("audit is not null").drop("_part", "state", "before", "part_edits")
        .join(hashed, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
        .withColumnRenamed("conv_id", "_id")
    )
    empty = {**{c: F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS},
             "audit": F.coalesce("audit", F.lit("")).alias("audit"),
             "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))
             .alias("repaired_sha256")}
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        "conv_id", *empty.values()
    )


def _repair(turns: DataFrame, present: Column | None, long_turns: int, texts: bool) -> DataFrame:
    small_batches(turns.sparkSession)
    usual, long = _split(_prepared(turns, present), long_turns)
    found = _short(usual, texts)
    return found if long is None else found.unionByName(_long(long, texts))


def repair_conversations(
    turns: DataFrame, present: Column | None = None, long_turns: int = LONG_TURNS
) -> DataFrame:
    """One row per conversation: its faults, and the cheapest repair with its cost and edits.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not read. Turns are
    taken by ``turn``, missing ones first, then by role and text key. A missing role or text counts
    as one space; a turn with an empty role can't be kept as it is; rows without ``conv_id`` form one
    conversation. A row for which ``present`` does
    not hold only names its conversation. Repeated rows are duplicates.

    A turn's first fault counts: blank, duplicate of an earlier one, truncated. ``audit`` has a
    letter per edit: Keep, Rerole, Delete, Insert. Conversations of up to ``long_turns`` rows go
    through one shuffle; see :func:`_long` for the others.
    """
    return _repair(turns, present, long_turns, texts=False)


def repaired_turns(
    turns: DataFrame, present: Column | None = None, long_turns: int = LONG_TURNS
) -> DataFrame:
    """The turns of the repaired conversations, numbered from 0, with the edit that gave each."""
    return _repair(turns, present, long_turns, texts=True)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops a turn (it stays as a row that is not ``present``), 1 empties it, 2 takes its sentence
    ends, 3 repeats it, 4 makes it a user's. Missing values are one space.
    """
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c)
                      for c in ("conv_id", ":", "turn")))
    kind = F.crc32(name) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id", "turn", kind.alias("_kind"), role.alias("role"), text.alias("text")
    ).select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind").isin(0, 1), "")
        .when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("_kind") != 0).alias("present"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")
