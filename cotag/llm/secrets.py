"""Secrets in whole texts, with weak parts linked to the parts that complete them.

Strong parts are found by their form alone. Weak ones (an account name, a key-like word, an
address) say little alone. They are reported only where, within a scope of ``SCOPE`` characters,
complementary parts occur: an interval join of the identifiers, secrets and endpoints of a text. An
identifier and a secret complete each other; an endpoint needs both, so a link near a hash stays.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from cotag.llm.common import release_kept, small_batches, texts_of

# The base kinds, in this order.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
BASE_KINDS = ("assign", "access", "hex")

# Weak parts: kind, pattern, the group whose span counts.
WEAK = (
    ("identifier", re.compile(
        r"""(?i:client_id|access_key_id|account_id|user_?name|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
        re.ASCII,
    )),
    ("endpoint", re.compile(
        r"""(?:https?|ftp|postgres|mysql|redis|mongodb)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])""",
        re.ASCII,
    )),
    ("keylike", re.compile(
        r"""(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])""",
        re.ASCII,
    )),
)
KINDS = (*BASE_KINDS, *(kind for kind, _ in WEAK))
_ROLE = {
    "assign": "secret", "hex": "secret", "keylike": "secret",
    "access": "identifier", "identifier": "identifier", "endpoint": "endpoint",
}

#: What a weak part of a kind needs in its scope, all of it.
NEEDED = {"identifier": ("secret",), "keylike": ("identifier",), "endpoint": ("identifier", "secret")}
#: Bits a character that a key-like word must have; spelled-out names have less.
LEAST_ENTROPY = 3.5
#: Parts whose nearest ends are at most so many code points apart are in one scope.
SCOPE = 200

SPANS = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_linked long"
)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Strong parts as (start, end, kind), by start, then kind as listed.

    Each kind is matched leftmost and without overlap on its own; a match that is too short is
    dropped, yet what it covered is not searched again.
    """
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [
            (m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20
        ]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def entropy(word: str) -> float:
    """Bits a character, by the counts of a word's characters."""
    n = len(word)
    return -sum(c / n * math.log2(c / n) for c in Counter(word).values())


def _covers(spans: Iterable[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that spans cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end, _ in sorted(spans):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


class _Reach:
    """Parts of one role by start, with the furthest end up to each of them."""

    def __init__(self, parts: list[Span]):
        self._starts = [s for s, _, _ in parts]
        self._ends = list(accumulate((e for _, e, _ in parts), max))

    def meets(self, low: int, high: int) -> bool:
        """Whether a part begins at ``high`` or before and ends at ``low`` or behind."""
        at = bisect.bisect_right(self._starts, high)
        return at > 0 and self._ends[at - 1] >= low


def linked_spans(text: str, base: list[Span], scope: int = SCOPE) -> list[Span]:
    """Weak parts that complementary parts support (``NEEDED``), outside of the base spans.

    Kinds are sought in order, and a part that overlaps one of an earlier kind is none. The join
    takes the parts of a role by start: one that reaches into a scope exists exactly if the
    furthest end among those that begin before the scope's end does, so each part costs a bisection.
    """
    weak: list[Span] = []
    for kind, pattern in WEAK:
        starts, ends = _covers([*base, *weak])
        found = []
        for m in pattern.finditer(text):
            start, end = m.span(m.lastindex or 0)
            at = bisect.bisect_left(starts, end)
            if at and ends[at - 1] > start:
                continue
            if kind != "keylike" or entropy(text[start:end]) >= LEAST_ENTROPY:
                found.append((start, end, kind))
        weak += found
    parts = sorted([*base, *weak])
    roles = {
        role: _Reach([p for p in parts if _ROLE[p[2]] == role]) for role in ("identifier", "secret")
    }
    return [
        (start, end, kind) for start, end, kind in weak
        if all(roles[r].meets(start - scope, end + scope) for r in NEEDED[kind])
    ]


def all_spans(text: str, scope: int = SCOPE) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, both in order."""
    base = base_spans(text)
    return base, sorted([*base, *linked_spans(text, base, scope)], key=_order)


def spelt(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each stretch that spans cover replaced by ``<SECRET>``."""
    pieces, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            pieces += [text[at:start], "<SECRET>"]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Spans of every whole text, one row per input row.

    (doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked): base spans are written
    kind:start:end in code points, end exclusive, joined by commas, and hashed; ``spans`` holds all
    spans. A missing or empty text has none. Texts are scanned where they are read, without a
    shuffle; other columns are not read.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for text in texts_of(batch):
                base, spans = all_spans(text, scope)
                kinds = [k for _, _, k in base]
                digest = hashlib.sha256(spelt(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in BASE_KINDS), digest, spelt(spans),
                             len(spans) - len(base)))
            columns = zip(*rows, strict=True) if rows else [()] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=[part.split()[0] for part in SPANS.split(", ")],
            )

    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, SPANS)


def redact_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with every found stretch replaced by ``<SECRET>`` in ``text``.

    ``n_chars``, if there, is the new length where a text changed. All rows and columns stay; a
    missing text stays missing.
    """
    names = docs.columns

    def run(batches):
        release_kept()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            fresh = []
            for text in texts:
                spans = all_spans(text, scope)[1] if text else []
                fresh.append(redacted(text, spans) if spans else text)
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(fresh, batch.schema.field("text").type)
            if "n_chars" in columns:
                counts = [
                    n if new is old or new is None else len(new)
                    for n, old, new in zip(
                        columns["n_chars"].to_pylist(), texts, fresh, strict=True
                    )
                ]
                columns["n_chars"] = pa.array(counts, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
