"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question with other values in it keeps its
template. Neighbouring names are one slot, and so are a number and the unit behind it, so values of
other lengths shift nothing. Windows of ``WINDOW`` canonical tokens are hashed; beside them, windows
of the case-folded words without any slots, as the case of a copy says nothing. Windows of documents
that may occur in the benchmark go into a hash join with those of its items; an item shorter than a
window is a window of its own length, and documents are hashed at that length too. Windows that
match in a row at one offset make a run, and a run counts only as far as its slots agree: one value
of the item stands for one value of the document, and the other way round.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotag.functions.joins import held
from cotag.llm.common import (
    WordTable, arrow_fields, by_group, release_kept, small_batches, text_key, texts_of,
)

WINDOW = 8
#: A window needs so many plain words; one with fewer is hashed with its values, not its template.
LEAST_PLAIN = 3
#: Words of the item that a run must cover; a shorter item must match as a whole.
LEAST_TOKENS = 13
#: Bits of the filter that documents' windows pass before the join: 4 MB at any benchmark size.
FILTER_BITS = 25

# Units that follow or end a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres centimeter centimeters mg g kg lb lbs oz gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon "
    "gallons cup cups s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years usd eur gbp dollar dollars cent cents euro euros percent mph kmh kph "
    "c f k watt watts volt volts hz khz mhz ghz kb mb gb tb".split()
)
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
_MEASURE = re.compile(r"([$€£]?[+-]?\d[\d.,:/]*)([^\W\d]+)")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "$%") + "¿¡«»“”‘’…"

WINDOWS = (
    "doc_id long, text_key string, reading long, position long, hash long, slots array<long>, "
    "words array<long>"
)
MATCHES = "doc_id long, text_key string, item_id long, matched_tokens long, item_tokens long, position long"


NUMBER, MEASURE, UNIT, NAME = 1, 2, 3, 4
#: What the slots of a kind count as in a template; a plain word counts as itself.
_TEMPLATE = np.array(
    [0, *(xxhash.xxh3_64_intdigest(f"<{k}>") >> 1 for k in "1234"), 0, 0, 0], np.int64
)


def _value(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1 & ~7


_FIRST, _SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _together(number: int, unit: int) -> int:
    """The value of a number and its unit, written as one word or as two."""
    return (number * _FIRST + unit * _SECOND) % 2**63 & ~7


def coded(word: str) -> int:
    """A word's code: its hash, with the kind of its slot in the low three bits, 0 for none.

    Case and outer punctuation do not count, except that a word in title case is a name.
    """
    core = word if word.isalnum() else word.strip(_EDGES) or word
    low = core.lower()
    value = _value(low)
    if low == core and core.isalpha():
        return value | UNIT if low in UNITS and len(low) > 1 else value
    if _NUMBER.fullmatch(core):
        return value | NUMBER
    measure = _MEASURE.fullmatch(core)
    if measure and measure[2].lower() in UNITS:
        return _together(_value(measure[1]), _value(measure[2].lower())) | MEASURE
    if low in UNITS and len(low) > 1:
        return value | UNIT
    if len(core) > 1 and core[0].isupper() and core[1:].islower():
        return value | NAME
    return value


def word_codes() -> WordTable:
    """Codes of words; each task makes its own table and frees it at its end."""
    release_kept()
    return WordTable(coded)


_STEP = np.uint64(_FIRST)
_KEEP = np.uint64(2**63 - 8)


def folded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Canonical tokens of the coded words ``values``, and the first word of each and the end.

    A run of names becomes one name, a number and the unit behind it one measure.
    """
    n = len(values)
    kinds = values & 7
    name = kinds == NAME
    unit_of_number = (kinds[1:] == UNIT) & (kinds[:-1] == NUMBER)
    first = np.ones(n, bool)
    first[1:] = ~(unit_of_number | (name[1:] & name[:-1]))
    starts = np.flatnonzero(first)
    bounds = np.append(starts, n)
    tokens = values[starts]
    longer = np.diff(bounds) > 1
    if longer.any():
        plain = values.astype(np.uint64) & _KEEP
        place = np.arange(n) - starts[np.cumsum(first) - 1]
        weights = np.where(place % 2 == 0, _STEP, np.uint64(_SECOND)) + place.astype(np.uint64) // np.uint64(2)
        sums = np.add.reduceat(plain * weights, starts) & _KEEP
        kind = np.where(kinds[starts] == NUMBER, MEASURE, kinds[starts])
        tokens = np.where(longer, sums.astype(np.int64) | kind, tokens)
    return tokens, bounds


def _rolled(codes: np.ndarray, widths: Sequence[int]) -> list[np.ndarray]:
    """Hashes of all windows of each width; the widths ascend."""
    value, out = codes, []
    for width in range(1, widths[-1] + 1):
        if width > 1:
            value = value[:-1] * _STEP + codes[width - 1 :]
        if width in widths:
            mixed = (value ^ (value >> np.uint64(31))) * np.uint64(_SECOND)
            out.append(mixed ^ (mixed >> np.uint64(29)))
    return out


#: Slots, first words of the tokens, and windows of one way to read a text.
View = tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]


def windows(
    text: str, codes_of: WordTable, widths: Sequence[int] | None = None, width: int = WINDOW
) -> list[View]:
    """A text read as canonical tokens and as case-folded words: the slot values of its tokens (0
    for plain words), the first word of each token, and (width, hashes) of its windows of each of the
    ascending ``widths``.

    Without ``widths``, a text has windows of ``width``, or is one window of its own length if it
    is shorter.
    """
    words = text.split()
    values = np.fromiter(map(codes_of.__getitem__, words), np.int64, len(words))
    if not len(values):
        return []
    tokens, bounds = folded(values)
    kinds = tokens & 7
    slots = np.where(kinds == 0, 0, tokens)
    codes = np.where(kinds == 0, tokens, _TEMPLATE[kinds]).astype(np.uint64)
    cased = (values & ~7).astype(np.uint64) ^ np.uint64(_SECOND)
    # The case-folded reading takes single measures apart, too, as far as words go.
    return [
        (slots, bounds, _typed(codes, slots, _fitting(widths, width, len(tokens)))),
        (np.zeros(len(values), np.int64), np.arange(len(values) + 1),
         _plain(cased, _fitting(widths, width, len(values)))),
    ]


def _fitting(widths: Sequence[int] | None, width: int, n: int) -> list[int]:
    return [w for w in ([min(width, n)] if widths is None else widths) if w <= n]


def _plain(codes: np.ndarray, widths: list[int]) -> list[tuple[int, np.ndarray]]:
    return list(zip(widths, _rolled(codes, widths), strict=True)) if widths else []


def _typed(
    codes: np.ndarray, slots: np.ndarray, widths: list[int]
) -> list[tuple[int, np.ndarray]]:
    plain = np.concatenate([[0], np.cumsum(slots == 0)])
    out, valued = [], None
    for i, (size, hashes) in enumerate(_plain(codes, widths)):
        poor = plain[size:] - plain[:-size] < LEAST_PLAIN
        if poor.any():  # placeholders alone say nothing: such windows keep their values
            if valued is None:
                valued = _rolled(codes ^ (slots.astype(np.uint64) * _STEP), widths)
            hashes = np.where(poor, valued[i] ^ _STEP, hashes)
        out.append((size, hashes))
    return out


def _window_rows(
    df: DataFrame, id_col: str, allowed, width: int, widths: Sequence[int] | None = None
) -> DataFrame:
    """Windows with their slots and the words before, between and behind their tokens, those alone
    that pass the filter ``allowed`` (a broadcast)."""

    def run(batches):
        fields = pa.schema(arrow_fields(WINDOWS))
        codes_of = word_codes()
        bits = None if allowed is None else np.frombuffer(allowed.value, np.uint8)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for number, key, text in zip(
                batch.column("_id").to_pylist(), batch.column("_key").to_pylist(),
                texts_of(batch, "_text"), strict=True,
            ):
                for reading, (slots, bounds, found) in enumerate(
                    windows(text, codes_of, widths, width)
                ):
                    for size, hashes in found:
                        if bits is None:
                            at = np.arange(len(hashes))
                        else:
                            low = hashes & np.uint64((1 << FILTER_BITS) - 1)
                            at = np.flatnonzero(
                                bits[low >> np.uint64(3)] >> (low & np.uint64(7)) & 1)
                        if not len(at):
                            continue
                        out[0] += [number] * len(at)
                        out[1] += [key] * len(at)
                        out[2] += [reading] * len(at)
                        out[3] += at.tolist()
                        out[4] += hashes[at].view(np.int64).tolist()
                        out[5] += slots[at[:, None] + np.arange(size)].tolist()
                        out[6] += bounds[at[:, None] + np.arange(size + 1)].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, fields, strict=True)], schema=fields
            )

    small_batches(df.sparkSession)
    return df.select(
        df[id_col].cast("long").alias("_id"), df["text"].alias("_text"),
        text_key(df["text"]).alias("_key"),
    ).mapInArrow(run, WINDOWS)


def _filter_bytes(items: DataFrame) -> bytes:
    """A bit for each value that the low ``FILTER_BITS`` of an item's window take.

    At most 2**(FILTER_BITS - 3) bytes reach the driver, however large the benchmark is. If it
    fills, the filter lets more through, and the join alone decides.
    """
    low = F.col("hash").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (
        items.select(low.alias("low"))
        .selectExpr("int(low >> 3) AS at", "1 << int(low & 7) AS bit")
        .groupBy("at").agg(F.bit_or("bit").alias("bits"))
    )
    table = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in words.toLocalIterator():
        table[row["at"]] = row["bits"]
    return table.tobytes()


def longest_agreeing(rows: list[dict], width: int) -> tuple[int, int]:
    """(words of the item, first word in the document) of the longest agreeing run of windows.

    ``rows`` are windows at one offset, by position, with the slots and words of item and document.
    A run agrees if its values pair off one to one. The start moves on behind the clashing value, so
    a stray match at an end cannot spoil a passage. In an agreeing run a value has one partner, so
    each step needs the last place of two values only.
    """
    best = (0, 0)
    last = None
    start = 0  # first token of the agreeing run
    partner: dict[int, tuple[int, int]] = {}  # value of the item: of the document, last place
    owner: dict[int, tuple[int, int]] = {}  # value of the document: of the item, last place
    begins: dict[int, tuple[int, int]] = {}  # token: first words in item and document
    for row in rows:
        size = len(row["slots"])
        fresh = range(size)
        if last is not None and row["position"] == last + 1:
            fresh = fresh[-1:]
        else:
            start = row["position"]
            partner, owner, begins = {}, {}, {}
        for k in fresh:
            place, theirs, ours = row["position"] + k, row["theirs"][k], row["slots"][k]
            begins[place] = row["their_words"][k], row["words"][k]
            if theirs:
                for values, own, other in ((partner, theirs, ours), (owner, ours, theirs)):
                    known = values.get(own)
                    if known is not None and known[1] >= start and known[0] != other:
                        start = known[1] + 1
                partner[theirs], owner[ours] = (ours, place), (theirs, place)
            if place - start + 1 >= min(width, size):
                words = row["their_words"][k + 1] - begins[start][0]
                if words > best[0]:
                    best = (words, begins[start][1])
        last = row["position"]
    return best


def _finds(
    docs: DataFrame, benchmark: DataFrame, window: int, least_tokens: int
) -> DataFrame:
    """Agreeing runs by document text and item."""
    spark = docs.sparkSession
    items = held(_window_rows(benchmark, "item_id", None, window).distinct())
    allowed = spark.sparkContext.broadcast(_filter_bytes(items.df))
    ends = items.df.groupBy("doc_id", "text_key").agg(
        F.max(F.element_at("words", -1)).alias("item_tokens")
    )
    # An item shorter than a window is sought at its own length: at most window - 1 more widths.
    widths = sorted(
        row["width"] for row in items.df.select(F.size("slots").alias("width")).distinct().collect()
    )
    theirs = items.df.join(ends, ["doc_id", "text_key"])
    theirs = theirs.select(
        "reading", F.col("doc_id").alias("item_id"), F.col("text_key").alias("item_text"),
        F.col("position").alias("at"), "hash", F.col("slots").alias("theirs"),
        F.col("words").alias("their_words"), "item_tokens",
    )
    fits = items.rows * (window * 16 + 96) <= 32 << 20  # every row is this long at most
    joined = _window_rows(docs, "doc_id", allowed, window, widths).join(
        F.broadcast(theirs) if fits else theirs.hint("merge"), ["hash", "reading"]
    ).filter(F.size("slots") == F.size("theirs"))
    joined = joined.withColumn("offset", F.col("position") - F.col("at"))
    keys = ["doc_id", "text_key", "item_id", "item_text", "reading", "offset"]

    def work(rows: list[dict]):
        first: dict[int, dict] = {}
        for row in rows:
            first.setdefault(row["position"], row)  # repeated rows of the same text
        best = longest_agreeing([first[p] for p in sorted(first)], window)
        row = rows[0]
        if best[0] >= min(least_tokens, row["item_tokens"]):
            yield {
                "doc_id": row["doc_id"], "text_key": row["text_key"], "item_id": row["item_id"],
                "matched_tokens": best[0], "item_tokens": row["item_tokens"], "position": best[1],
            }

    return by_group(joined, keys, work, MATCHES)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    least_tokens: int = LEAST_TOKENS,
) -> DataFrame:
    """Documents with benchmark passages: (doc_id, item_id, matched_tokens, item_tokens, position).

    One row per document and item whose longest agreeing run covers ``least_tokens`` words of the
    item, or the whole item if that is shorter; ``position`` is the run's first word in the document.
    Missing and empty texts match nothing; rows with the same id count once, with their best run, and
    so do all rows without an id (:func:`decontaminate` judges each row by its own text); items with
    the same text each get their row. Only ids and texts are read. The items' windows are broadcast
    if their measured size allows it, and else joined by a shuffle.
    """
    found = _finds(docs, benchmark, window, least_tokens)
    best = F.max_by(
        F.struct("matched_tokens", "item_tokens", "position"),
        F.struct("matched_tokens", -F.col("position")),
    )
    return found.groupBy("doc_id", "item_id").agg(best.alias("_b")).select(
        "doc_id", "item_id", "_b.*"
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    least_tokens: int = LEAST_TOKENS,
) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark passage, whatever their id."""
    hits = held(
        _finds(docs, benchmark, window, least_tokens).select(F.col("text_key").alias("__hit_key")).distinct()
    )
    return docs.join(hits.prepared(), text_key(docs["text"]) == F.col("__hit_key"), "left_anti")
