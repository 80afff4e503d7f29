"""Exact merge-type (BPE) piece encoding by backtracking, and decoding.

The vocabulary file gives pieces with scores. Merging joins the adjacent pair whose joined piece
scores highest, the leftmost of equals, until none is left. The encoder here never merges whole
words. It takes the longest piece at each place, checks it against the piece before it, and goes
back to the next shorter piece where they do not fit; places from which no way on exists are kept
in a bitfield, so no place is tried twice with the same failure. Two pieces fit if merging their
joined text gives just these two again.

Characters without a piece become their UTF-8 bytes' pieces; nothing merges across them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from cotag.llm.common import WordTable, kept, small_batches, texts_of

# Fixed values of the model format: kinds of pieces, the mark for a space.
NORMAL, BYTE = 1, 6
SPACE = "▁"

NEVER = float("-inf")

ENCODED = "doc_id long, n_tokens long, ids string, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    """Encoder and decoder for one model file of the merge type with byte pieces."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        self._prefix = spec.add_dummy_prefix
        self._scores: dict[str, float] = {}
        self._ids: dict[str, int] = {}
        self._bytes: dict[int, int] = {}
        self._surface: dict[int, bytes] = {}
        for number, piece in enumerate(proto.pieces):
            if piece.type == NORMAL:
                self._scores[piece.piece] = piece.score
                self._ids[piece.piece] = number
                self._surface[number] = piece.piece.replace(SPACE, " ").encode()
            elif piece.type == BYTE:
                value = int(piece.piece[3:5], 16)
                self._bytes[value] = number
                self._surface[number] = bytes([value])
        if len(self._bytes) != 256:
            raise ValueError("the model must have a piece for every byte")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self._ids):
            raise ValueError("pieces must not hold a space after other characters")
        self._automaton = ahocorasick.Automaton()
        self._pieces = {n: p for p, n in self._ids.items()}
        alone = {p for p in self._ids if self.merged(p) == [p]}  # others never come out of merging
        for piece in alone:
            self._automaton.add_word(piece, self._ids[piece])
        self._automaton.make_automaton()
        self._size = {self._ids[p]: len(p) for p in alone}
        # The longest shorter piece that a piece begins with, -1 if none.
        self._shorter = {
            self._ids[p]: next(
                (self._ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in alone), -1
            )
            for p in alone
        }
        # No piece spans a space after other text, or a line end if that has no piece: cut there.
        cut = "" if any("\n" in p for p in self._ids) else "\n"
        more = f"|[^{SPACE}{cut}]+" + (f"|{cut}" if cut else "")
        self._units = re.compile(f"{SPACE}+[^{SPACE}{cut}]*{more}").findall
        singles = "".join(map(re.escape, (p for p in alone if len(p) == 1)))
        self._plain = re.compile(f"[{singles}]*").fullmatch
        self._runs = re.compile(f"([{singles}]*)([^{singles}]?)").findall
        self._name = {n: str(n) for n in self._surface}
        self._fits = WordTable(self._fit, 500_000)
        self._known = WordTable(self._unit, 300_000)

    def merged(self, text: str) -> list[str]:
        """``text`` merged step by step; for short texts."""
        parts = list(text)
        score = self._scores.get
        scores = [score(x + y, NEVER) for x, y in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) != NEVER:
            i = scores.index(best)  # the leftmost of equals
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], NEVER)
        return parts

    def _fit(self, pair: tuple[int, int]) -> bool:
        left, right = self._pieces[pair[0]], self._pieces[pair[1]]
        return self.merged(left + right) == [left, right]

    def _segment(self, text: str) -> list[int]:
        """Ids of a text all of whose characters have pieces."""
        fits = self._fits
        chosen = [number for _, number in self._automaton.iter_long(text)]
        pairs = list(zip(chosen, chosen[1:], strict=False))
        bad = next((i for i, pair in enumerate(pairs) if not fits[pair]), -1)
        if bad < 0:
            return chosen
        shorter, length, longest = self._shorter, self._size, self._automaton.iter_long
        size = len(text)
        failed = bytearray((size >> 3) + 1)
        piece = chosen[bad + 1]
        del chosen[bad + 1 :]
        at = sum(map(length.__getitem__, chosen))
        while True:
            while piece >= 0:
                end = at + length[piece]
                if not failed[end >> 3] >> (end & 7) & 1 and (
                    not chosen or fits[chosen[-1], piece]
                ):
                    break
                piece = shorter[piece]
            if piece >= 0:
                chosen.append(piece)
                at = end
                if at == size:
                    return chosen
                piece = next(longest(text, at))[1]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not chosen:
                    raise ValueError("no sequence of pieces fits")
                at -= length[chosen[-1]]
                piece = shorter[chosen.pop()]

    def _unit(self, unit: str) -> tuple[int, str, bytes]:
        """Number of ids, ids as text, decoded bytes of a unit that nothing merges across."""
        if self._plain(unit):
            ids = self._segment(unit)
        else:
            ids = []
            for known, other in self._runs(unit):
                ids += self._segment(known) if known else ()
                ids += [self._bytes[b] for b in other.encode("utf-8", "surrogatepass")]
        surface = b"".join([self._surface[i] for i in ids])
        return len(ids), ",".join([self._name[i] for i in ids]), surface

    def _parts(self, text: str) -> list[tuple[int, str, bytes]]:
        if not text:
            return []
        marked = text.replace(" ", SPACE)
        return list(map(self._known.__getitem__, self._units(SPACE * self._prefix + marked)))

    def encode_text(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, decoded text."""
        parts = self._parts(text)
        surface = b"".join([p[2] for p in parts])
        if self._prefix and surface[:1] == b" ":
            surface = surface[1:]
        return (
            sum([p[0] for p in parts]),
            ",".join([p[1] for p in parts]),
            surface.decode("utf-8", "replace"),
        )

    def encode(self, text: str) -> list[int]:
        ids = self.encode_text(text)[1]
        return list(map(int, ids.split(","))) if ids else []

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        surface = b"".join(map(self._surface.__getitem__, ids))
        if self._prefix and surface[:1] == b" ":
            surface = surface[1:]
        return surface.decode("utf-8", "replace")


def _codec(model: bytes) -> PieceCodec:
    return kept(PieceCodec, model)


def read_model(path: str) -> bytes:
    """A vocabulary file, read on the driver; it travels to the tasks with the plan (0.5 MB)."""
    with open(path, "rb") as file:
        return file.read()


def encode_documents(
    docs: DataFrame, model: bytes, digests: bool = False, carried: Sequence[str] = ()
) -> DataFrame:
    """Ids and decoded text of each whole text: (doc_id, n_tokens, ids, decoded), and the columns
    ``carried`` of ``docs`` behind them.

    With ``digests`` the two texts are given as SHA-256 hex (``ids_sha256``, ``decoded_sha256``).
    A missing or empty text has no ids and decodes to the empty text; one row per input row,
    repeated and missing ids included. Further columns of ``docs`` are not read. No shuffle: a task
    holds one Arrow batch and the words it met lately.
    """
    schema = DIGESTS if digests else ENCODED

    def run(batches):
        codec = _codec(model)
        for batch in batches:
            rows = [codec.encode_text(t) for t in texts_of(batch)]
            count, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            if digests:
                ids = [hashlib.sha256(x.encode()).hexdigest() for x in ids]
                decoded = [hashlib.sha256(x.encode()).hexdigest() for x in decoded]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(count, pa.int64()),
                    pa.array(ids, pa.string()),
                    pa.array(decoded, pa.string()),
                    *(batch.column(c) for c in carried),
                ],
                names=[*(part.split()[0] for part in schema.split(", ")), *carried],
            )

    small_batches(docs.sparkSession)
    chosen = docs.select(docs["doc_id"].cast("long"), *dict.fromkeys(["text", *carried]))
    fields = [chosen.schema[c] for c in carried]
    full = StructType([*StructType.fromDDL(schema).fields, *fields])
    return chosen.mapInArrow(run, full)
