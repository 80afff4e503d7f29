"""A wavelet matrix of token ids in one compressed file.

Ids are stored as bit planes, highest bit first. Below each plane the ids are put in a new order:
those with a zero bit first, then those with a one, each part as it was. An id's place in the next
plane then follows from the number of ones before it (its rank), and back by the place of the k-th
one (select). So a token, the count of a token in a range and its k-th occurrence each take one
rank or select per plane, and read one piece of each plane.

File: magic, header size, header (JSON), sections. A plane is cut into pieces of ``PIECE`` bits,
each a zstd frame of its own; the ones before each piece are held in a section. Documents are kept
as ids (with a mask of missing ones) and ends. All numbers are little-endian.
"""

from __future__ import annotations

import json
import struct
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import zstandard

MAGIC = b"WVTOKEN1"
#: Bits of a plane that are compressed together.
PIECE = 1 << 16
#: Pieces that a reader keeps open.
OPEN_PIECES = 256


def _narrow(height: int) -> type[np.unsignedinteger]:
    """The smallest type that ids of so many bits fit in; half the bytes are moved at each plane."""
    return np.uint16 if height <= 16 else np.uint32


def _packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def build(ids: np.ndarray, doc_ids: list[int | None], ends: list[int], **notes: int) -> bytes:
    """The file of ``ids``; document i ends before token ``ends[i]``. ``notes`` go to the header."""
    values = np.asarray(ids, np.uint32)
    height = max(int(values.max()).bit_length(), 1) if len(values) else 1
    values = values.astype(_narrow(height))
    squeeze = zstandard.ZstdCompressor(level=3).compress
    body: list[bytes] = []
    size = 0

    def put(data: bytes) -> list[int]:
        nonlocal size
        frame = squeeze(data)
        body.append(frame)
        size += len(frame)
        return [size - len(frame), len(frame)]

    planes, zeros, ranks = [], [], []
    for level in range(height):
        ones = (values & values.dtype.type(1 << (height - 1 - level))) != 0
        pieces = [ones[i : i + PIECE] for i in range(0, len(ones), PIECE)]
        planes.append([put(_packed(piece)) for piece in pieces])
        before = np.cumsum([0, *(int(piece.sum()) for piece in pieces)])
        ranks.append(put(before.astype("<u8").tobytes()))
        zeros.append(len(ones) - int(before[-1]))
        values = np.concatenate([np.compress(~ones, values), np.compress(ones, values)])
    missing = np.array([d is None for d in doc_ids], bool)
    header = {
        **notes, "tokens": len(values), "docs": len(doc_ids), "height": height, "zeros": zeros,
        "planes": planes, "ranks": ranks,
        "doc_ids": put(np.array([d or 0 for d in doc_ids], "<i8").tobytes()),
        "missing": put(_packed(missing)), "ends": put(np.array(ends, "<u8").tobytes()),
    }
    head = squeeze(json.dumps(header).encode())
    return b"".join([MAGIC, struct.pack("<Q", len(head)), head, *body])


class WaveletFile:
    """Random access to a file of :func:`build`, by a function that reads (offset, size)."""

    def __init__(self, read: Callable[[int, int], bytes]):
        magic, size = struct.unpack("<8sQ", read(0, 16))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self._read, self._at = read, 16 + size
        self._unpack = zstandard.ZstdDecompressor().decompress
        self.header = json.loads(self._unpack(read(16, size)))
        self.height, self._zeros = self.header["height"], self.header["zeros"]
        self._ranks = [np.frombuffer(self._section(s), "<u8") for s in self.header["ranks"]]
        self._pieces: OrderedDict[tuple[int, int], np.ndarray] = OrderedDict()

    @classmethod
    def of(cls, content: bytes) -> WaveletFile:
        return cls(lambda at, size: content[at : at + size])

    def __len__(self) -> int:
        return self.header["tokens"]

    def _section(self, place: list[int]) -> bytes:
        return self._unpack(self._read(self._at + place[0], place[1]))

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids and where each one ends."""
        ids = np.frombuffer(self._section(self.header["doc_ids"]), "<i8")
        packed = np.frombuffer(self._section(self.header["missing"]), np.uint8)
        missing = np.unpackbits(packed, count=len(ids), bitorder="little").astype(bool)
        known = [None if m else i for i, m in zip(ids.tolist(), missing.tolist(), strict=True)]
        return known, np.frombuffer(self._section(self.header["ends"]), "<u8").astype(np.int64)

    def _piece(self, level: int, number: int) -> np.ndarray:
        """The 64-bit words of a piece, as many as needed."""
        key = level, number
        found = self._pieces.get(key)
        if found is None:
            data = self._section(self.header["planes"][level][number])
            found = np.frombuffer(data + bytes(-len(data) % 8), "<u8")
            self._pieces[key] = found
            if len(self._pieces) > OPEN_PIECES:
                self._pieces.popitem(last=False)
        else:
            self._pieces.move_to_end(key)
        return found

    def _bit(self, level: int, i: int) -> int:
        words = self._piece(level, i // PIECE)
        return int(words[i % PIECE // 64] >> np.uint64(i % 64)) & 1

    def rank(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        number, inside = divmod(i, PIECE)
        ones = int(self._ranks[level][number])
        if inside:
            words = self._piece(level, number)
            full = inside // 64
            ones += int(np.bitwise_count(words[:full]).sum())
            if inside % 64:
                ones += (int(words[full]) & ((1 << inside % 64) - 1)).bit_count()
        return ones

    def select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) ``bit`` of a plane."""
        before = self._ranks[level].astype(np.int64)
        if not bit:
            before = np.minimum(np.arange(len(before)) * PIECE, len(self)) - before
        number = int(np.searchsorted(before, k, side="right")) - 1
        words = self._piece(level, number)
        counts = np.bitwise_count(words if bit else ~words).astype(np.int64)
        upto = np.cumsum(counts)
        rest = k - int(before[number])
        word = int(np.searchsorted(upto, rest, side="right"))
        rest -= int(upto[word - 1]) if word else 0
        value = int(words[word]) if bit else ~int(words[word])
        for _ in range(rest):
            value &= value - 1
        low = (value & -value).bit_length() - 1
        return number * PIECE + word * 64 + low

    def token(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for level in range(self.height):
            bit, ones = self._bit(level, i), self.rank(level, i)
            value = value << 1 | bit
            i = self._zeros[level] + ones if bit else i - ones
        return value

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        if not 0 <= token < 1 << self.height:
            return 0, 0
        for level in range(self.height):
            if start >= stop:
                return 0, 0
            a, b = self.rank(level, start), self.rank(level, stop)
            if token >> (self.height - 1 - level) & 1:
                start, stop = self._zeros[level] + a, self._zeros[level] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often ``token`` occurs at places from ``start`` on before ``stop``."""
        stop = len(self) if stop is None else min(stop, len(self))
        a, b = self._range(token, max(start, 0), stop)
        return b - a

    def places(self, token: int, start: int = 0, stop: int | None = None) -> Iterator[int]:
        """The places of ``token`` from ``start`` on before ``stop``, in order."""
        stop = len(self) if stop is None else min(stop, len(self))
        for place in range(*self._range(token, max(start, 0), stop)):
            for level in range(self.height - 1, -1, -1):
                bit = token >> (self.height - 1 - level) & 1
                place = self.select(level, bit, place - self._zeros[level] if bit else place)
            yield place

    def all(self) -> np.ndarray:
        """All ids in order: the planes' partitions are undone from the last to the first."""
        n = len(self)
        kind = _narrow(self.height)
        values = np.zeros(n, kind)
        for level in range(self.height - 1, -1, -1):
            packed = b"".join(map(self._section, self.header["planes"][level]))
            bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=n, bitorder="little")
            ones = bits.view(bool)
            before = np.empty(n, kind)
            before[~ones] = values[: self._zeros[level]]
            before[ones] = values[self._zeros[level] :] | kind(1 << (self.height - 1 - level))
            values = before
        return values.astype(np.uint32)
