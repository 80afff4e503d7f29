"""Token ids of documents in wavelet-matrix files, written and read by Spark tasks."""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cotag.llm import wavelet
from cotag.llm.common import (
    arrow_fields, file_system, small_batches, text_key, texts_of,
)

#: Tokens after which a file is closed; a file holds whole documents.
SHARD_TOKENS = 1 << 20
#: Fixed value: the id that ends each document.
END_ID = 1
SUFFIX = ".wvt"
#: Characters of texts that are cut into runs together.
TOGETHER = 1 << 22

_MANIFEST = "part long, number long, before long, tokens long, docs long, file string"
_DOCS = "part long, doc_id long, inside long, n_tokens long, ids_crc32 long, ids binary"
_HITS = "part long, doc_id long, inside long, place long"

# Letters and signs that need no normalisation beyond lower case, and of which the vocabulary file's
# pattern makes runs of letters and runs of signs; "<" may begin a special token, so it isn't one.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = "!-&(-/:;=-@\\[-`{-~"
_PLAIN = re.compile(f"[{_LETTERS}{_SIGNS} \t\r]*")
_PLAIN_LINES = re.compile(f"[{_LETTERS}{_SIGNS} \t\r\n]*")
_RUNS = re.compile(f"[{_LETTERS}]+|[{_SIGNS}]+")


class RecentTable(dict):
    """What ``value`` gives for a key, kept for the keys used lately.

    When ``size`` new keys have come, those used before and not since are forgotten; at most twice
    as many are held.
    """

    def __init__(self, value: Callable, size: int, longest: int = 64):
        super().__init__()
        self._value, self._size, self._longest = value, size, longest
        self._before: dict = {}

    def __missing__(self, key):
        found = self._before.get(key)
        if found is None:
            found = self._value(key)
            if len(key) > self._longest:
                return found
        if len(self) >= self._size:
            self._before = dict(self)
            self.clear()
        self[key] = found
        return found


class WordEncoder:
    """Ids of whole texts as the tokenizers library gives them, word by word.

    The vocabulary drops white space, and none of its pieces, patterns or normalisations reaches
    across it, so the ids of a text are those of its lines and words. A plain line falls into runs
    of letters and of signs, which go straight to the library's merge model; the words of other
    lines go through the whole encoder. Runs and words seen lately are kept as bytes of 32-bit ids;
    of plain lines of many texts, each distinct run is looked up once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self._spelled = {ord(c): spell.pre_tokenize_str(c)[0][0] for c in letters}
        self._runs = RecentTable(self._run, size=200_000)
        self._words = RecentTable(self._word, size=30_000)

    def _run(self, run: str) -> bytes:
        spelled = run if run.isascii() else run.translate(self._spelled)
        return array("I", [t.id for t in self._model.tokenize(spelled)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if _PLAIN.fullmatch(text):
            return b"".join(map(self._runs.__getitem__, _RUNS.findall(text.lower())))
        return array("I", self._whole.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as 32-bit integers."""
        found: list[bytes] = []
        for line in text.split("\n"):
            if _PLAIN.fullmatch(line):
                found += map(self._runs.__getitem__, _RUNS.findall(line.lower()))
            else:
                found += map(self._words.__getitem__, line.encode("utf-8").split())
        return b"".join(found)

    def encode_all(self, texts: Iterable[str], together: int = TOGETHER) -> Iterator[bytes]:
        """:meth:`encode` of each text in order, for about ``together`` characters at a time."""
        group: list[str] = []
        size = 0
        for text in texts:
            if group and size + len(text) > together:
                yield from self._encode_group(group)
                group, size = [], 0
            if len(text) > together:
                yield self.encode(text)
            else:
                group.append(text)
                size += len(text)
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        plain: list[str] = []
        parts: list[list[bytes | None]] = []  # None stands for the next one of ``plain``
        for text in texts:
            whole = _PLAIN_LINES.fullmatch(text)
            parts.append([])
            for piece in [text] if whole else text.split("\n"):
                if whole or _PLAIN.fullmatch(piece):
                    plain.append(piece.lower())
                    parts[-1].append(None)
                else:
                    words = piece.encode("utf-8").split()
                    parts[-1].append(b"".join(map(self._words.__getitem__, words)))
        found = iter(self._encode_plain(plain))
        for own in parts:
            yield b"".join([next(found) if x is None else x for x in own])

    def _encode_plain(self, pieces: list[str]) -> list[bytes]:
        """Ids of lower-case plain pieces: white space and the ends of runs of signs cut their runs."""
        spaced = pc.replace_substring_regex(pa.array(pieces, pa.string()), f"([{_SIGNS}]+)", r" \1 ")
        cut = pc.ascii_split_whitespace(spaced)
        runs = cut.values.dictionary_encode()
        distinct = runs.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [self._runs[run] if run else b"" for run in distinct]
        ids = np.frombuffer(b"".join(found), np.uint32)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        codes = runs.indices.to_numpy(zero_copy_only=False)
        sizes = size[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        first = (np.cumsum(size) - size)[codes] - ends[:-1]
        placed = ids[np.repeat(first, sizes) + np.arange(ends[-1])].tobytes()
        bounds = (4 * ends[cut.offsets.to_numpy()]).tolist()
        return [placed[a:b] for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a Python worker, kept from task to task: its tables are of bounded size, and
    filling them anew is most of a short task."""
    return WordEncoder(path)


def _store(files: fs.FileSystem, folder: str, name: str, content: bytes) -> None:
    """Write aside, then rename: a file under its own name is whole, also if a task is repeated."""
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(aside) as stream:
        stream.write(content)
    files.move(aside, f"{folder}/{name}")


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode every whole text, end it with ``end_id``, and write the ids by ascending ``doc_id``.

    Rows are range sorted by id, those without one first, those that share one by text key; a
    missing text is empty; one document per input row; other columns are not read. Each task writes
    its files one after the other into ``folder``, which all executors reach, and holds one of them
    at a time; a file has ``shard_tokens`` ids or a few more (its last document is whole). A
    repeated task writes the same files again. Gives the manifest, one row per file, which is also
    stored. A row place is part of the sort key, so that a part of all rows that share an id and a
    text is split too.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("_place"),
    ).withColumn("_k", text_key())
    keys = ("doc_id", "_k", "_place")
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "doc_id", "text", F.spark_partition_id().cast("long").alias("_part")
    )
    end = array("I", [end_id]).tobytes()
    fields = pa.schema(arrow_fields(_MANIFEST))

    def work(batches: Iterator[pa.RecordBatch]):
        files, path = file_system(folder)
        encoder = word_encoder(tokenizer)
        written: list[tuple] = []
        ids: list[bytes] = []
        doc_ids: list[int | None] = []
        ends: list[int] = []
        size = before = 0
        part = None

        def close():
            nonlocal ids, doc_ids, ends, size, before
            name = f"{part:06d}-{len(written):06d}{SUFFIX}"
            content = wavelet.build(np.frombuffer(b"".join(ids), np.uint32), doc_ids, ends,
                                    part=part, before=before)
            _store(files, path, name, content)
            written.append((part, len(written), before, size, len(doc_ids), name))
            before += size
            ids, doc_ids, ends, size = [], [], [], 0

        for batch in batches:
            part = batch.column("_part")[0].as_py() if batch.num_rows else part
            for doc_id, own in zip(batch.column("doc_id").to_pylist(),
                                   encoder.encode_all(texts_of(batch)), strict=True):
                own += end
                ids.append(own)
                size += len(own) // 4
                doc_ids.append(doc_id)
                ends.append(size)
                if size >= shard_tokens:
                    close()
        if doc_ids:
            close()
        if written:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*written), fields)], schema=fields)

    files, path = file_system(folder)
    files.create_dir(path, recursive=True)
    dealt.mapInArrow(work, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _starts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens before each part: a running sum over one row per part of the range sort."""
    parts = spark.read.parquet(f"{folder}/manifest").groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        F.col("part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")
    )


def _placed(rows: DataFrame, folder: str) -> DataFrame:
    """``start`` of each document over all files; parts are as many as the sort had at most."""
    starts = F.broadcast(_starts(rows.sparkSession, folder))
    return rows.join(starts, "part").withColumn("start", F.col("_start") + F.col("inside"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder)
        .select("content")
    )


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start`` (ids before it), ``n_tokens``, the CRC-32 of
    the ids as 32-bit integers and, if wanted, those bytes as ``ids``."""
    fields = pa.schema(arrow_fields(_DOCS))

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for content in batch.column("content"):
                file = wavelet.WaveletFile.of(content.as_py())
                part, before = file.header["part"], file.header["before"]
                data = memoryview(file.all().astype("<u4").tobytes())
                doc_ids, ends = file.documents()
                rows, start = [], 0
                for doc_id, end in zip(doc_ids, ends.tolist(), strict=True):
                    own = data[4 * start : 4 * end]
                    rows.append((part, doc_id, before + start, end - start, zlib.crc32(own),
                                 bytes(own) if with_ids else None))
                    start = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    found = _placed(_files(spark, folder).mapInArrow(work, _DOCS), folder)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def find_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """Where ``token`` occurs: ``doc_id``, ``start`` of the document, ``place`` in it. Each file is
    searched by rank and select; its ids are not decoded."""
    fields = pa.schema(arrow_fields(_HITS))

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for content in batch.column("content"):
                file = wavelet.WaveletFile.of(content.as_py())
                places = np.fromiter(file.places(token), np.int64)
                doc_ids, ends = file.documents()
                at = np.searchsorted(ends, places, side="right")
                starts = np.concatenate([[0], ends[:-1]])[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(places), file.header["part"])),
                    pa.array([doc_ids[i] for i in at.tolist()], pa.int64()),
                    pa.array(starts + file.header["before"]), pa.array(places - starts),
                ], schema=fields)

    found = _placed(_files(spark, folder).mapInArrow(work, _HITS), folder)
    return found.select("doc_id", "start", "place")


def count_tokens(spark: SparkSession, folder: str, tokens: list[int]) -> DataFrame:
    """How often each of ``tokens`` occurs in all files, one row per token of the list."""
    fields = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for content in batch.column("content"):
                file = wavelet.WaveletFile.of(content.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens, pa.int64()), pa.array(map(file.count, tokens), pa.int64())],
                    schema=fields)

    counts = _files(spark, folder).mapInArrow(work, "token long, n long")
    asked = spark.createDataFrame([(t, 0) for t in tokens], "token long, n long")
    return counts.unionByName(asked).groupBy("token").agg(F.sum("n").alias("occurrences"))
