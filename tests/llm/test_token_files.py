from __future__ import annotations

import random
import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cotag.llm import token_files, wavelet
from cotag.llm.queries import QUERIES, WORDS


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=80), st.integers(0, 80), st.integers(0, 80))
def test_file_by_hand(ids, start, stop):
    file = wavelet.WaveletFile.of(wavelet.build(np.array(ids, np.uint32), [1], [len(ids)], part=3))
    assert file.header["part"] == 3 and file.all().tolist() == ids == [
        file.token(i) for i in range(len(ids))
    ]
    for token in range(12):
        places = [i for i, x in enumerate(ids) if x == token]
        assert list(file.places(token)) == places and file.count(token) == len(places)
        inside = [i for i in places if start <= i < stop]
        assert list(file.places(token, start, stop)) == inside
        assert file.count(token, start, stop) == len(inside)


def test_file_of_many_pieces():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.002, 200_000), 49_407).astype(np.uint32)
    ids[70_000:140_000] = 5
    content = wavelet.build(ids, [None, 4], [7, len(ids)])
    assert len(content) < 2 * len(ids)
    reads = []

    def read(at, size):
        reads.append(size)
        return content[at : at + size]

    file = wavelet.WaveletFile(read)
    assert np.array_equal(file.all(), ids)
    assert file.documents()[0] == [None, 4] and file.documents()[1].tolist() == [7, len(ids)]
    del reads[:]
    for i in rng.integers(0, len(ids), 40).tolist():
        assert file.token(i) == ids[i]
    assert max(reads) < 20_000  # single pieces, never a plane
    for token in (1, 5, 900, 49_407, 60_000):
        assert list(file.places(token)) == np.nonzero(ids == token)[0].tolist()
        assert file.count(token, 1000, 150_000) == int((ids[1000:150_000] == token).sum())
    with pytest.raises(IndexError):
        file.token(len(ids))
    with pytest.raises(ValueError):
        wavelet.WaveletFile.of(b"something else than such a file")


def test_words_equal_the_library():
    own, library = token_files.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    rng = random.Random(1)
    letters = [*"aAbéÉØøÿß'stvdlmre<|>!?.,-_01½²", *"́̀ \t\n\r\x0b\x0c\x1c\x85\xa0 ​",
               *"日本😀ςΣİµªº×÷　 가 ", "<|endoftext|>", "<|startoftext|>", "'ll", "naïve", "Übung"]
    for _ in range(5000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 14)))
        want = library.encode(text, add_special_tokens=False).ids
        assert array("I", own.encode(text)).tolist() == want, text


def test_query_equals_library(spark, sf_dir):
    library = Tokenizer.from_file(WORDS)
    got = QUERIES["op13_token_files"](spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(map(tuple, got.collect()))
    want, start = [], 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        want.append((d["doc_id"], start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    assert rows == want


def test_messy(spark, messy, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_tokens(messy, folder, WORDS, shard_tokens=10)
    library = Tokenizer.from_file(WORDS)
    texts = sorted(((r["doc_id"] is not None, r["doc_id"], r["text"] or "") for r in messy.collect()),
                   key=lambda r: (r[0], r[1] or 0))
    rows = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [i for _, i, _ in texts]
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    ids = {}
    for r in rows:
        ids.setdefault(r["doc_id"], []).append(array("I", bytes(r["ids"])).tolist())
    for doc_id, own in ids.items():
        mine = [t for _, i, t in texts if i == doc_id]
        assert sorted(own) == sorted([*library.encode(t, add_special_tokens=False).ids, 1] for t in mine)
    assert manifest.count() > 3
    assert manifest.agg({"tokens": "sum"}).first()[0] == sum(r["n_tokens"] for r in rows)
    token = ids[5][0][3]
    want = sorted((r["start"], i) for r in rows
                  for i, x in enumerate(array("I", bytes(r["ids"]))) if x == token)
    hits = token_files.find_token(spark, folder, token).collect()
    assert sorted((h["start"], h["place"]) for h in hits) == want and want
    counts = {r["token"]: r["occurrences"]
              for r in token_files.count_tokens(spark, folder, [token, 1, 49_000]).collect()}
    assert counts == {token: len(want), 1: len(rows), 49_000: 0}


def test_many_texts_at_once():
    """As the library has them, and a run that comes many times is looked up once for all texts."""
    encoder = token_files.WordEncoder(WORDS)
    library = Tokenizer.from_file(WORDS)
    texts = ["the the, THE (the) ...the", "", " \t\r\n ", "the 12 the\nthe, the", "à la Élan, ñandú\n\nthe",
             "日本 the\u2003the", "x" * 300, "a\x0bb", "the" * 50 + " end"] * 3
    want = [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    for together in (1, 40, 10_000):
        assert list(encoder.encode_all(texts, together)) == want
    assert list(encoder.encode_all([])) == [] and list(encoder.encode_all([""])) == [b""]

    class Counted(dict):
        def __getitem__(self, run):
            asked.append(run)
            return encoder._run(run)

    asked = []
    encoder._runs = Counted()
    list(encoder.encode_all(["the end, the end, " * 20] * 10))
    assert sorted(asked) == [",", "end", "the"]


def test_empty_table(spark, messy, tmp_path):
    folder = f"{tmp_path}/none"
    assert token_files.write_tokens(messy.limit(0), folder, WORDS).count() == 0
    assert token_files.read_tokens(spark, folder).count() == 0
