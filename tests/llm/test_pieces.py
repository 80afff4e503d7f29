"""Exact against the library, on documents, random strings and awkward cases."""

from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cotag.llm import decontamination, jaccard, pieces
from cotag.llm.queries import MODEL, QUERIES

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
CODEC = pieces.PieceCodec(pieces.read_model(MODEL))


def same(text: str) -> None:
    count, ids, decoded = CODEC.encode_text(text)
    want = LIBRARY.encode(text, num_threads=1)
    assert CODEC.encode(text) == want
    assert ids == ",".join(map(str, want)) and count == len(want)
    assert decoded == LIBRARY.decode(want) == CODEC.decode(want)


def test_a_worker_lets_go_of_the_codec_at_another_stage():
    model = pieces.read_model(MODEL)
    codec = pieces._codec(model)
    assert pieces._codec(model) is codec
    for table in (jaccard.word_hashes, decontamination.word_codes):
        pieces._codec(model)
        table()
        assert pieces._codec(model) is not codec
        codec = pieces._codec(model)


@pytest.mark.parametrize("text", [
    "", " ", "  ", " a b  c ", "\n\t x", "日本　語😀x", "a\x00b", "▁x", "<s> <unk> <0x41>", "é", "é",
    " " * 40 + "the", "\n" * 5 + " " * 19, "a" * 5000, "ab" * 3000, "===" * 50 + "x", "��",
])
def test_awkward(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    same(text.encode("utf-8", "ignore").decode())


def test_random_pieces():
    rng = random.Random(5)
    known = sorted(CODEC._ids)
    for _ in range(4000):
        same("".join(rng.choices(known, k=rng.randint(1, 7))).replace("▁", " "))


def test_backtracking_needs_more_than_the_longest_pieces():
    """Some texts are not encoded by the longest piece at each place."""
    rng, found = random.Random(7), 0
    for _ in range(2000):
        text = "".join(rng.choices("theinreat", k=8))
        greedy = [n for _, n in CODEC._automaton.iter_long("▁" + text)]
        found += greedy != CODEC.encode(text)
        same(text)
    assert found > 20


def test_a_rejected_model():
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(pieces.read_model(MODEL))
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.PieceCodec(proto.SerializeToString())


def test_query_equals_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op2_piece_encoding"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs:
        ids = LIBRARY.encode(d["text"] or "", num_threads=1)
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(LIBRARY.decode(ids))


def test_messy(messy):
    got = pieces.encode_documents(messy, pieces.read_model(MODEL)).collect()
    assert len(got) == messy.count()
    wanted = sorted((r["text"] or "") for r in messy.select("text").collect())
    assert sorted(r["decoded"] for r in got) == wanted
    assert all(r["n_tokens"] == 0 for r in got if r["decoded"] == "")
    empty = pieces.encode_documents(messy.limit(0), pieces.read_model(MODEL))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids", "decoded"]
