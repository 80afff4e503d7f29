"""The pipeline against its stages done by hand."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import plain

import corpus_pipeline
from cotag.llm import decontamination, jaccard, pieces, quality, secrets
from cotag.llm.queries import MODEL


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Each stage's result, written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stage_columns(stages):
    for before in stages[1:-1]:
        assert before.columns == stages[0].columns


def test_decisions(spark, sf_dir, stages):
    docs, good, single, clean, safe, encoded = stages
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = plain(quality.score_quality(docs, labels).filter("not keep"), "doc_id")
    assert set(plain(good, "doc_id")) == set(plain(docs, "doc_id")) - set(rejected)
    groups = plain(jaccard.near_duplicates(good), "class_id")
    assert set(plain(single, "doc_id")) == set(groups)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = plain(decontamination.find_contamination(single, bench), "doc_id")
    assert set(plain(clean, "doc_id")) == set(plain(single, "doc_id")) - set(hits)
    items = [r["text"] for r in bench.collect()]
    assert not [r for r in clean.collect() if any(i in r["text"] for i in items)]
    texts = dict(plain(clean, "doc_id", "text"))
    for doc_id, text, n in plain(safe, "doc_id", "text", "n_chars"):
        assert text == secrets.redacted(texts[doc_id], secrets.all_spans(texts[doc_id])[1])
        assert n == len(text) and not secrets.base_spans(text)
    codec = pieces.PieceCodec(pieces.read_model(MODEL))
    got = {r["doc_id"]: r for r in encoded.collect()}
    for doc_id, text in plain(safe, "doc_id", "text"):
        n, ids, _ = codec.encode_text(text)
        assert got[doc_id]["n_tokens"] == n and got[doc_id]["ids"] == ids
        assert got[doc_id]["text"] == text
    assert set(docs.columns) < set(encoded.columns)


def test_run(spark, sf_dir, stages):
    names = stages[-1].columns
    found = corpus_pipeline.run(spark, sf_dir)
    assert plain(found, *names) == plain(stages[-1], *names)
    folder = Path(found.inputFiles()[0].removeprefix("file://")).parent.parent
    assert [p.name for p in folder.iterdir()] == [corpus_pipeline.STAGES[-1][0]]


def test_messy(messy, spark, sf_dir):
    docs = messy
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() > 0, name
    # The empty text without an id is a copy of that of row 2, the other one is a text of its own.
    assert [r["text"] for r in docs.filter("doc_id is null").collect()] == ["no id"]
    empty = messy.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0
