from __future__ import annotations

import math
import re
from collections import Counter

from conftest import plain
from pyspark.sql import functions as F

from cotag.llm import quality
from cotag.llm.queries import QUERIES


def bins_by_hand(text: str | None) -> dict[str, int]:
    raw = (text or "").encode()
    words = raw.split()
    at = lambda v, edges: sum(e <= v for e in edges)
    out = {
        f: at(1000 * sum(chr(b) in chars for b in raw) // max(len(raw), 1), quality.EDGES)
        for f, chars in quality.CLASSES.items()
    }
    runs = sum(len(m[0]) > 1 for m in re.finditer(rb"([#$%&*!?@^~=+<>|])\1*", raw))
    out["runs"] = at(1000 * runs // max(len(raw), 1), quality.EDGES)
    n = max(len(words), 1)
    out["distinct"] = at(1000 * len({*words}) // n, quality.WORD_EDGES)
    out["repeats"] = at(
        1000 * sum(a == b for a, b in zip(words, words[1:], strict=False)) // n, quality.REPEAT_EDGES
    )
    return out


def test_features_by_hand(messy, spark):
    odd = messy.limit(1).withColumns({"doc_id": F.lit(50), "text": F.lit("##!! a!!! &&& $x ** 1%% |||||?!?")})
    messy = messy.unionByName(odd)
    rows = quality.featured(messy, F.col("source"), F.lit(None)).collect()
    texts = [(r["doc_id"], r["text"]) for r in messy.collect()]
    want = Counter((i, *bins_by_hand(t).values()) for i, t in texts)
    assert Counter((r["doc_id"], *(r[f] for f in quality.FEATURES)) for r in rows) == want
    assert {r["path"] for r in rows} == {""}


def test_weights_by_hand(spark, sf_dir):
    rows = quality.featured(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), F.col("source"), F.col("lang")
    ).join(quality.outcomes(spark.read.parquet(f"{sf_dir}/labels.parquet")), "doc_id")
    got = quality.fit_weights(rows)
    rows = rows.collect()
    good = sum(r["good"] for r in rows)
    for f in quality.FEATURES:
        for b in range(quality.BINS):
            inside = [r["good"] for r in rows if r[f] == b]
            if inside:
                p = (sum(inside) + 0.5) / (good + 0.5 * quality.BINS)
                q = (len(inside) - sum(inside) + 0.5) / (len(rows) - good + 0.5 * quality.BINS)
                assert abs(got[f][b] - 500_000 * math.log(p / q)) <= 1
            else:
                assert got[f][b] == 0


def test_held_out_accuracy(spark):
    """Fitted on the labels of one half, judged on those of the other."""
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    judged = quality.score_quality(docs, labels.filter(half == 0)).join(
        labels.filter(half == 1), "doc_id"
    )
    counts = {(r["quality"], r["keep"]): r["count"] for r in judged.groupBy("quality", "keep").count().collect()}
    good, bad = counts.get((1, True), 0), counts.get((0, False), 0)
    assert good / (good + counts.get((1, False), 0)) > 0.995
    assert bad / (bad + counts.get((0, True), 0)) > 0.95


def test_sparse_sites_shrink(make_docs, spark):
    docs = make_docs([(i, f"text number {i} of many") for i in range(402)])
    site = F.when(F.col("doc_id") < 400, F.col("doc_id") % 8).otherwise(F.col("doc_id"))
    labels = spark.createDataFrame(
        [(i, int(i // 8 % 10 != 0)) for i in range(400)] + [(400, 0), (401, 1)],
        "doc_id long, quality int",
    )
    judged = quality.score_quality(docs, labels, host=site).collect()
    got = {r["host"]: r["site_log_odds"] for r in judged}
    assert got["400"] < got["401"] and got["400"] < min(got[str(h)] for h in range(8))
    assert max(abs(got["400"] - got["0"]), abs(got["401"] - got["0"])) < 1_000_000


def test_query_keeps_all_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op1_quality_classifier"](spark, sf_dir)
    assert plain(got, "doc_id") == plain(docs, "doc_id")


def test_messy(messy, spark):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (5, 1), (7, 1), (8, 1), (9, 1), (None, 1), (2, None), (99, 0)],
        "doc_id long, quality int",
    )
    got = quality.score_quality(messy, labels)
    assert plain(got, "doc_id") == plain(messy, "doc_id")
    kept = quality.keep_good(messy, labels)
    assert kept.columns == messy.columns
    gone = {r["doc_id"] for r in got.filter("not keep and doc_id is not null").collect()}
    assert plain(kept, "doc_id") == [i for i in plain(messy, "doc_id") if i[0] not in gone]
    assert kept.filter("doc_id is null").count() == 2
    assert quality.score_quality(messy, labels.limit(0)).filter("not keep").count() == 0
    assert quality.score_quality(messy.limit(0), labels).count() == 0
