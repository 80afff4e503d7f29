"""Quality by hierarchical empirical Bayes.

A document's own evidence is the log-likelihood ratio of binned style features, learnt from all
labelled documents. Its site adds a prior: the share of good documents of its path is shrunk
towards that of its host, and that towards the share of all, each prior being worth as many
documents as the spread between sites says. Both are added as log odds. All weights are whole
micro-nats, so results do not depend on the order of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotag.functions.joins import held
from cotag.llm.common import arrow_fields, release_kept, small_batches, text_key, texts_of
from cotag.llm.reputation import prior_strength
from cotag.session import ensure_checkpoints

# Characters that a feature counts, as ASCII bytes.
CLASSES = {
    "symbols": "#$%&*@^~=+<>{}[]\\_`",
    "bars": "|",
    "marks": "!?",
    "stops": ".,;:",
    "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": "0123456789",
    "spaces": " \t\n\r\x0b\x0c",
}
#: Characters whose runs (the same one twice or more in a row) are counted.
RUNS = "#$%&*!?@^~=+<>|"
#: Lower edges of the bins of a count per thousand bytes.
EDGES = (1, 2, 5, 10, 20, 40, 80, 160, 320, 640)
#: Lower edges of the bins of distinct words, and of words like the one before, per thousand words.
WORD_EDGES = (50, 100, 200, 300, 400, 500, 600, 700, 800, 900)
REPEAT_EDGES = (1, 5, 10, 20, 50, 100, 200, 400, 600, 800)
FEATURES = (*CLASSES, "runs", "distinct", "repeats")
BINS = len(EDGES) + 1
#: Documents with a posterior log odds below this (in micro-nats) are rejected.
LEAST_LOG_ODDS = 0

_FEATURED = "key string, doc_id long, host string, path string, " + ", ".join(f"{f} long" for f in FEATURES)


def _binned(values: np.ndarray, edges: tuple[int, ...]) -> np.ndarray:
    return np.searchsorted(np.array(edges), values, side="right")


def _run_count(raw: np.ndarray, chars: np.ndarray) -> int:
    """Runs of two or more of the same of ``chars``."""
    same = (raw[1:] == raw[:-1]) & chars[raw[1:]]
    return int(same.sum()) - int((same[1:] & same[:-1]).sum())


def featured(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """Bins of the style features of whole texts: (key, doc_id, host, path, a bin per feature).

    Character classes are counted in the UTF-8 bytes of a whole batch at once; words are the parts
    between ASCII white space. A missing or empty text has bin 0 throughout.
    """
    names, types = zip(*arrow_fields(_FEATURED), strict=True)

    def run(batches):
        release_kept()
        tables = {}
        for name, chars in CLASSES.items():
            tables[name] = np.zeros(256, np.int64)
            tables[name][list(chars.encode())] = 1
        in_runs = np.zeros(256, bool)
        in_runs[list(RUNS.encode())] = True
        for batch in batches:
            raw = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch)]
            sizes = np.array([len(r) for r in raw], np.int64)
            columns = {}
            codes = [np.frombuffer(r, np.uint8) for r in raw]
            counts = np.array(
                [np.bincount(c, minlength=256) for c in codes], np.int64
            ).reshape(len(raw), 256)
            for name, chosen in tables.items():
                columns[name] = _binned(1000 * (counts @ chosen) // np.maximum(sizes, 1), EDGES)
            runs = np.array([_run_count(c, in_runs) for c in codes], np.int64)
            columns["runs"] = _binned(1000 * runs // np.maximum(sizes, 1), EDGES)
            words = [r.split() for r in raw]
            total = np.maximum(np.array([len(w) for w in words], np.int64), 1)
            distinct = np.array([len(set(w)) for w in words], np.int64)
            columns["distinct"] = _binned(1000 * distinct // total, WORD_EDGES)
            repeats = np.array(
                [sum(map(bytes.__eq__, w, w[1:])) if d < len(w) else 0
                 for w, d in zip(words, distinct.tolist(), strict=True)], np.int64,
            )
            columns["repeats"] = _binned(1000 * repeats // total, REPEAT_EDGES)
            arrays = [batch.column(n) for n in ("key", "doc_id", "host", "path")]
            arrays += [pa.array(columns[f], pa.int64()) for f in FEATURES]
            yield pa.RecordBatch.from_arrays(
                [a.cast(t) for a, t in zip(arrays, types, strict=True)], names=list(names)
            )

    small_batches(docs.sparkSession)
    chosen = docs.select(
        text_key(F.col("text")).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return chosen.mapInArrow(run, _FEATURED)


def _micro(x: Column) -> Column:
    return F.round(x * 1_000_000).cast("long")


def outcomes(labels: DataFrame) -> DataFrame:
    """One outcome per labelled document: (doc_id, good), 0 if any of its labels says bad."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("_q"))
        .filter(F.col("doc_id").isNotNull() & F.col("_q").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.when(F.col("_q") > 0, 1).otherwise(0)).cast("long").alias("good"))
    )


def fit_weights(labelled: DataFrame) -> dict[str, list[int]]:
    """Log-likelihood ratios (micro-nats) of each feature's bins, from all labelled rows.

    Counts are made by grouping, with half a row added to each bin; the table that reaches the
    driver has one number per feature and bin. A feature's weight is divided by two, as features
    overlap.
    """
    counted = (
        labelled.select("good", F.explode(F.array(*(
            F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES
        ))).alias("_f"))
        .groupBy("_f.feature", "_f.bin")
        .agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    total = sum(r["n"] for r in counted if r["feature"] == FEATURES[0])
    good = sum(r["good"] for r in counted if r["feature"] == FEATURES[0])
    weights = {f: [0] * BINS for f in FEATURES}
    for r in counted:
        of_good = (r["good"] + 0.5) / (good + 0.5 * BINS)
        of_bad = (r["n"] - r["good"] + 0.5) / (total - good + 0.5 * BINS)
        weights[r["feature"]][r["bin"]] = round(500_000 * float(np.log(of_good / of_bad)))
    return weights


def evidence(weights: dict[str, list[int]]) -> Column:
    """Sum of a row's weights."""
    parts = [
        F.element_at(F.array(*(F.lit(w).cast("long") for w in ws)), (F.col(f) + 1).cast("int"))
        for f, ws in weights.items()
    ]
    return sum(parts[1:], parts[0])


def site_posteriors(labelled: DataFrame) -> tuple[DataFrame, float]:
    """Log odds (micro-nats) of good documents per path: (host, path, site_log_odds, ...).

    Labelled rows are summed per path first, so no later step sees more than one row per path.
    Also gives the log odds for sites without labels, that of all documents.
    """
    paths = held(
        labelled.groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    ).df
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood"))
    whole = paths.agg(
        ((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2))
        .alias("mean")
    ).first()["mean"]
    of_hosts = prior_strength(
        hosts.select(F.col("hn").alias("n"), F.col("hgood").alias("good"))
    ).first()["strength"]
    of_paths = prior_strength(paths).first()["strength"]
    host_mean = (F.col("hgood") + of_hosts * whole) / (F.col("hn") + of_hosts)
    path_mean = (F.col("good") + of_paths * F.col("host_mean")) / (F.col("n") + of_paths)
    odds = lambda p: _micro(F.log(p / (1 - p)))
    both = (
        hosts.withColumn("host_mean", host_mean).join(paths, "host")
        .select("host", "path", odds(F.col("host_mean")).alias("host_log_odds"),
                odds(path_mean).alias("site_log_odds"), F.col("n").alias("site_labels"))
    )
    return both, float(np.round(1e6 * np.log(whole / (1 - whole))))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    least_log_odds: int = LEAST_LOG_ODDS,
    keyed: bool = False,
) -> DataFrame:
    """Every row's verdict: (doc_id, host, path, evidence, site_log_odds, log_odds, keep), with
    ``keyed`` also the ``key`` of its text.

    ``host`` and ``path`` default to ``source`` and ``lang``; missing ones count as empty. Log odds
    are in micro-nats. Paths without labels take their host's log odds, hosts without labels those
    of all documents. Without any label every document is kept. A missing or empty text has the
    evidence of an empty one. Rows that share an id are judged each by its text. Only the texts'
    scan is heavy; features are one short reliable checkpoint. Site tables are broadcast
    if their measured size allows it, and else joined so that Spark may split a hot source.
    """
    ensure_checkpoints(docs.sparkSession)
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = featured(docs, host, path).checkpoint()
    labelled = rows.join(outcomes(labels), "doc_id")
    labelled = labelled.select("good", "host", "path", *FEATURES).checkpoint()
    weights = fit_weights(labelled)
    sites, base = site_posteriors(labelled)
    hosts = held(sites.groupBy("host").agg(F.max("host_log_odds").alias("host_log_odds")))
    sites = held(sites.select("host", "path", "site_log_odds"))
    own = ["key", "doc_id"] if keyed else ["doc_id"]
    judged = (
        rows.select(*own, "host", "path", evidence(weights).alias("evidence"))
        .join(sites.prepared(), ["host", "path"], "left")
        .join(hosts.prepared(), "host", "left")
    )
    site = F.coalesce("site_log_odds", "host_log_odds", F.lit(int(base)).cast("long"))
    total = F.col("evidence") + F.col("site_log_odds")
    return (
        judged.select(*own, "host", "path", "evidence", site.alias("site_log_odds"))
        .withColumn("log_odds", total)
        .withColumn("keep", F.col("log_odds") >= F.lit(least_log_odds))
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    least_log_odds: int = LEAST_LOG_ODDS,
) -> DataFrame:
    """``docs`` without the rejected rows, with an id or without: each is judged by its own text
    and site."""
    host = docs["source"] if host is None else host
    path = docs["lang"] if path is None else path
    verdicts = score_quality(docs, labels, host, path, least_log_odds, keyed=True)
    rejected = held(
        verdicts.filter(~F.col("keep"))
        .select(*(F.col(c).alias(f"__rejected_{c}") for c in ("key", "host", "path"))).distinct()
    )
    same = text_key(docs["text"]) == F.col("__rejected_key")
    for name, own in (("host", host), ("path", path)):
        same = same & (F.coalesce(own.cast("string"), F.lit("")) == F.col(f"__rejected_{name}"))
    return docs.join(rejected.prepared(), same, "left_anti")
