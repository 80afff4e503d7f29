"""The registered queries of this package, each over its whole table with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotag.llm import (
    conversations, decontamination, fingerprints, jaccard, licenses, pieces, quality, reputation,
    runs, secrets, sharding, token_counts, token_files,
)
from cotag.llm.common import table
from cotag.llm.oracles import ORACLES
from cotag.session import shared_dir

#: The vocabulary files; parameters of the operators, read where they are installed.
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(MODEL)
    return pieces.encode_documents(_documents(spark, sf_dir), model, digests=True)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(
        _documents(spark, sf_dir), table(spark, sf_dir, "benchmark")
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.word_pieces(pieces.read_model(MODEL))
    return token_counts.count_tokens(_documents(spark, sf_dir), vocabulary)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_documents(spark, sf_dir))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_documents(spark, sf_dir))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.periodic_runs(runs.repeat_tails(_documents(spark, sf_dir))))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(turns, F.col("present"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(_documents(spark, sf_dir), folder, WORDS)
    return token_files.read_tokens(spark, folder, with_ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_piece_encoding, op3_benchmark_decontamination,
        op4_token_counts, op5_license_scan, op6_sharding, op7_secret_scan, op8_ngram_jaccard_join,
        op9_url_filter, op10_fingerprints, op11_periodic_runs, op12_conversation_repair,
        op13_token_files,
    )
}
