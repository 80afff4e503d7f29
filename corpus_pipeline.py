"""A corpus pipeline of five stages over ``documents``.

Each stage takes all that the one before it kept. A stage's result is written as Parquet in the
shared folder and read again, so a lost executor costs at most one stage's work; when the next one
is written too, it is removed. The last result stays: the kept documents with their token ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cotag.llm import decontamination, jaccard, pieces, quality, secrets
from cotag.llm.common import remove_folder, table
from cotag.llm.queries import MODEL
from cotag.session import shared_dir


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return jaccard.keep_one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become a placeholder."""
    return secrets.redact_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text beside the document's columns."""
    carried = [c for c in docs.columns if c != "doc_id"]
    return pieces.encode_documents(docs, pieces.read_model(MODEL), carried=carried)


STAGES = [
    ("quality", judge_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact),
    ("encoding", encode),
]

#: Feature fitting, component search, and exact merge encoding are beyond one SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_folder(before)
        before = path
    return docs
