"""Readers and writers of raw posts, batch files, brand records and marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotag.functions.joins import held
from cotag.functions.text import strip
from cotag.schemas import BATCH, BRANDS, POSTS

# Where a brand's posts go when its record does not say.
DEFAULT_SCHEMA = "RAW_DATA"
DEFAULT_TABLE = "INSTAGRAM_POSTS"

#: How batch files are read: checked header, no line that does not fit, quotes doubled.
CSV_OPTIONS = {
    "header": True,
    "enforceSchema": False,
    "mode": "FAILFAST",
    "multiLine": True,
    "escape": '"',
}


def scan_posts(spark: SparkSession, path: str) -> DataFrame:
    """The raw table with its declared columns."""
    return spark.read.schema(POSTS).parquet(path)


def bloom_options(*columns: str) -> dict[str, str]:
    """Parquet options for Bloom filters on ``columns``, sized to what a row group holds."""
    chosen = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {"parquet.bloom.filter.adaptive.enabled": "true", **chosen}


def read_post_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Batch files with a header, with or without a byte-order mark.

    Columns are declared and checked against the header; a line that does not fit fails the
    read, and an empty field is NULL.
    """
    return spark.read.schema(BATCH).options(**CSV_OPTIONS).csv(path)


def write_post_csv(batch: DataFrame, path: str, brand_key: Column, day: Column) -> None:
    """One folder per brand and day under ``path``; a re-run replaces just its own folders.

    The rows of a folder are brought together first, so that it gets one file, or a few if large.
    """
    (
        batch.withColumns({"brand_key": brand_key, "dt": day})
        .hint("rebalance", "brand_key", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("brand_key", "dt")
        .csv(path)
    )


def csv_folder(path: str, brand_key: str, day: str) -> str:
    """Where :func:`write_post_csv` puts the files of one brand and day."""
    return f"{path}/brand_key={brand_key}/dt={day}"


def read_brands(spark: SparkSession, path: str) -> DataFrame:
    """Brand records from JSON lines."""
    return spark.read.schema(BRANDS).json(path, mode="FAILFAST")


def brand_dim(records: DataFrame) -> DataFrame:
    """One row per ``brand_key``: the last record wins, gaps take the defaults."""
    last = F.max_by(F.struct(*records.columns), "pos").alias("_last")
    return (
        records.groupBy("brand_key")
        .agg(last)
        .select("_last.*")
        .withColumns(
            {
                "enabled": F.coalesce("enabled", F.lit(True)),
                "schema": F.coalesce("schema", F.lit(DEFAULT_SCHEMA)),
                "table": F.coalesce("table", F.lit(DEFAULT_TABLE)),
            }
        )
    )


def routed(batches: DataFrame, dim: DataFrame) -> DataFrame:
    """``batches`` with the ``schema`` and ``table`` that their ``brand_key`` is configured for.

    Rows of an unknown brand go to the default table. Writing the result partitioned by both
    columns puts every batch where it belongs.
    """
    target = held(dim.select("brand_key", "schema", "table"))
    return batches.join(target.prepared(), "brand_key", "left").withColumns(
        {
            "schema": F.coalesce("schema", F.lit(DEFAULT_SCHEMA)),
            "table": F.coalesce("table", F.lit(DEFAULT_TABLE)),
        }
    )


def enabled_brands(records: DataFrame, when_missing: bool = False) -> DataFrame:
    """Ids of the enabled records, in the order of the configuration.

    A record that does not say is off for the brand picker, but on for collection, which passes
    ``when_missing=True``.
    """
    return (
        records.filter(F.coalesce("enabled", F.lit(when_missing)))
        .select("pos", "instagram_id")
        .orderBy("pos")
    )


def brand_search(brands: DataFrame, text: str, column: str = "instagram_id") -> DataFrame:
    """Brands that contain ``text``, whatever the case."""
    return brands.filter(F.lower(column).contains(text.lower()))


def brand_param(text: Column) -> Column:
    """A comma list as an array of parts without outer white space, blank ones left out."""
    parts = F.transform(F.split(text, ",", -1), strip)
    return F.filter(parts, lambda p: p != "")


def known_brands(wanted: DataFrame, brands: DataFrame) -> DataFrame:
    """Rows of ``wanted`` (one brand per row in ``instagram_id``) that are configured."""
    return wanted.join(brands.select("instagram_id"), "instagram_id", "left_semi")


class NotAQuery(ValueError):
    """SQL text that is not one query, and so was not run."""


def run_sql(
    spark: SparkSession,
    sql: str,
    params: Mapping[str, object] | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """A read-only query with bound ``:name`` parameters, column names in upper case.

    Tables given by keyword are named ``{like_this}`` in the text. The text is parsed as a relation
    in parentheses, where Spark's grammar has room for a query and nothing else: commands, writes,
    definitions, settings and several statements raise :class:`NotAQuery`, and none of them runs.
    """
    text = sql.strip().removesuffix(";")
    try:
        result = spark.sql(f"SELECT * FROM (\n{text}\n)", args=dict(params or {}), **tables)
    except ParseException as error:
        raise NotAQuery(f"not one query that only reads: {sql.strip()[:200]}") from error
    return result.toDF(*(c.upper() for c in result.columns))
