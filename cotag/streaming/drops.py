"""Batch files as a stream: the runs that arrive together are checked and upserted together."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cotag.functions.joins import held
from cotag.operators.ingest import BatchError, check_runs, run_errors
from cotag.plans.load import load_runs
from cotag.sources.snapshots import Delivery, PostTable
from cotag.sources.tables import read_post_csv


#: Fixed value: Spark's columns of binary files.
_FILE = "path string, modificationTime timestamp, length long, content binary"


def _utc_now(batch_id: int) -> datetime:
    return datetime.now(timezone.utc)


def _run() -> Column:
    """The folder of a row's file, which is one collection run of one brand and day."""
    path = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))  # paths come as URIs
    return F.regexp_replace(F.url_decode(path), r"/[^/]*$", "").alias("run")


def read_runs(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The rows of whole runs, each with its ``run``."""
    return read_post_csv(spark, folders).select("*", _run())


def upsert_drops(
    spark: SparkSession,
    folder: str,
    table_root: str,
    checkpoint: str,
    now: Callable[[int], datetime] = _utc_now,
    rejected: Callable[[int, BatchError], None] | None = None,
) -> StreamingQuery:
    """Load all runs under ``folder`` with files that are not loaded yet, then stop.

    A run is the folder of one brand and day (``brand_key=.../dt=...``), whatever number of files
    it has: its checks are about all of them. All runs of a micro-batch are read, checked and
    loaded together in one commit, however many there are, with the result of loading them one
    after the other by name. A run whose files arrive in parts is loaded anew as a whole, which
    changes nothing that is loaded. A micro-batch that is repeated after a failure finds in the
    table that it was committed. A run that fails its checks stops the query before anything of
    its micro-batch is loaded, or is passed over and handed to ``rejected`` when that is given.

    The stream itself has a row per file and reads none: only the runs are read, once.
    """
    drops = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(_run())
    )
    table = PostTable(spark, table_root)

    def load(batch: DataFrame, batch_id: int) -> None:
        folders = [row["run"] for row in batch.select("run").distinct().collect()]
        delivery = Delivery(checkpoint, batch_id)
        if not folders or table.snapshot().has(delivery):
            return
        runs = held(read_runs(spark, folders)).df
        found = held(check_runs(runs)).df
        for _, error in run_errors(runs, found):
            if rejected is None:
                raise error
            rejected(batch_id, error)
        good = held(found.filter("duplicates = 0 and blank = 0"))
        if not good.rows:
            return
        stamp = F.lit(now(batch_id).isoformat()).cast("timestamp")
        checked = runs.join(good.prepared().select("run"), "run", "left_semi")
        load_runs(table, checked, stamp, delivery)

    return (
        drops.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
