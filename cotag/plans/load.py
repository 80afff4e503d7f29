"""Loading one batch into the raw table."""

from __future__ import annotations

import random
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotag.functions.joins import BROADCAST_ROWS, Side, drop_matching, held, keep_matching
from cotag.operators.ingest import (
    BatchChecks, cast_post_date, merged_runs, upsert_posts, validate_batch,
)
from cotag.sources.snapshots import PERIOD, Delivery, PostTable, Snapshot
from cotag.sources.versions import CommitConflict

#: How often a load starts again after another writer was first, and the seconds it waits before
#: that, half of them at least.
TRIES = 10
PAUSE = 3.0


def split_batch_by_period(
    table: PostTable, base: Snapshot, batch: DataFrame, checks: BatchChecks, broadcast_rows: int
) -> tuple[list[str], DataFrame]:
    """Periods that the batch touches, and its posts that are new, with their day cast.

    The only lookup of a load: known posts are found in one pass over the ids of the table, which
    also tells their periods. One row per period reaches the driver.
    """
    keys = Side(batch, checks.rows, checks.text_bytes)
    ids = table.placed(base).select("post_id", PERIOD)
    known = held(keep_matching(ids, keys, "post_id", broadcast_rows))
    added = cast_post_date(drop_matching(batch, known, "post_id", broadcast_rows))
    named = added.select(table.period_of(F.col("post_date")).alias(PERIOD))
    periods = known.df.select(PERIOD).unionByName(named).distinct()
    return [row[PERIOD] for row in periods.collect()], added


def load_batch(
    table: PostTable,
    batch: DataFrame,
    now: Column,
    delivery: Delivery | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    tries: int = TRIES,
    pause: float = PAUSE,
    checks: BatchChecks | None = None,
) -> Snapshot:
    """Check the batch, upsert it and commit the next version of ``table``.

    The batch is read once, into a checkpoint, so what is checked is what is loaded; ``checks``
    are those of a batch that was checked before. A failed check or a failed write leaves the table
    at its last version. A ``delivery`` that the table has taken before is not loaded again, also
    if others committed since. Where another writer commits first, the load waits a moment and
    starts again from that version.
    """
    if table.snapshot().has(delivery):
        return table.snapshot()
    rows = batch if checks else held(batch).df
    checks = checks or validate_batch(rows)
    stamp = batch.sparkSession.range(1).select(F.unix_micros(now).alias("now")).first()["now"]
    for attempt in range(tries):
        if attempt:
            time.sleep(pause * random.uniform(0.5, 1.0))
        base = table.snapshot()
        if base.has(delivery):
            return base
        periods, added = split_batch_by_period(table, base, rows, checks, broadcast_rows)
        updated = upsert_posts(table.read(base, periods), rows, now, checks, broadcast_rows, added)
        try:
            return table.write(updated, base, periods, delivery, stamp)
        except CommitConflict:
            if attempt == tries - 1:
                raise
    raise ValueError("tries must be positive")


def load_runs(
    table: PostTable, runs: DataFrame, now: Column, delivery: Delivery | None = None
) -> Snapshot:
    """Load rows of several checked runs at once, as if the runs came one after the other."""
    merged = held(merged_runs(runs))
    checks = BatchChecks(merged.rows, 0, 0, merged.text_bytes)
    return load_batch(table, merged.df, now, delivery, checks=checks)
