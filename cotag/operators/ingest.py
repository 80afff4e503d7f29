"""Validation of a batch and its keyed upsert into the raw table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotag.functions.joins import (
    BROADCAST_ROWS,
    Side,
    drop_matching,
    keep_matching,
    text_bytes,
)
from cotag.functions.text import is_blank
from cotag.schemas import BATCH, POST_COLUMNS

_TAKEN_FROM_BATCH = ("insta_id", "insta_name", "tagged_insta_id", "tagged_insta_id_cnt")
_SHOWN_DUPLICATES = 5


class BatchError(ValueError):
    """A batch that must not be loaded."""


@dataclass(frozen=True)
class BatchChecks:
    """What one pass over a batch finds."""

    rows: int
    duplicate_keys: int
    blank_keys: int
    #: Text an upsert carries: the keys and the columns a known post takes over.
    text_bytes: int


def duplicate_post_ids(batch: DataFrame) -> DataFrame:
    """Post ids that occur more than once; NULLs count as one id."""
    return (
        batch.groupBy("post_id").agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)
    )


def blank_post_ids(batch: DataFrame) -> DataFrame:
    """One row: records whose post id is NULL or blank."""
    return batch.agg(F.count_if(is_blank(F.col("post_id"))).alias("blank_count"))


def check_batch(batch: DataFrame) -> BatchChecks:
    """Row count, duplicate keys, blank keys and size in one shuffled pass."""
    carried = ["post_id", *(c for c in _TAKEN_FROM_BATCH if c in batch.columns)]
    per_key = batch.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(text_bytes(carried)).alias("bytes")
    )
    found = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(F.col("n") > 1).alias("duplicates"),
        F.coalesce(F.sum(F.when(is_blank(F.col("post_id")), F.col("n"))), F.lit(0)).alias("blank"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    ).first()
    return BatchChecks(found["rows"], found["duplicates"], found["blank"], found["bytes"])


def validate_batch(batch: DataFrame) -> BatchChecks:
    """Raise :class:`BatchError` for an empty batch, then repeated keys, then blank keys."""
    checks = check_batch(batch)
    if checks.rows == 0:
        raise BatchError("the batch holds no rows")
    if checks.duplicate_keys:
        some = duplicate_post_ids(batch).orderBy("post_id").take(_SHOWN_DUPLICATES)
        shown = [f"{row['post_id']}({row['cnt']})" for row in some]
        raise _problem(checks.duplicate_keys, shown, checks.blank_keys)
    if checks.blank_keys:
        raise _problem(0, [], checks.blank_keys)
    return checks


def _problem(duplicates: int, shown: list[str], blank: int) -> BatchError:
    if duplicates:
        return BatchError(f"repeated post_id: {', '.join(shown)} ({duplicates} in all)")
    return BatchError(f"{blank} rows have a blank post_id")


def cast_post_date(batch: DataFrame) -> DataFrame:
    """``post_date`` text as a date; text that is no date fails the load."""
    return batch.withColumn("post_date", F.col("post_date").cast("date"))


def split_batch(
    target: DataFrame,
    batch: DataFrame,
    checks: BatchChecks,
    broadcast_rows: int = BROADCAST_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Target keys and days the batch matches, and the batch rows that are new, typed.

    The target is read for two columns, and as its key is unique it matches no more keys than
    the batch has. Only a new row has its date cast: a known post keeps the day it has.
    """
    keys = Side(batch, checks.rows, checks.text_bytes)
    known = keep_matching(target.select("post_id", "post_date"), keys, "post_id", broadcast_rows)
    added = drop_matching(batch, replace(keys, df=known), "post_id", broadcast_rows)
    return known, cast_post_date(added)


def _as_new(added: DataFrame, now: Column) -> DataFrame:
    stamped = {
        "first_seen_at": now.alias("first_seen_at"),
        "last_seen_at": now.alias("last_seen_at"),
        "active": F.lit(True).alias("active"),
    }
    return added.select(*(stamped.get(c, F.col(c)) for c in POST_COLUMNS))


def _updated(now: Column, matched: Column) -> list[Column]:
    """Target columns, those of a matched row taken from ``_new`` where the rule says so."""
    changed = {
        **{c: F.col(f"_new.{c}") for c in _TAKEN_FROM_BATCH},
        "last_seen_at": now,
        "active": F.lit(True),
    }
    return [
        F.when(matched, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in POST_COLUMNS
    ]


def upsert_posts(
    target: DataFrame,
    batch: DataFrame,
    now: Column,
    checks: BatchChecks | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    added: DataFrame | None = None,
) -> DataFrame:
    """``target`` after the batch, matched on ``post_id``.

    A matched post takes author, tags and ``last_seen_at`` from the batch and keeps brand, link,
    image, day and ``first_seen_at``; a NULL of the batch overwrites. Other posts stay as they
    are, new ones are added.

    A batch within the broadcast bounds updates the target where it is read: the large table is
    not shuffled or sorted. A larger one is a full outer sort-merge join. ``added`` are the batch's
    new posts, typed, where the caller has looked them up already; then ids are not read again.
    """
    checks = checks or check_batch(batch)
    new = Side(
        batch.select("post_id", F.struct(*_TAKEN_FROM_BATCH).alias("_new")),
        checks.rows,
        checks.text_bytes,
    )
    if not new.fits(broadcast_rows):
        return _upsert_shuffled(target, batch, now)
    kept = target.join(new.prepared(broadcast_rows), "post_id", "left").select(
        *_updated(now, F.col("_new").isNotNull())
    )
    if added is None:
        _, added = split_batch(target, batch, checks, broadcast_rows)
    return kept.unionByName(_as_new(added, now))


def check_runs(runs: DataFrame) -> DataFrame:
    """Per ``run``: rows, duplicate keys, blank keys, text bytes. All runs are checked by one
    grouping by run and key, which collapses repeats before they are shuffled."""
    per_key = runs.groupBy("run", "post_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(text_bytes(["post_id", *_TAKEN_FROM_BATCH])).alias("bytes"),
    )
    return per_key.groupBy("run").agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") > 1).alias("duplicates"),
        F.coalesce(F.sum(F.when(is_blank(F.col("post_id")), F.col("n"))), F.lit(0)).alias("blank"),
        F.sum("bytes").alias("bytes"),
    )


def run_errors(runs: DataFrame, found: DataFrame) -> list[tuple[str, BatchError]]:
    """What is wrong with the runs that fail their checks in ``found`` (:func:`check_runs`), in
    their order; as many rows as there are such runs reach the driver, with a few keys each."""
    bad = found.filter("duplicates > 0 or blank > 0").orderBy("run").collect()
    repeated = [r["run"] for r in bad if r["duplicates"]]
    shown: dict[str, list[str]] = {}
    if repeated:
        place = F.row_number().over(Window.partitionBy("run").orderBy("post_id"))
        some = (
            runs.filter(F.col("run").isin(repeated)).groupBy("run", "post_id")
            .agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")
            .withColumn("place", place).filter(F.col("place") <= _SHOWN_DUPLICATES)
        )
        for row in some.orderBy("run", "place").collect():
            shown.setdefault(row["run"], []).append(f"{row['post_id']}({row['cnt']})")
    return [(r["run"], _problem(r["duplicates"], shown.get(r["run"], []), r["blank"])) for r in bad]


def merged_runs(runs: DataFrame) -> DataFrame:
    """One batch that does what the checked ``runs`` do one after the other, by ``run``.

    A post that is new takes what known posts keep from its first run; what every run brings anew
    comes from its last one.
    """
    owned = [c for c in BATCH.fieldNames() if c not in ("post_id", *_TAKEN_FROM_BATCH)]
    grouped = runs.groupBy("post_id").agg(
        F.min_by(F.struct(*owned), "run").alias("_first"),
        F.max_by(F.struct(*_TAKEN_FROM_BATCH), "run").alias("_last"),
    )
    return grouped.select("post_id", "_first.*", "_last.*").select(*BATCH.fieldNames())


def _upsert_shuffled(target: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    old = target.select("post_id", F.struct(*target.columns).alias("_old"))
    new = _as_new(batch, now).select("post_id", F.struct(*POST_COLUMNS).alias("_new"))
    both = old.join(new, "post_id", "full_outer")
    in_old, in_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    from_new = {*_TAKEN_FROM_BATCH, "last_seen_at", "active"}

    def pick(c: str) -> Column:
        if c == "post_id":
            return F.col(c)
        old_c, new_c = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        if c == "post_date":
            new_c = new_c.cast("date")
        if c in from_new:
            return F.when(in_new, new_c).otherwise(old_c).alias(c)
        return F.when(in_old, old_c).otherwise(new_c).alias(c)

    return both.select(*(pick(c) for c in POST_COLUMNS))
