"""The raw table: plain Parquet in folders of months, and a pointer to the folders that count."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cotag.schemas import POST_COLUMNS, POSTS
from cotag.sources.tables import bloom_options
from cotag.sources.versions import Pointer

PERIOD = "post_period"
#: Name of the folder of posts without a day.
NO_DAY = "undated"
#: Length of a period. A load rewrites every period it touches, so shorter ones cost less per load,
#: and longer ones give fewer, larger files.
GRAIN = "yyyy-MM"

_STORED = StructType([*POSTS, StructField(PERIOD, StringType())])


@dataclass(frozen=True)
class Delivery:
    """A numbered micro-batch of a stream; numbers never go back."""

    stream: str
    number: int


@dataclass(frozen=True)
class Snapshot:
    """What the pointer says: the folder that counts for each period, the last delivery of each
    stream, and the last load and newest post day in microseconds and days."""

    number: int = 0
    periods: dict[str, str] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)
    seen: int | None = None
    posted: int | None = None

    def has(self, delivery: Delivery | None) -> bool:
        """Whether the delivery is in this version."""
        return delivery is not None and delivery.number <= self.streams.get(delivery.stream, -1)


def _later(*values: int | None) -> int | None:
    return max((v for v in values if v is not None), default=None)


class PostTable:
    """Reads the current posts, and replaces the periods it is given by new folders.

    A post never changes its day, so it stays in its period. ``grain`` is the pattern of the names
    of periods and must not change for a table.
    """

    def __init__(self, spark: SparkSession, root: str, grain: str = GRAIN) -> None:
        self.spark, self.root, self.grain = spark, root, grain
        self._pointer = Pointer(spark, root)

    def period_of(self, post_date: Column) -> Column:
        return F.coalesce(F.date_format(post_date, self.grain), F.lit(NO_DAY))

    def snapshot(self) -> Snapshot:
        number, content = self._pointer.read()
        return Snapshot(number, **content)

    def placed(self, snapshot: Snapshot, periods: list[str] | None = None) -> DataFrame:
        """The posts of ``snapshot`` with their period, or those of some periods."""
        chosen = snapshot.periods if periods is None else set(periods) & set(snapshot.periods)
        paths = [f"{snapshot.periods[p]}/{PERIOD}={p}" for p in sorted(chosen)]
        if not paths:
            return self.spark.createDataFrame([], _STORED)
        # The period follows from the file's folder; each path is a leaf, so there is no root that
        # Spark could take it from.
        period = F.regexp_extract("_metadata.file_path", f"/{PERIOD}=([^/]*)/", 1)
        return self.spark.read.schema(POSTS).parquet(*paths).select("*", period.alias(PERIOD))

    def read(self, snapshot: Snapshot | None = None, periods: list[str] | None = None) -> DataFrame:
        """The table at ``snapshot`` (the current one by default), or some of its periods."""
        return self.placed(snapshot or self.snapshot(), periods).drop(PERIOD)

    def write(
        self,
        rows: DataFrame,
        base: Snapshot,
        replaced: list[str],
        delivery: Delivery | None = None,
        now: int | None = None,
    ) -> Snapshot:
        """Put ``rows`` in place of the periods ``replaced`` and of those that ``rows`` lie in.

        ``rows`` must hold all posts of these periods. One pass writes them and observes their last
        load and newest day. ``now`` is the least load stamp among rows that have changed: as long
        as stamps don't go back, the maxima of the table follow from those of before.

        The rebalance hint lets adaptive execution split a period with very many posts over
        several tasks and put small periods together. Bloom filters serve the search for one
        account's posts.
        """
        folder = self._pointer.new_folder()
        found = Observation()
        (
            rows.select(*POST_COLUMNS, self.period_of(F.col("post_date")).alias(PERIOD))
            .observe(found, F.max(F.unix_micros("last_seen_at")).alias("seen"),
                     F.max(F.unix_date("post_date")).alias("posted"))
            .hint("rebalance", PERIOD)
            .write.partitionBy(PERIOD)
            .options(**bloom_options("insta_id"))
            .parquet(folder)
        )
        seen, posted = found.get["seen"], found.get["posted"]
        written = replaced
        if not base.periods:
            stored = self.spark.read.schema(_STORED).parquet(folder)
            written = [r[PERIOD] for r in stored.select(PERIOD).distinct().collect()]
        periods = {**base.periods, **dict.fromkeys(written, folder)}
        if base.seen is not None and (now is None or now < base.seen):
            # A stamp went back: posts that lost the latest one may be among the replaced.
            others = self.placed(base, sorted(set(base.periods) - set(written)))
            seen = _later(seen, others.agg(F.max(F.unix_micros("last_seen_at"))).first()[0])
        else:
            seen = _later(seen, base.seen)
        streams = base.streams
        if delivery is not None:
            streams = {**streams, delivery.stream: delivery.number}
        content = {"periods": periods, "streams": streams, "seen": seen,
                   "posted": _later(posted, base.posted)}
        self._pointer.move(base.number + 1, content)
        return Snapshot(base.number + 1, **content)

    def freshness(self, snapshot: Snapshot | None = None) -> DataFrame:
        """Last load and newest post day, as the pointer has them; no post is read."""
        known = snapshot or self.snapshot()
        row = self.spark.createDataFrame([(known.seen, known.posted)], "seen long, posted int")
        return row.select(
            F.timestamp_micros("seen").alias("last_loaded_at"),
            F.date_from_unix_date("posted").alias("latest_post_date"),
        )

    def clean(self, grace_hours: float = 24.0) -> list[str]:
        """Remove folders that no longer count; see :meth:`Pointer.clean`."""
        return self._pointer.clean(grace_hours)


