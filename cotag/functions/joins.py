"""Joins whose small side is broadcast only after its size is known."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cotag.session import ensure_checkpoints

#: Bounds within which a side may be broadcast; both must hold.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Side:
    """One side of a join with its measured size, or an upper bound of it."""

    df: DataFrame
    rows: int
    text_bytes: int
    metrics: dict[str, object] = field(default_factory=dict)

    def fits(self, broadcast_rows: int = BROADCAST_ROWS) -> bool:
        return self.rows <= broadcast_rows and self.text_bytes <= BROADCAST_BYTES

    def prepared(self, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """The side with the join hint its size calls for.

        Beyond the bounds that is a sort-merge join. A held side has no partitioning of its own,
        so Spark shuffles both inputs just for this join, and that is what the adaptive skew-join
        rule needs to split a hot key of the other side over several tasks.
        """
        return F.broadcast(self.df) if self.fits(broadcast_rows) else self.df.hint("merge")


def text_bytes(columns: Sequence[str | Column]) -> Column:
    """Bytes of text or binary values in ``columns`` of a row."""
    sizes = (F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in columns)
    return reduce(add, sizes, F.lit(0).cast("bigint"))


def held(df: DataFrame, **metrics: Column) -> Side:
    """``df`` in a checkpoint, with its size.

    For lists whose size decides a join. The checkpoint lies in the shared folder, so the list is
    computed once, survives the loss of executors and holds no memory. Its rows and bytes, and the
    aggregates ``metrics`` if any are wanted, are observed while it is written: nothing is scanned
    again for them.
    """
    ensure_checkpoints(df.sparkSession)
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    sized = [c for c, kind in kinds.items() if kind in ("string", "binary")]
    nested = [
        F.col(c).cast("string") for c, kind in kinds.items() if kind in ("array", "map", "struct")
    ]
    size = Observation()
    kept = df.observe(
        size,
        F.count(F.lit(1)).alias("_rows"),
        F.coalesce(F.sum(text_bytes([*sized, *nested])), F.lit(0)).alias("_bytes"),
        *(metric.alias(name) for name, metric in metrics.items()),
    ).checkpoint()
    found = size.get
    return Side(kept, found["_rows"], found["_bytes"], {name: found[name] for name in metrics})


def keep_matching(
    df: DataFrame, side: Side, on: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows of ``df`` whose ``on`` occurs in ``side``."""
    return df.join(side.prepared(broadcast_rows).select(on), on, "left_semi")


def drop_matching(
    df: DataFrame, side: Side, on: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows of ``df`` whose ``on`` does not occur in ``side``."""
    return df.join(side.prepared(broadcast_rows).select(on), on, "left_anti")
