"""What several operators share: reading tables, word tables, group streams, components."""

from __future__ import annotations

import os
import re
import site
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotag.session import ensure_checkpoints

_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, by Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named as Spark names it."""
    plain = re.sub(r"^file:/+", "/", uri)
    if plain.startswith("/"):
        return fs.LocalFileSystem(), plain
    return fs.FileSystem.from_uri(plain)


def remove_folder(uri: str) -> None:
    """Remove a folder that a run has written and nothing reads any more."""
    files, path = file_system(uri)
    files.delete_dir(path)


_ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def importable(spark: SparkSession) -> None:
    """Make this package importable in Python tasks.

    Where it is neither installed nor on the path that tasks inherit, Spark sends its source files
    along, as ``--py-files`` would.
    """
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if spark.sparkContext.master.startswith("local["):
        paths.append(os.getcwd())
    known = {Path(p).resolve() for p in (*paths, *site.getsitepackages()) if p}
    application = spark.sparkContext.applicationId
    if _ROOT in known or application in _shipped:
        return
    archive = f"{tempfile.mkdtemp(prefix='cotag-source-')}/cotag.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted((_ROOT / "cotag").rglob("*.py")):
            file.write(source, source.relative_to(_ROOT))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of the Arrow batches that Python tasks receive; a lower limit stays.

    Their bytes are bounded by Spark's own setting for that.
    """
    importable(spark)
    now = int(spark.conf.get(_ARROW_ROWS))
    if now <= 0 or now > rows:
        spark.conf.set(_ARROW_ROWS, str(rows))


class WordTable(dict):
    """What ``value`` gives for a word, kept for the words seen lately.

    It holds at most ``size`` words: when full it starts anew, so memory stays bounded whatever
    the text. Words longer than ``longest`` are computed each time.
    """

    def __init__(self, value: Callable, size: int = 50_000, longest: int = 64):
        super().__init__()
        self._value, self._size, self._longest = value, size, longest

    def __missing__(self, word):
        found = self._value(word)
        if len(word) <= self._longest:
            if len(self) >= self._size:
                self.clear()
            self[word] = found
        return found


_kept: dict[tuple, object] = {}


def kept(make: Callable, of) -> object:
    """``make(of)``, kept from task to task; a Python worker keeps one such object at a time."""
    key = (make, of)
    if key not in _kept:
        release_kept()
        _kept[key] = make(of)
    return _kept[key]


def release_kept() -> None:
    """Forget what :func:`kept` holds. Workers outlive a stage, so tasks of a stage that doesn't use
    it call this, and large tables of one stage don't lie beside the work of another."""
    _kept.clear()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a missing text is empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def grouped_rows(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[list[dict]]:
    """Runs of rows with equal ``keys`` from a partition sorted by them.

    Only one run is in memory at a time, also where a run spans batches.
    """
    run: list[dict] = []
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != last and run:
                yield run
                run = []
            last = key
            run.append(row)
    if run:
        yield run


def by_group(
    df: DataFrame, keys: Sequence[str], work: Callable[[list[dict]], Iterator[dict]], schema: str
) -> DataFrame:
    """``work`` over the rows of each value of ``keys``; groups must be of bounded size.

    One Python task streams through many groups, which costs far less than a call per group.
    """
    out = schema

    def run(batches):
        release_kept()
        fields = pa.schema(arrow_fields(out))
        pending: list[dict] = []
        for rows in grouped_rows(batches, keys):
            pending.extend(work(rows))
            if len(pending) >= 5000:
                yield pa.RecordBatch.from_pylist(pending, fields)
                pending = []
        if pending:
            yield pa.RecordBatch.from_pylist(pending, fields)

    small_batches(df.sparkSession)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


_ARROW = {
    "long": pa.int64(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()),
}


def arrow_fields(schema: str) -> list[tuple[str, pa.DataType]]:
    """Arrow fields of a flat DDL schema."""
    pairs = (part.strip().split(" ", 1) for part in schema.split(","))
    return [(name, _ARROW[kind.strip()]) for name, kind in pairs]


def text_key(text: str | Column = "text") -> Column:
    """A key that equal texts share: 128 bits of MD5 as hex; a missing text counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.md5(F.coalesce(column, F.lit("")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: (node, root) with the least node as root.

    Alternating large-star and small-star rounds, each a grouping and a join, until nothing
    changes; the number of rounds grows with the logarithm of the longest chain. Every round is
    cut by a reliable checkpoint. Loops and repeated edges are fine, no edges give no rows; rows
    with a missing end are ignored.
    """
    ensure_checkpoints(edges.sparkSession)
    now = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
        .checkpoint()
    )

    def mark(df: DataFrame) -> tuple:
        row = df.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1_000_003))
        ).first()
        return tuple(row)

    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Held tables have no partitioning, so Spark shuffles both sides of each join just for it
        # and may split the edges of a hub over several tasks.
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        ).checkpoint()
        large = (
            both.join(least.hint("merge"), "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
            .checkpoint()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m")).checkpoint()
        small = (
            large.join(least.hint("merge"), "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
                              ).alias("e"))
            .select("e.*")
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        now = small.checkpoint()
        latest = mark(now)
        if latest == seen:
            break
        seen = latest
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
