"""The daily rebuild: stage view, marts, expectations."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotag import schemas
from cotag.functions.joins import held
from cotag.functions.layout import BUCKET, account_bucket
from cotag.functions.text import clean_account, trim_spaces
from cotag.operators import marts, quality
from cotag.operators.stage import tag_parts, tagged_post_rows, tagged_posts
from cotag.sources.tables import bloom_options
from cotag.sources.versions import Pointer

STAGE_VIEW = "group_by_tagged_post"

#: Declared columns of the summaries; the other marts are read as they were written.
MART_SCHEMAS = {
    "account_tagged_accounts": schemas.ACCOUNT_TAGGED,
    "cross_brand_accounts": schemas.CROSS_BRAND,
    "mart_brand_monthly_tagging": schemas.BRAND_MONTHLY,
    "mart_co_brand_stats": schemas.CO_BRAND_STATS,
}


class ExpectationError(RuntimeError):
    """A rebuilt table breaks an expectation."""


def stage_view(posts: DataFrame, name: str = STAGE_VIEW) -> DataFrame:
    """The stage as a view: nothing is stored, every reader gets its own plan."""
    stage = tagged_post_rows(posts)
    stage.createOrReplaceTempView(name)
    return stage


def write_mart(
    df: DataFrame, path: str, *cluster: str, lookup: str | None = None, order: Column | None = None
) -> DataFrame:
    """Store a mart, range-clustered by the columns its readers filter on.

    Range partitions split a hot first column by the second one, and row groups of one brand lie
    together, so a brand filter skips the others. ``lookup`` names a column that is searched for
    single values: its Bloom filters let such a search skip row groups. ``order`` is a cheaper order
    of the rows of a file than that of the cluster columns; it too has to keep them together.
    """
    if cluster:
        inside = cluster if order is None else (order,)
        df = df.repartitionByRange(*cluster).sortWithinPartitions(*inside)
    writer = df.write.mode("overwrite")
    if lookup:
        writer = writer.options(**bloom_options(lookup))
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_account(df: DataFrame, path: str) -> DataFrame:
    """Store a table in account folders, sorted by account, for readers of one account.

    The rebalance hint splits the folder of an account with very many rows over several files.
    """
    placed = df.withColumn(BUCKET, account_bucket(F.col("insta_id")))
    (
        placed.hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, "insta_id")
        .write.mode("overwrite")
        .options(**bloom_options("insta_id"))
        .partitionBy(BUCKET)
        .parquet(path)
    )
    return df.sparkSession.read.schema(placed.schema).parquet(path)


Tables = dict[str, DataFrame]


class Marts:
    """The marts under ``root``; each rebuild is a new version of all of them.

    Beside the four summaries there are a finer one that the months are built from, and copies of
    edges and recent posts in account folders.
    """

    EDGES = "account_tagged_accounts"
    #: Builder from the posts and the marts before it, and the columns it is clustered by.
    BUILDERS: dict[str, tuple[Callable[[DataFrame, Tables], DataFrame], tuple[str, ...]]] = {
        EDGES: (lambda posts, built: marts.account_tagged(posts), ("tagged_account", "insta_id")),
        "cross_brand_accounts": (
            lambda posts, built: marts.cross_brand_accounts(built["account_tagged_accounts"]), ()
        ),
        "tagger_months": (
            lambda posts, built: marts.tagger_months(posts),
            ("tagged_account", "month", "insta_id"),
        ),
        "mart_brand_monthly_tagging": (
            lambda posts, built: marts.months_of_brands(built["tagger_months"]),
            ("tagged_account", "month"),
        ),
        "mart_co_brand_stats": (
            lambda posts, built: marts.co_brand_stats(built["account_tagged_accounts"]),
            ("tagged_account",),
        ),
    }
    #: Cheaper orders inside the files of a mart: see :func:`write_mart`.
    ORDERS: dict[str, Callable[[], Column]] = {"tagger_months": marts.month_runs}
    #: Copies in account folders.
    BY_ACCOUNT: dict[str, Callable[[DataFrame, Tables], DataFrame]] = {
        "edges_by_account": lambda posts, built: built["account_tagged_accounts"],
        "recent_posts": lambda posts, built: marts.recent_posts(posts),
    }

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self._pointer = Pointer(spark, root)

    def read(self, name: str) -> DataFrame:
        _, content = self._pointer.read()
        reader = self.spark.read
        if name in MART_SCHEMAS:
            reader = reader.schema(MART_SCHEMAS[name])
        return reader.parquet(f"{content['folder']}/{name}")

    def clean(self, grace_hours: float = 24.0) -> list[str]:
        """Remove marts that no longer count; see :meth:`Pointer.clean`."""
        return self._pointer.clean(grace_hours)

    def rebuild(self, posts: DataFrame, check: bool = True) -> dict[str, DataFrame]:
        """Build all marts from ``posts``, check them, then make them the current version."""
        number = self._pointer.read()[0] + 1
        folder = self._pointer.new_folder()
        built: Tables = {}
        for name, (build, cluster) in self.BUILDERS.items():
            lookup = "insta_id" if name == self.EDGES else None
            order = self.ORDERS[name]() if name in self.ORDERS else None
            built[name] = write_mart(
                build(posts, built), f"{folder}/{name}", *cluster, lookup=lookup, order=order
            )
        for name, build in self.BY_ACCOUNT.items():
            built[name] = write_by_account(build(posts, built), f"{folder}/{name}")
        if check:
            require(expectations(posts, None, built))
        self._pointer.move(number, {"folder": folder})
        return built


def expectations(
    posts: DataFrame, stage: DataFrame | None, built: dict[str, DataFrame]
) -> DataFrame:
    """All data tests: (check_name, failures). The tests of one table share a pass over it; those of
    a given stage take two.

    Without ``stage`` its tests are derived from the posts' tag lists: see :func:`stage_failures`.
    """
    tables = {"posts": posts, **built} if stage is None else {"posts": posts, "stage": stage, **built}

    def counted(check: str, failing: DataFrame) -> DataFrame:
        return failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(check).alias("check_name"), "failures"
        )

    row_checks = {
        name: {f"{name}.{c} not null": F.col(c).isNull() for c in columns}
        for name, columns in quality.REQUIRED.items()
    }
    row_checks["stage"][_STAGE_BLANK] = quality.is_blank_account()
    row_checks["cross_brand_accounts"]["cross_brand_accounts.tagged_account_count positive"] = (
        quality.is_without_tags()
    )
    results = []
    for name, checks in row_checks.items():
        keys = quality.UNIQUE[name]
        if name == Marts.EDGES:
            unique = "edges unique pair"
        else:
            unique = f"{name} unique {', '.join(keys)}"
        if name == "stage" and stage is not None:
            # Its keys are as many as its rows: counting failures by key would only widen the shuffle.
            results.append(quality.failure_counts(stage, checks, "check_name"))
            results.append(counted(unique, quality.duplicate_keys(stage, keys)))
        elif name in tables:
            results.append(quality.key_failures(
                tables[name], checks, keys, unique, "check_name", with_nulls=name == Marts.EDGES
            ))
    if stage is None:
        results.append(stage_failures(posts))
    return reduce(DataFrame.unionByName, results)


_STAGE_BLANK = "stage.tagged_account not blank"


def stage_failures(posts: DataFrame) -> DataFrame:
    """The data tests of the stage, without deriving it: (check_name, failures).

    A stage row has its post's fields, so NULLs are counted as often as the post has tags, and blank
    accounts inside the tag list, in one pass over the posts. A key holds post id and position, so
    only posts that share an id (in a sound table there are none) can repeat one; just their rows
    are derived and compared.
    """
    parts = F.filter(
        F.transform(tag_parts(F.col("tagged_insta_id")), trim_spaces), lambda part: part != ""
    )
    blank = F.size(F.filter(parts, lambda part: trim_spaces(clean_account(part)) == ""))
    rows = tagged_posts(posts).withColumns({"_rows": F.size(parts), "_blank": blank})
    never = F.lit(0).cast("long")  # keys and accounts are made of values that are there
    counts = {
        f"stage.{c} not null": F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_rows"))), never)
        if c in rows.columns else F.max(never)
        for c in quality.REQUIRED["stage"]
    }
    counts[_STAGE_BLANK] = F.coalesce(F.sum("_blank"), never)
    found = rows.agg(*(F.coalesce(c, never).alias(f"_{i}") for i, c in enumerate(counts.values())))
    pairs = F.array(*(
        F.struct(F.lit(name).alias("check_name"), F.col(f"_{i}").alias("failures"))
        for i, name in enumerate(counts)
    ))
    repeated = held(
        posts.groupBy(F.col("post_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    )
    suspects = posts.join(repeated.prepared(), F.col("post_id").eqNullSafe(F.col("_id")), "left_semi")
    (key,) = quality.UNIQUE["stage"]
    twice = quality.duplicate_keys(tagged_post_rows(suspects if repeated.rows else posts.limit(0)), [key])
    unique = twice.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(f"stage unique {key}").alias("check_name"), "failures"
    )
    return found.select(F.inline(pairs)).unionByName(unique)


def require(results: DataFrame) -> None:
    """Raise when a check of :func:`expectations` has failures."""
    failed = results.filter("failures > 0").collect()
    if failed:
        raise ExpectationError("; ".join(f"{r['check_name']}: {r['failures']}" for r in failed))
