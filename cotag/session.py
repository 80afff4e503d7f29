"""Session settings and the shared folder that checkpoints and derived tables use."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "cotag", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; keyword names use ``__`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may run without the
    setting; it then gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get(_CHECKPOINT_KEY) or spark.conf.get(_CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="cotag-")
    sc.setCheckpointDir(folder)
    return folder


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable in this session."""
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
