"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"
CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "helioframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC clocks and adaptive execution.

    Shuffle partitions are only an upper bound: adaptive execution merges small ones and splits
    skewed ones, so on a cluster set ``spark.sql.shuffle.partitions`` to a few times the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # State of streams lies on the executors' disks, not in their heaps.
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
        # Looking up the caller's line for every column expression slows the building of wide plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Raw instants and naive plant-local times are only told apart when the session clock is UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares between machines; a temporary one only when none is set."""
    configured = spark.conf.get(CHECKPOINT_DIR, "") or spark.sparkContext.getConf().get(CHECKPOINT_DIR, "")
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set(CHECKPOINT_DIR, path)
    return path
