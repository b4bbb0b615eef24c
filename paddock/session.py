"""Session helpers.

Library code leaves the session's configuration as it was (``freed_shuffles`` holds one
setting for a single write); the builder below is for tests, the bench and local runs. ``work_dir`` returns the shared folder named
by ``spark.checkpoint.dir`` (a cluster-wide location), falling back to a fresh
local temp folder only when the session does not name one (as in tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "paddock", extra: dict | None = None) -> SparkSession:
    """A local session tuned for small test data (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a local one only if unset.

    The cluster names its shared folder in ``spark.checkpoint.dir``; a local
    temp folder is used only when nothing is configured (tests, local runs).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Spark Connect) session has no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local[") and master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="paddock-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
    else:
        spark.conf.set("spark.checkpoint.dir", local)
    return local


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fixed folder under the shared checkpoint location (cluster-wide storage)."""
    current = ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or current
    return os.path.join(base, "paddock", *parts)


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables."""
    return os.path.join(shared_dir(spark, "work", *parts), uuid.uuid4().hex[:12])


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of a write that runs within go with its end, since nothing reads them after
    it, and not at some later garbage collection of the driver."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
