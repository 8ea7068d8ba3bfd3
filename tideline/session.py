"""Session helpers: a local session for tests / bench, UTC, scratch folders."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "tideline", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and bench.py (local mode; the UI stays off)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDELINE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are compared as UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset in local mode (tests) a
    folder of our own is created and registered as the checkpoint dir.  On a
    cluster it has to be set.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tideline-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/tideline/{name}-{uuid.uuid4().hex[:12]}"
