"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "mercato", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, the submitter's session is used as is."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # no stack capture for each column expression: plans are built several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    Read from ``spark.checkpoint.dir``; only a local-mode session (tests) gets
    a private folder when nothing is configured. A cluster must name a shared
    folder, since executors can be lost and a machine-local path is not seen by
    the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    path = tempfile.mkdtemp(prefix="mercato-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def stage_path(spark: SparkSession, name: str) -> str:
    """A path for a written stage table next to the checkpoints."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "stages", name) if "://" not in base else f"{base.rstrip('/')}/stages/{name}"
