"""Session settings the operators are tuned for, and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Target size of a shuffle partition before AQE merges small ones.
PARTITION_BYTES = 128 * 1024 * 1024


def recommended_conf(shuffled_bytes: int | None = None) -> dict[str, str]:
    """SQL settings for wide two-sided comparisons; none of them is needed for right results.

    ``shuffled_bytes``: what the largest join moves, both sides together. It sets the number of shuffle partitions, so that
    one fits in a task's memory; AQE merges partitions that turn out small.
    """
    sized = {"spark.sql.shuffle.partitions": str(max(1, -(-shuffled_bytes // PARTITION_BYTES)))} if shuffled_bytes else {}
    return {
        **sized,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Lets AQE replace sort-merge by shuffled hash join where every measured partition is small enough.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        # A claims comparison carries both sides of well over 100 columns; the default of 100 turns codegen off there.
        "spark.sql.codegen.maxFields": "1000",
        # Methods beyond this size are not compiled by the JVM; Spark then splits the work instead of fusing it.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Recording the call site of every column costs more than building the column.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # A join on several keys may then use tables bucketed by one of them.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.session.timeZone": "UTC",
    }


def build_session(app_name: str = "twinledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**recommended_conf(), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a session whose driver and executors are one process (master ``local``
    or ``local[n]``) falls back to a temporary folder without that setting; it is removed when Python ends.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = _local_root()
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


@functools.cache
def _local_root() -> str:
    """One temporary folder a process."""
    folder = tempfile.TemporaryDirectory(prefix="twinledger-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    return folder.name
