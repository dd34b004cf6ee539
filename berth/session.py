"""Session helpers: a local session for tests/bench and the shared
checkpoint folder taken from the cluster's own configuration."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "berth") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """``spark.checkpoint.dir`` is unset on a cluster."""


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir``, as a cluster sets it).
    Only a local master, as in tests, gets a scratch folder of its own when it
    is unset; that folder is removed when the driver ends.
    """
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise NoSharedFolder(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="berth-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, wherever Spark can reach it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_folder(spark: SparkSession, kind: str) -> Iterator[str]:
    """A new folder in the shared one, removed when the block ends: what is still wanted of
    it must have been checkpointed or written elsewhere by then."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/berth-{kind}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_folder(spark, path)
