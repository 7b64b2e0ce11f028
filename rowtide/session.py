"""Spark session defaults for change-feed work.

Everything here is plain SparkSession configuration.  The settings that matter
at scale are AQE (runtime coalescing and skew-join splitting), a UTC session
zone (binlog seconds are UTC epoch seconds) and a shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state for latest-state tables can be large; RocksDB keeps it off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit each micro-batch as a changelog of its state updates instead of
    # uploading a snapshot: the commit then costs the batch's changes, not the state size.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Merge session windows inside each input partition before the shuffle, so a busy
    # table's changes reach its state task as a few partial sessions, not row by row.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_session(master: str | None = None, app: str = "rowtide",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the deployment (a shared file
    system); it is only filled in here for local runs, where a scratch folder
    on the one machine *is* shared by every executor thread.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="rowtide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go when the query ends, not when the driver happens to collect
    its garbage; a stream started within it holds to that in every micro-batch."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder (for stream outputs and landed feeds).

    Nothing is made on the driver's disk: whoever writes first makes the folder, in
    whatever file system the setting names.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
