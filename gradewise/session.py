"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Observation, SparkSession

# Settings a job of this package wants; a cluster's own submit-time settings win over them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Recording the Python line of every column call costs more than planning a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Settings of the session a stream runs in (see stream_session).
STREAM_SETTINGS = {
    # Session windows are merged inside each map task before the shuffle, so a grade that
    # holds a third of the events ships its sessions, not its events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # State lives in RocksDB on local disk plus the checkpoint, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "gradewise", master: str | None = None, **settings: str) -> SparkSession:
    """A session with this package's settings; `settings` use `__` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for streams, so that stream settings do not leak into the caller's.

    The number of state partitions is fixed by a query's first checkpoint and so is a choice for the
    query's life. It is the session's number of shuffle partitions unless given: the cores that
    happen to be up when a job starts say nothing about it.
    """
    sibling = spark.newSession()
    for key, value in STREAM_SETTINGS.items():
        sibling.conf.set(key, value)
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        sibling.conf.set(key, spark.conf.get(key))
    if state_partitions is None:
        state_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sibling.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return sibling


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder named by `spark.checkpoint.dir`.

    Executors on every machine must see it, so a local temporary folder is only
    used when Spark itself runs in local mode and no folder is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="gradewise-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/gradewise/{label}-{uuid.uuid4().hex}"


def observed(observation: Observation) -> dict:
    """What was observed; nothing if Spark found out that there are no rows and left the observation out."""
    return observation.get if observation._jo.getRow().schema() is not None else {}


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reaches; none if there is no folder."""
    files, folder = _folder(spark, path)
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def whole_path(spark: SparkSession, path: str) -> str:
    """The path with its file system and from its root, as the catalog wants it."""
    files, folder = _folder(spark, path)
    return files.makeQualified(folder).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def write_text(spark: SparkSession, path: str, text: str = "") -> None:
    """Write a small file, replacing it."""
    files, place = _folder(spark, path)
    out = files.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on any file system that Spark reaches."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch path that the job which makes it also deletes, be it done or failed."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        delete_path(spark, path)
