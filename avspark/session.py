"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_work_dirs: dict[str, str] = {}


def build_session(
    app_name: str = "avspark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC time, AQE (coalescing + skew splitting) and RocksDB state.

    Nothing here is sized for a laptop: partition counts are left to AQE unless the
    caller pins them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        # Call-site capture costs about a millisecond for each Column built.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make naive timestamps mean the same instant on every session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def state_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, whose streams keep their state in RocksDB.

    Timers and list states need that store; the caller's own settings stay as they are.
    """
    own = pin_utc(spark.newSession())
    own.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return own


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; on a cluster a
    machine-local folder would lose data with the machine, so an unset folder is an
    error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_work_dirs:
        path = tempfile.mkdtemp(prefix="avspark-")
        sc.setCheckpointDir(path)
        _local_work_dirs[sc.applicationId] = path
    return _local_work_dirs[sc.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`work_dir`, never reused."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
