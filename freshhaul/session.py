"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from freshhaul import storage

# Runtime settings that do not depend on the cluster size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.streaming.stopGracefullyOnShutdown": "true",
    # Stack traces per column expression double the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session with the defaults; ``extra`` wins, cluster sizing comes from submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}  # application id -> temporary folder, without a cluster setting


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables that cut lineage: ``spark.checkpoint.dir``.

    Without that setting a local session, as in tests, takes a temporary folder; on a
    cluster, where each machine would write to its own disk, it is an error.
    """
    context = spark.sparkContext
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="freshhaul-")
        root = _LOCAL[context.applicationId]
    return root.rstrip("/")


_OPEN: list[list[str]] = []  # scratch paths of the jobs that are running


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _OPEN[-1:]:
        paths.append(path)
    return path


@contextmanager
def scratch_of_job(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside when the job ends, also by an error.

    For jobs that have written their results by then, not for lazy frames.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            storage.remove(spark, path)
