"""Session construction and small helpers shared by every module."""

from __future__ import annotations

import atexit
import gc
import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults for a session this package builds itself (tests, bench, CLI).  On a
# cluster the session usually comes from the platform; nothing here overrides a
# value that is already set.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, shuffle_bytes: int | None = None, partition_bytes: int = 128 * 1024**2) -> dict[str, str]:
    """Settings for a large cluster, sized from the core count and, when
    known, the largest expected shuffle.

    The initial shuffle partition count is high enough that each reducer
    task stays near ``partition_bytes`` (and at least three waves of tasks);
    AQE then coalesces small partitions toward the same advisory size
    instead of maximising parallelism, and splits skewed join partitions.
    """
    waves = 3 * total_cores
    by_size = -(-shuffle_bytes // partition_bytes) if shuffle_bytes else 0
    parts = max(waves, by_size)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024**2),
    }


def build_session(
    app_name: str = "incidentflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``incidentflow`` importable in the Python workers of this
    context (needed by the ``mapInPandas`` step): the package is zipped once
    on the driver and handed to ``SparkContext.addPyFile``, which serves it
    to every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="incidentflow-py-")
    archive = shutil.make_archive(os.path.join(out, "incidentflow"), "zip", os.path.dirname(pkg_dir), "incidentflow")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting).  Only a local-mode session without one
    gets a private temporary folder; a cluster session without a shared folder
    is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every executor shares"
            )
        configured = tempfile.mkdtemp(prefix="incidentflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/incidentflow/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: cuts lineage (a lost executor re-reads files instead of
    re-running joins) and computes the plan exactly once, unlike an eager
    RDD checkpoint of an uncached frame, which runs it twice."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _WRITTEN.append(path)
    if getattr(_OPEN, "scratch", None) is not None:
        _OPEN.scratch.paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_WRITTEN: list[str] = []
_OPEN = threading.local()


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def release(spark: SparkSession) -> int:
    """Removes the tables that :func:`materialise` has written; frames read
    from them can no longer be used.  Returns how many there were.  Called at
    the end of the Python process for a session that is still up."""
    paths, _WRITTEN[:] = list(_WRITTEN), []
    remove_paths(spark, paths)
    return len(paths)


class Scratch:
    """The tables that :func:`materialise` writes inside :func:`releasing`."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.kept = spark, [], []

    def drop_between(self) -> None:
        """Removes all but the first table written and the last."""
        self._remove(self.paths[1:-1])

    def drop_older(self) -> None:
        """Removes all but the last table written."""
        self._remove(self.paths[:-1])

    def keep(self, df: DataFrame) -> DataFrame:
        """The last table written stays until :func:`release`."""
        self.kept.append(self.paths.pop())
        return df

    def _remove(self, paths: list[str]) -> None:
        remove_paths(self.spark, paths)
        self.paths = [p for p in self.paths if p not in paths]
        _WRITTEN[:] = [p for p in _WRITTEN if p not in paths]


@contextmanager
def releasing(spark: SparkSession) -> Iterator[Scratch]:
    """Removes at its end what was written inside (by this thread), so that
    rounds and micro-batches do not pile up; what the block returns must be
    kept (:meth:`Scratch.keep`) or written elsewhere."""
    outer, scratch = getattr(_OPEN, "scratch", None), Scratch(spark)
    _OPEN.scratch = scratch
    try:
        yield scratch
    finally:
        _OPEN.scratch = outer
        scratch._remove(list(scratch.paths))
        if outer is not None:
            outer.paths += scratch.kept
        # Spark removes the shuffle files of frames that both sides have let go
        gc.collect()
        spark.sparkContext._jvm.System.gc()


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _WRITTEN and spark.sparkContext._jsc is not None:
        release(spark)


def bounded_collect(df: DataFrame, max_rows: int):
    """Rows of ``df`` if it has at most ``max_rows`` rows, else None; one
    job that never reads more than ``max_rows + 1`` rows."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
