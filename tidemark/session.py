"""Session set-up, reliable materialisation and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. Sizes (executors, shuffle partitions,
# memory) belong to the cluster's own configuration and are left alone.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """Return a session with adaptive execution on and a UTC clock."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a session of one machine (``local`` and ``local[n]``, not ``local-cluster``) without that
    setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it as a Parquet table in the shared folder.

    Used where a plan reads the same intermediate result twice and both reads
    must see identical rows (range blocks, float sums used as join keys). It
    cuts the lineage, so losing an executor loses nothing, and unlike an RDD
    checkpoint it is read column by column, with filters pushed down and its
    size known to the planner. The table goes when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    delete_at_exit(spark, path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Inside, workers get at most ``rows`` rows at a time: for whole texts, of which the usual batches hold tens of MB.

    This counts when a table is computed, not when it is declared, so :func:`materialize` belongs inside too.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(table: DataFrame) -> None:
    """Delete what :func:`materialize` stored, before the session ends; nothing may read it any more."""
    if path := getattr(table, "_stored_at", None):
        delete_path(table.sparkSession, path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table under the shared folder."""
    return os.path.join(shared_folder(spark), "tidemark-scratch", f"{name}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def completed_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the subfolders of ``path`` that were written to their end, ascending."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit() and system.exists(hadoop.Path(f"{path}/{n}/_SUCCESS")))
