"""Tables written to the folder that all executors share.

A long job cuts its lineage by writing an intermediate result once and reading it back as parquet.
Such a table outlives any executor, keeps its columns prunable and is read by several branches of a plan
without being computed again.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; in a local session without one, a temporary folder is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="qirtas-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it. Removed when the driver ends."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. What is written there is removed when the driver ends."""
    path = f"{shared_dir(spark)}/qirtas-{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove)
    _written.append((spark, path))
    return path


def _remove() -> None:
    for spark, path in _written:
        try:
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # noqa: BLE001 - the session may already be gone, or this path; the others still count
            continue
