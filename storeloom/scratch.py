"""Shared scratch space: stage an intermediate result as a written table.

Staging cuts lineage and lets several consumers read one computed result. The
files live in the folder the cluster names in ``spark.checkpoint.dir``, so they
survive lost executors. Large ones that nothing reads any more go by ``unstage``. The shuffle files that made a table go once it is written, instead of when
the driver happens to collect garbage, so the disk holds the shuffles of one job at a time.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folder chosen for a local session that names none, by application.
_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder the session names; a local session may leave it unset and gets one of its own."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="storeloom-")
    return _local_roots[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the application's folder in the shared space."""
    return f"{scratch_root(spark)}/storeloom-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each job that is started within go when it ends. For jobs that write their result."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared space and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(staged: DataFrame) -> None:
    """Delete the files of a table from ``stage`` that nothing will read any more."""
    spark = staged.sparkSession
    for file in staged.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).getParent()
        if f"/storeloom-{spark.sparkContext.applicationId}/" not in folder.toString():
            raise ValueError(f"{folder} is no staged table")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
