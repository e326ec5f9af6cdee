"""Partial aggregates of a stream that stay few: batches are merged into one generation under a commit marker.

A store is a folder with three kinds of tables: ``batch/batch_id=<n>``, the partial aggregate of a batch;
``generation/<name>``, the merged state of all batches up to some number; and ``commit/upto=<n>``, one row that names the
generation, written when that is complete. A reader takes the newest committed generation and the batches behind it, so
a job lost at any point leaves the store as it was before or after the merge, never between. What a commit has
superseded is deleted afterwards; if that is lost too, the next merge does it. Readers must finish before two further
merges have passed, since a merge keeps the generation before its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.scratch import shuffles_dropped

COMMIT = T.StructType([T.StructField("generation", T.StringType()), T.StructField("upto", T.LongType())])


@dataclass(frozen=True)
class Store:
    """``schema``: the columns of a partial aggregate. ``merge`` brings the rows of several partial aggregates together, in
    any grouping: merging merged rows gives the same."""

    path: str
    schema: T.StructType
    merge: Callable[[DataFrame], DataFrame]

    def _folder(self, *parts: str) -> str:
        return "/".join([self.path.rstrip("/"), *parts])


def sums_store(path: str, schema: T.StructType, keys: list[str]) -> Store:
    """Sums by key; every column that is no key is added up. The declared types must have room for the totals."""
    values = [f for f in schema if f.name not in keys]

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in values]).select(*schema.names)

    return Store(path, schema, merge)


def set_store(path: str, schema: T.StructType) -> Store:
    """A set of rows: what several batches bring is kept once."""
    return Store(path, schema, lambda rows: rows.distinct())


def _children(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(path)] if system.exists(path) else []


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _numbers(names: list[str], prefix: str) -> list[int]:
    return sorted(int(name.removeprefix(prefix)) for name in names if name.startswith(prefix))


def commits(spark: SparkSession, store: Store) -> list[tuple[int, str]]:
    """(last batch, generation) of the committed merges, in order. A marker without its success file is not there yet."""
    done = []
    for upto in _numbers(_children(spark, store._folder("commit")), "upto="):
        folder = store._folder("commit", f"upto={upto}")
        if "_SUCCESS" in _children(spark, folder):
            done.append((upto, spark.read.schema(COMMIT).parquet(f"{folder}/*.parquet").first()["generation"]))
    return done


def write_batch(store: Store, rows: DataFrame, batch_id: int) -> None:
    """Store the partial aggregate of a batch; a retried batch replaces its own."""
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in store.schema])
    with shuffles_dropped(rows.sparkSession):
        store.merge(typed).write.mode("overwrite").parquet(store._folder("batch", f"batch_id={batch_id}"))


def _open_parts(spark: SparkSession, store: Store) -> tuple[int, list[str], list[int]]:
    """Last merged batch, folders of the generation and the batches behind it, and the numbers of these batches."""
    done = commits(spark, store)
    upto, generation = done[-1] if done else (-1, None)
    waiting = [n for n in _numbers(_children(spark, store._folder("batch")), "batch_id=") if n > upto]
    folders = [store._folder("generation", generation)] if generation else []
    return upto, folders + [store._folder("batch", f"batch_id={n}") for n in waiting], waiting


def read(spark: SparkSession, store: Store) -> DataFrame:
    """The state of all batches stored so far."""
    _, folders, _ = _open_parts(spark, store)
    rows = spark.read.schema(store.schema).parquet(*[f"{f}/*.parquet" for f in folders]) if folders else spark.createDataFrame([], store.schema)
    return store.merge(rows)


def merge_batches(spark: SparkSession, store: Store) -> int:
    """Merge all stored batches into a new generation and commit it; the number of batches merged.

    What older commits have superseded is deleted: their generations, and the batches that are part of this one.
    """
    upto, _, waiting = _open_parts(spark, store)
    if not waiting:
        return 0
    name = f"upto-{waiting[-1]}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        read(spark, store).write.parquet(store._folder("generation", name))
    marker = spark.createDataFrame([(name, waiting[-1])], COMMIT).coalesce(1)
    marker.write.mode("overwrite").parquet(store._folder("commit", f"upto={waiting[-1]}"))
    clean(spark, store)
    return len(waiting)


def clean(spark: SparkSession, store: Store) -> None:
    """Delete what the newest commit supersedes: all generations but its own and the one before, and the merged batches that
    the one before holds too. Only called by the one writer of the store."""
    done = commits(spark, store)
    if not done:
        return
    kept = {generation for _, generation in done[-2:]}
    for generation in _children(spark, store._folder("generation")):
        if generation not in kept:
            _delete(spark, store._folder("generation", generation))
    for upto, _ in done[:-2]:
        _delete(spark, store._folder("commit", f"upto={upto}"))
    merged = done[-2][0] if len(done) > 1 else -1
    for number in _numbers(_children(spark, store._folder("batch")), "batch_id="):
        if number <= merged:
            _delete(spark, store._folder("batch", f"batch_id={number}"))
