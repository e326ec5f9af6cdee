"""Stored tables: full refresh, refresh by partition, row counts without a second job.

A plain Parquet overwrite is not atomic and must not target a path that the
same plan reads; write to a fresh path instead, or pass a table format with
transactions as ``fmt``.
"""

from __future__ import annotations

from collections.abc import Mapping

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storeloom.operators.history import retained
from storeloom.sources.tables import read_table

ANALYTICS_PREFIX = "analytics_"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, merge_schema: bool = False) -> int:
    """Write ``df`` and return the number of rows written, observed during the write.

    With partition columns, rows are rebalanced by them first: files stay few,
    and a partition that holds most rows is split over several tasks.
    """
    written = Observation()
    observed = df
    if partition_by:
        observed = observed.hint("rebalance", *partition_by)
    writer = observed.observe(written, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if merge_schema:
        writer = writer.option("mergeSchema", True)
    writer.save(path)
    return written.get["rows"]


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> int:
    """Overwrite only the partitions that ``df`` holds, so a rerun replaces its own day."""
    written = Observation()
    (df.hint("rebalance", *partition_by)
     .observe(written, F.count(F.lit(1)).alias("rows"))
     .write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).save(path))
    return written.get["rows"]


def purge_table(spark: SparkSession, path: str, target: str, day: str, as_of: date | Column, keep_days: int,
                fmt: str = "parquet", partition_by: list[str] | None = None) -> int:
    """Write a stored table without its expired rows to ``target``, a fresh path, and return the number of rows kept.

    The old path is left for the caller to swap and delete once the new one is in use, so a lost job loses nothing.
    """
    if path.rstrip("/") == target.rstrip("/"):
        raise ValueError("a table cannot be purged into the path it is read from")
    return write_table(retained(read_table(spark, path, fmt), day, as_of, keep_days), target, fmt, "error", partition_by)


def write_analytics(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, int]:
    """Write each table as ``analytics_<name>`` below ``root``; rows written by table name."""
    return {name: write_table(df, f"{root.rstrip('/')}/{ANALYTICS_PREFIX}{name}", fmt)
            for name, df in tables.items()}
