"""Union and deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all frames; a column that a frame lacks is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first under ``order``.

    The rank filter becomes a group limit before the shuffle, so each map task
    sends at most one row per key however often a key repeats.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_row", rank).filter(F.col("_row") == 1).drop("_row")


def dedup_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts before and after deduplication, in one aggregate."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
                      F.count(F.lit(1)).alias("rows_after"))
