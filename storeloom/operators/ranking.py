"""Top rows per group and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                  name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their row number.

    The filter on the rank is turned into a group limit on the map side, so at
    most ``k`` rows per group and task are shuffled.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(name, rank).filter(F.col(name) <= k)


def top_overall(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, order: list[Column], rows: int) -> DataFrame:
    """A repeatable sample for display: the first rows under a given order."""
    return top_overall(df, order, rows)
