"""Row numbers and first rows of groups of any size, without a group in one task.

``ranking.top_per_group`` serves small ``k``: Spark limits each group before the shuffle. Beyond that limit a window sorts a
whole group in one task. Here a group is cut at the value of its k-th row, found by counting digits, and what is left is
numbered over range partitions, so a group takes as many tasks as it needs.

Defined cases: a NULL group is a group; a NULL value ranks last. Rows that are equal in group and order stand together
in one task and their order is not defined, so give an order that tells rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeloom.operators.order_statistics import DIGITS, digits, units
from storeloom.scratch import stage

BROADCAST_GROUPS = 100_000
_LEAST = -(1 << 63)


def row_numbers(df: DataFrame, group: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """All rows with their number within their group, from 1.

    Ranges are cut by group and order, so rows of a range follow those of the range before; a row's number is its place
    within the range plus the rows of its group in earlier ranges. The offsets have one row per group and range.
    """
    keyed = df.withColumn("_group", F.struct(*[F.col(g) for g in group]))
    ranges = keyed.repartitionByRange(F.col("_group"), *order).withColumn("_range", F.spark_partition_id())
    placed = stage(ranges, "ranges")
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_range", "_group").agg(F.count(F.lit(1)).alias("_n"))
               .select("_range", "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    within = F.row_number().over(Window.partitionBy("_range", "_group").orderBy(*order))
    numbered = placed.withColumn("_within", within).join(offsets, ["_range", "_group"])
    return numbered.select(*df.columns, (F.col("_before") + F.col("_within")).alias(name))


def _cut_digit(counts: DataFrame, digit: str, found: list[str]) -> DataFrame:
    """The digit in which row ``k`` of a group falls, counted from the greatest, with ``k`` made relative to it."""
    upto = F.sum("n").over(Window.partitionBy("_group").orderBy(F.desc(digit))
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.col("upto") - F.col("n")
    return (counts.withColumn("upto", upto).filter((F.col("upto") >= F.col("k")) & (before < F.col("k")))
            .select("_group", *found, digit, (F.col("k") - before).alias("k")))


def _cuts(data: DataFrame, k: int) -> DataFrame:
    """(_group, cut): the value of row ``k`` in units, greatest first; groups with fewer rows have none.

    Window partitions hold distinct digits only, whatever the number of rows.
    """
    split = dict(zip(DIGITS, digits(F.col("_units")), strict=True))
    values = stage(data.groupBy("_group", "_units").agg(F.count(F.lit(1)).alias("n")).withColumns(split), "value-counts")
    chosen = values.withColumn("k", F.lit(k).cast("long"))
    for level, digit in enumerate(DIGITS):
        found = list(DIGITS[:level])
        if found:
            chosen = values.join(chosen, ["_group", *found])
        counts = chosen.groupBy("_group", "k", *found, digit).agg(F.sum("n").alias("n"))
        chosen = _cut_digit(counts, digit, found)
    return values.join(chosen, ["_group", *DIGITS]).select("_group", F.col("_units").alias("_cut"))


def top_by_value(df: DataFrame, group: list[str], column: str, ties: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The ``k`` rows of each group with the greatest ``column`` (a decimal or an integer), with their row number.

    Rows below the value of the k-th are dropped first, so what is sorted is ``k`` rows and the ties of the last one. ``df``
    is read twice; give it a stored or staged frame.
    """
    value, _ = units(df, column)
    data = df.withColumns({"_group": F.struct(*[F.col(g) for g in group]), "_units": F.coalesce(value, F.lit(_LEAST))})
    cuts = stage(_cuts(data, k), "value-cuts")
    few = cuts.count() <= BROADCAST_GROUPS
    reached = F.col("_cut").isNull() | (F.col("_units") >= F.col("_cut"))
    kept = data.join(F.broadcast(cuts) if few else cuts, "_group", "left").filter(reached).select(*df.columns)
    return row_numbers(kept, group, [F.desc_nulls_last(column), *ties], name).filter(F.col(name) <= k)
