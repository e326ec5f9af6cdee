"""Exact percentiles and ranks without sorting a whole group in one task.

A decimal value is read as a 64-bit count of its smallest unit and cut into
three digits of at most 22 bits. Counting rows per digit is a map-side combined
aggregate with at most 2**22 groups, whatever the number of rows or the skew of
the values, and order statistics follow from running sums over those counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGIT_BITS = 21
_DIGIT_MASK = (1 << _DIGIT_BITS) - 1
DIGITS = ("d0", "d1", "d2")


def units(df: DataFrame, column: str) -> tuple[Column, int]:
    """A decimal or integer column as a count of its smallest unit, and its scale."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return (F.col(column) * F.lit(10 ** kind.scale)).cast("bigint"), kind.scale
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint"), 0
    raise TypeError(f"{column} must be a decimal or an integer, not {kind.simpleString()}")


def digits(value: Column) -> list[Column]:
    """High to low digit of a count of units; the high one carries the sign, so order is kept."""
    return [
        F.shiftright(value, 2 * _DIGIT_BITS),
        F.shiftright(value, _DIGIT_BITS).bitwiseAND(F.lit(_DIGIT_MASK)),
        value.bitwiseAND(F.lit(_DIGIT_MASK)),
    ]


def exact_percentiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Rows ``(probability, value)``: the value of rank ``ceil(p * n)``, NULLs left out.

    Each of the three passes reads only ``column`` and shuffles one count per
    digit. The running selection has one row per probability; that is the proven
    bound behind the broadcast. Give it a stored or staged frame.
    """
    value, scale = units(df, column)
    high, middle, low = digits(F.col("u"))
    data = df.select(value.alias("u")).filter(F.col("u").isNotNull()).select(
        high.alias("d0"), middle.alias("d1"), low.alias("d2"))

    counts = data.groupBy("d0").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    total = F.sum("n").over(Window.partitionBy("p"))
    wanted = F.greatest(F.lit(1), F.ceil(F.col("p") * total))
    chosen = _digit_of_rank(counts.withColumn("k", wanted), "d0", ["p"])
    for level in ("d1", "d2"):
        found = [name for name in ("d0", "d1") if name < level]
        counts = (data.join(F.broadcast(chosen), found)
                  .groupBy("p", "k", *found, level).agg(F.count(F.lit(1)).alias("n")))
        chosen = _digit_of_rank(counts, level, ["p", *found])

    value = (F.shiftleft("d0", 2 * _DIGIT_BITS)
             .bitwiseOR(F.shiftleft("d1", _DIGIT_BITS)).bitwiseOR(F.col("d2")))
    value = value.cast(T.DecimalType(19, 0)) * F.lit(Decimal(1).scaleb(-scale))
    kind = df.schema[column].dataType
    return chosen.select(F.col("p").alias("probability"), value.cast(kind).alias("value"))


def _digit_of_rank(counts: DataFrame, digit: str, keys: list[str]) -> DataFrame:
    """The digit in which row ``k`` falls, with ``k`` made relative to that digit."""
    upto = F.sum("n").over(Window.partitionBy("p").orderBy(digit)
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.col("upto") - F.col("n")
    return (counts.withColumn("upto", upto)
            .filter((F.col("upto") >= F.col("k")) & (before < F.col("k")))
            .select(*keys, digit, (F.col("k") - before).alias("k")))


def percentile_struct(df: DataFrame, column: str, lower: float, upper: float) -> Column:
    """Scalar subquery with fields ``lower`` and ``upper``; NULL fields without rows."""
    found = exact_percentiles(df, column, [lower, upper])
    pick = lambda p: F.max(F.when(F.col("probability") == p, F.col("value")))
    return found.agg(F.struct(pick(lower).alias("lower"), pick(upper).alias("upper")).alias("t")).scalar()


def percentile_struct_of_few(df: DataFrame, column: str, lower: float, upper: float) -> Column:
    """``percentile_struct`` for a frame whose rows are bounded whatever the data, such as one row a day: its values are
    sorted in one task, in one pass."""
    def rank(p: float) -> Column:
        return F.get("v", F.greatest(F.lit(1), F.ceil(F.lit(p) * F.size("v"))).cast("int") - 1)

    sorted_values = df.agg(F.array_sort(F.collect_list(column)).alias("v"))
    return sorted_values.select(F.struct(rank(lower).alias("lower"), rank(upper).alias("upper")).alias("t")).scalar()


def tier(value: Column, thresholds: Column, labels: tuple[str, str, str]) -> Column:
    """High, medium or low label by two thresholds."""
    return (F.when(value >= thresholds.getField("upper"), labels[0])
            .when(value >= thresholds.getField("lower"), labels[1])
            .otherwise(labels[2]))


def rank_within(df: DataFrame, group: str, column: str, name: str) -> DataFrame:
    """Add the descending ``rank`` of ``column`` within ``group``, ties sharing a rank.

    A window over the whole group would sort one hot group in one task. Here a
    row's rank is one plus the number of rows with a greater value, found digit
    by digit: every window partition holds distinct digits only, so at most
    2**22 rows. ``df`` is read twice; give it a staged frame. NULL ranks last.
    """
    value, _ = units(df, column)
    # As a struct the group is never NULL itself, so plain equality also pairs NULL groups.
    data = df.withColumns({"_group": F.struct(F.col(group)), "_units": F.coalesce(value, F.lit(-(1 << 63)))})
    high, middle, low = digits(F.col("_units"))
    values = (data.groupBy("_group", "_units").agg(F.count(F.lit(1)).alias("n"))
              .withColumns({"d0": high, "d1": middle, "d2": low}))
    mid = values.groupBy("_group", "d0", "d1").agg(F.sum("n").alias("n"))
    top = mid.groupBy("_group", "d0").agg(F.sum("n").alias("n"))

    top = top.select("_group", "d0", _greater("d0", ["_group"]).alias("above"))
    mid = mid.withColumn("inner", _greater("d1", ["_group", "d0"])).join(top, ["_group", "d0"])
    mid = mid.select("_group", "d0", "d1", (F.col("above") + F.col("inner")).alias("above"))
    values = values.withColumn("inner", _greater("d2", ["_group", "d0", "d1"])).join(mid, ["_group", "d0", "d1"])
    ranks = values.select("_group", "_units", (F.col("above") + F.col("inner") + 1).alias(name))
    return data.join(ranks, ["_group", "_units"]).select(*df.columns, name)


def _greater(digit: str, keys: list[str]) -> Column:
    """Rows whose digit is greater, among those equal in the digits before."""
    frame = (Window.partitionBy(*keys).orderBy(F.desc(digit))
             .rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.sum("n").over(frame), F.lit(0))

