"""Quality metrics as stored states: a new delivery scans only itself, the metrics of everything come from merging.

Two kinds of states are kept below a folder, each in a store of merged partial aggregates with commit markers. ``passes``
has for every scan metric the rows seen and the rows that pass. ``values/<column>`` has every value of a column with its
number of rows; uniqueness, distinctness and the column profile follow from it exactly, whatever the deliveries share.
Each metric is taken from one store, so a delivery that is half recorded never mixes old and new counts within a metric.

Defined cases: NULL is a value of its own in ``values`` and counts as a repeat of nothing; no deliveries give the metrics
of an empty frame. Deliveries are numbered upwards; recording a number again replaces it as long as it is not merged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.operators.combine import union_by_name
from storeloom.operators.quality import Check, passing_rows, share, verdict
from storeloom.streaming import generations
from storeloom.streaming.generations import Store

PASSES = T.StructType([T.StructField("metric", T.StringType()), T.StructField("column", T.StringType()),
                       T.StructField("pattern", T.StringType()), T.StructField("rows", T.LongType()),
                       T.StructField("passing", T.LongType())])


def passes_store(path: str) -> Store:
    return generations.sums_store(f"{path}/passes", PASSES, ["metric", "column", "pattern"])


def values_store(path: str, field: T.StructField) -> Store:
    schema = T.StructType([T.StructField("value", field.dataType), T.StructField("n", T.LongType())])
    return generations.sums_store(f"{path}/values/{field.name}", schema, ["value"])


def _scans(checks: list[Check]) -> list[Check]:
    return [c for c in checks if c.metric != "uniqueness"]


def _stores(path: str, fields: T.StructType) -> list[Store]:
    return [*[values_store(path, f) for f in fields], passes_store(path)]


def record(df: DataFrame, path: str, number: int, checks: list[Check], columns: list[str]) -> None:
    """Store the states of one delivery: one pass for all scan metrics, one group-by for each of ``columns``."""
    for name in columns:
        counts = df.groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        generations.write_batch(values_store(path, df.schema[name]), counts, number)
    measured = {(c.metric, c.column, c.pattern): passing_rows(c) for c in _scans(checks)}
    if measured:
        one = df.agg(F.count(F.lit(1)).alias("rows"), *[p.alias(f"p{i}") for i, p in enumerate(measured.values())])
        rows = F.array(*[F.struct(*[F.lit(x).cast("string").alias(n) for n, x in zip(PASSES.names, key, strict=False)],
                                  F.col("rows"), F.col(f"p{i}").alias("passing")) for i, key in enumerate(measured)])
        generations.write_batch(passes_store(path), one.select(F.inline(rows)), number)


def merge(spark: SparkSession, path: str, fields: T.StructType) -> None:
    """Merge the recorded deliveries, so the files to read do not grow with them."""
    for store in _stores(path, fields):
        generations.merge_batches(spark, store)


def evaluate(spark: SparkSession, path: str, checks: list[Check], fields: T.StructType) -> DataFrame:
    """The same rows as ``quality.evaluate`` over all deliveries together, from their states."""
    frames = []
    scans = _scans(checks)
    if scans:
        def seen(check: Check, count: str) -> Column:
            mine = [F.col(n).eqNullSafe(F.lit(x).cast("string")) for n, x in
                    zip(PASSES.names, (check.metric, check.column, check.pattern), strict=False)]
            return F.coalesce(F.sum(F.when(reduce(Column.__and__, mine), F.col(count))), F.lit(0))

        values = generations.read(spark, passes_store(path)).agg(*[
            (seen(c, "passing").cast("double") if c.metric == "size" else share(seen(c, "passing"), seen(c, "rows"))).alias(f"m{i}")
            for i, c in enumerate(scans)])
        frames.append(values.select(F.inline(F.array(*[verdict(c, F.col(f"m{i}")) for i, c in enumerate(scans)]))))
    for check in checks:
        if check.metric == "uniqueness":
            counts = generations.read(spark, values_store(path, fields[check.column])).filter(F.col("value").isNotNull())
            value = counts.agg(share(F.count_if(F.col("n") == 1), F.sum("n")).alias("value"))
            frames.append(value.select(F.inline(F.array(verdict(check, F.col("value"))))))
    return union_by_name(frames)


def profile(spark: SparkSession, path: str, fields: T.StructType) -> DataFrame:
    """The rows of ``quality.profile_columns`` over all deliveries, and ``unique_ratio``: distinct values, NULL as one,
    over rows, as ``quality.profile_rules`` has it."""
    rows, filled = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
    return union_by_name([
        generations.read(spark, values_store(path, field)).agg(
            F.lit(field.name).alias("column_name"), rows.alias("row_count"), (rows - filled).alias("null_count"),
            F.count("value").alias("distinct_count"), share(filled, rows).alias("completeness"),
            F.min("value").cast("string").alias("min_value"), F.max("value").cast("string").alias("max_value"),
            F.coalesce(F.try_divide(F.count(F.lit(1)).cast("double"), rows.cast("double")), F.lit(0.0)).alias("unique_ratio"))
        for field in fields])
