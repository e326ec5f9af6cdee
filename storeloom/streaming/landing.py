"""Structured Streaming over landing files.

Each ``run_*`` function works off what has arrived and stops, so a scheduler can
call it as often as wanted; progress lives in the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.config import DEFAULT_RULES, Rules
from storeloom.functions.money import SALE, average
from storeloom.plans.sales import with_sales_category
from storeloom.streaming.generations import Store, merge_batches, read, set_store, sums_store, write_batch


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                   files_per_batch: int = 1000, glob: str | None = None) -> DataFrame:
    """New files below ``path`` as a stream with a declared schema. A CSV header that differs from it is an error; an
    unreadable line is kept whole in the column ``_corrupt_record`` if the schema has one."""
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True))
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def distinct_events(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within the delay; state is bounded by the watermark."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_totals(stream: DataFrame, event_time: str, value: str, keys: list[str],
                    width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Rows and totals per window and key; a window is emitted once the watermark closes it."""
    window = F.window(event_time, width)
    return (stream.withWatermark(event_time, delay)
            .groupBy(window.alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("total"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "events", "total"))


def run_to_table(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> None:
    """Append everything that has arrived to a table, exactly once."""
    writer = (stream.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(path).awaitTermination()


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand each new batch to ``handle``, which must be idempotent per batch number."""
    (stream.writeStream.foreachBatch(handle)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


DAILY_KEYS = ["order_date", "transaction_type"]
DAILY_SUMS = T.StructType([
    T.StructField("order_date", T.DateType()), T.StructField("transaction_type", T.StringType()),
    T.StructField("net_amount", T.DecimalType(38, 4)), T.StructField("restocking_fee", T.DecimalType(38, 4)),
    T.StructField("lines", T.LongType()), T.StructField("orders", T.LongType()), T.StructField("amounts", T.LongType())])
# Whom and what was sold on a day: the sets behind the distinct counts.
DAILY_MEMBERS = T.StructType([
    T.StructField("order_date", T.DateType()), T.StructField("transaction_type", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("member", T.StringType())])
MEMBERS = {"customer": "customer_name", "product": "product_code"}
MERGE_EVERY = 10


def daily_sums(path: str) -> Store:
    return sums_store(f"{path.rstrip('/')}/sums", DAILY_SUMS, DAILY_KEYS)


def daily_members(path: str) -> Store:
    return set_store(f"{path.rstrip('/')}/members", DAILY_MEMBERS)


def run_daily_partials(fact: DataFrame, path: str, checkpoint: str, merge_every: int = MERGE_EVERY) -> None:
    """Keep partial daily sums, and the distinct customers and products of each day, up to date.

    A batch writes its own partial aggregates; a retried batch replaces them. Late lines need no watermark: they add to
    their day whenever they come. Every ``merge_every`` batches the partials are merged into one generation, so the
    files to read stay as few as the days (and members) need, however many batches there were.
    """
    sums, members = daily_sums(path), daily_members(path)
    held = [(kind, column) for kind, column in MEMBERS.items() if column in fact.columns]

    def write(batch: DataFrame, batch_id: int) -> None:
        used = [*DAILY_KEYS, "net_amount", "restocking_fee", "order_number", *[column for _, column in held]]
        batch = batch.select(*[c for c in used if c in batch.columns]).persist()
        write_batch(sums, batch.groupBy(*DAILY_KEYS).agg(
            F.sum("net_amount").alias("net_amount"), F.sum("restocking_fee").alias("restocking_fee"), F.count(F.lit(1)).alias("lines"),
            (F.count("order_number") if "order_number" in batch.columns else F.count(F.lit(1))).alias("orders"),
            F.count("net_amount").alias("amounts")), batch_id)
        if held:
            pairs = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(column).alias("member")) for kind, column in held]))
            named = batch.select(*DAILY_KEYS, pairs.alias("m")).select(*DAILY_KEYS, "m.kind", "m.member")
            write_batch(members, named.filter(F.col("member").isNotNull()), batch_id)
        batch.unpersist()
        if (batch_id + 1) % merge_every == 0:
            merge_batches(batch.sparkSession, sums)
            merge_batches(batch.sparkSession, members)

    run_batches(fact, write, checkpoint)


def daily_totals(spark: SparkSession, path: str) -> DataFrame:
    """Daily sums merged from all partials; equal to the batch aggregate of all lines."""
    return read(spark, daily_sums(path)).select(*DAILY_KEYS, "net_amount", "restocking_fee", "lines")


def daily_insights(spark: SparkSession, path: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The daily insights of all lines that have arrived, from the merged partials alone: equal to ``sales.daily_insights``
    over the whole fact."""
    is_sale = F.col("transaction_type") == SALE
    days = read(spark, daily_sums(path)).filter(is_sale).select(
        "order_date", F.col("net_amount").alias("daily_sales"), F.col("orders").alias("daily_orders"),
        average(F.col("net_amount"), F.col("amounts")).alias("daily_avg_order"))
    counted = read(spark, daily_members(path)).filter(is_sale).groupBy(F.col("order_date").alias("day")).agg(
        F.count_if(F.col("kind") == "customer").alias("unique_customers"), F.count_if(F.col("kind") == "product").alias("unique_products"))
    joined = days.join(counted, F.col("order_date").eqNullSafe(F.col("day")), "left").drop("day")
    return with_sales_category(joined.fillna(0, ["unique_customers", "unique_products"]), rules)
