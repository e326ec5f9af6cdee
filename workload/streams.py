"""Incremental ingestion and aggregates over the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from storeloom import schemas
from storeloom.plans import star
from storeloom.scratch import scratch_dir
from storeloom.sources import files
from storeloom.sources import retail_views as views
from storeloom.streaming import landing
from workload.registry import ORACLES, RUN_TIME, doubles, query
from workload.storage import land_transactions


@query("doc_10_stream_ingest", """
    SELECT ORDERNUMBER, PRODUCTCODE, TOTAL_AMOUNT, TERRITORY, '2024-01-31' AS partition_date FROM transactions""")
def stream_ingest(spark, d):
    arrived = landing.landing_stream(spark, land_transactions(spark, d), schemas.TRANSACTIONS, files_per_batch=4)
    raw, checkpoint = scratch_dir(spark, "raw"), scratch_dir(spark, "checkpoint")
    stamped = files.with_partition_day(files.with_lineage(arrived, RUN_TIME))
    landing.run_to_table(stamped, raw, checkpoint, partition_by=["partition_date"])
    return spark.read.parquet(raw).select("ORDERNUMBER", "PRODUCTCODE", "TOTAL_AMOUNT", "TERRITORY",
                                          F.col("partition_date").cast("string").alias("partition_date"))


@query("doc_10_stream_daily_totals", """
    SELECT order_date, transaction_type, CAST(sum(net_amount) AS DOUBLE) AS net_amount,
           CAST(sum(restocking_fee) AS DOUBLE) AS restocking_fee, count(*) AS lines
    FROM fact GROUP BY order_date, transaction_type""")
def stream_daily_totals(spark, d):
    arrived = landing.landing_stream(spark, land_transactions(spark, d), schemas.TRANSACTIONS, files_per_batch=4)
    partials, checkpoint = scratch_dir(spark, "partials"), scratch_dir(spark, "checkpoint")
    landing.run_daily_partials(star.fact_transactions(arrived, run_time=RUN_TIME), partials, checkpoint)
    return doubles(landing.daily_totals(spark, partials))


@query("doc_10_stream_daily_insights", ORACLES["anl_13_daily_insights"], views=False)
def stream_daily_insights(spark, d):
    """The daily insights kept up to date by a stream of many small batches, merged every few of them."""
    landed = land_transactions(spark, d, files=9, compression="gzip")
    # Two of nine files a batch; more files only make the batches larger.
    n_files = files.input_files(spark, landed, "*.csv.gz").count()
    arrived = landing.landing_stream(spark, landed, schemas.TRANSACTIONS, files_per_batch=max(2, 2 * n_files // 9))
    partials, checkpoint = scratch_dir(spark, "partials"), scratch_dir(spark, "checkpoint")
    landing.run_daily_partials(star.fact_transactions(arrived, run_time=RUN_TIME), partials, checkpoint, merge_every=2)
    return doubles(landing.daily_insights(spark, partials))


def _event_files(spark, d, repeats: int = 1) -> str:
    """The events as several landing files, each event ``repeats`` times."""
    path = scratch_dir(spark, "landing-events")
    events = views.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(repeats):
        events.write.mode("append").parquet(path)
    return path


@query("doc_10_stream_windows", """
    WITH days AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS events,
                         CAST(sum(CAST(value AS DECIMAL(14,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2)
    SELECT CAST(day AS DATE) AS window_start, CAST(day + INTERVAL 1 DAY AS DATE) AS window_end, event_type, events, total
    FROM days WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def stream_windows(spark, d):
    path = _event_files(spark, d)
    schema = spark.read.parquet(path).schema
    arrived = landing.landing_stream(spark, path, schema, fmt="parquet").withColumn(
        "value", F.col("value").cast(schemas.MONEY))
    out, checkpoint = scratch_dir(spark, "windows"), scratch_dir(spark, "checkpoint")
    landing.run_to_table(landing.windowed_totals(arrived, "ts", "value", ["event_type"]), out, checkpoint)
    closed = spark.read.parquet(out)
    return doubles(closed.withColumns({c: F.to_date(c) for c in ("window_start", "window_end")}))


@query("doc_10_stream_distinct", "SELECT event_id, user_id, event_type FROM events")
def stream_distinct(spark, d):
    path = _event_files(spark, d, repeats=2)
    schema = spark.read.parquet(path).schema
    arrived = landing.landing_stream(spark, path, schema, fmt="parquet")
    out, checkpoint = scratch_dir(spark, "distinct"), scratch_dir(spark, "checkpoint")
    landing.run_to_table(landing.distinct_events(arrived, ["event_id"], "ts", "60 days"), out, checkpoint)
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")
