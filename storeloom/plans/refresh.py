"""The full refresh: ingest, gate, star schema, analytics.

Stages hand over through stored tables, so each result is computed once and a
failed stage can be rerun alone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.config import DEFAULT_RULES, DEFAULT_THRESHOLDS, QualityThresholds, Rules
from storeloom.operators import quality
from storeloom.plans import customers, products, sales, star
from storeloom.sinks.tables import replace_partitions, write_analytics, write_table
from storeloom.sources import files
from storeloom.sources.tables import read_table

ENTITIES = ("customers", "transactions", "calendar")


def ingest(spark: SparkSession, landing: str, raw: str, run_time: datetime, fmt: str = "parquet") -> dict[str, int]:
    """Landing files to raw tables, partitioned by ingestion day. Rows written by table."""
    frames = {
        "customers": files.clean_customers(spark, f"{landing}/customers", run_time),
        "transactions": files.raw_transactions(spark, f"{landing}/transactions", run_time),
        "calendar": files.raw_calendar(spark, f"{landing}/calendar", run_time),
    }
    rows = {name: replace_partitions(files.with_partition_day(df), f"{raw}/{name}", ["partition_date"], fmt)
            for name, df in frames.items()}
    # The whole partition is written, so the rejects of an earlier run of the day go even if there are none now.
    rejects = files.rejected_customers(spark, f"{landing}/customers", run_time)
    rows["rejected_customers"] = write_table(rejects, f"{raw}/rejected_customers/partition_date={run_time.date()}", fmt)
    return rows


def raw_tables(spark: SparkSession, raw: str, run_time: datetime, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The raw tables of one ingestion day; only that partition is read."""
    day = F.lit(run_time.date())
    return {name: read_table(spark, f"{raw}/{name}", fmt).filter(F.col("partition_date").cast("date") == day)
            for name in ENTITIES}


def gate(raw: dict[str, DataFrame], suites: dict[str, tuple] | None = None,
         thresholds: QualityThresholds = DEFAULT_THRESHOLDS) -> None:
    """Run the suites over the lines that could be read and raise on the first entity with an error-level failure.

    Unreadable lines go to the reject tables, so they fail no other check; too large a share of them is a failure of its own.
    """
    suites = suites or {
        "customers": (*quality.CUSTOMER_SUITE, quality.email_format()),
        "transactions": quality.TRANSACTION_SUITE,
        "calendar": quality.CALENDAR_SUITE,
    }
    for name, checks in suites.items():
        if files.CORRUPT_COLUMN in raw[name].columns:
            quality.enforce(quality.evaluate(raw[name].withColumn("readable", F.when(F.col(files.CORRUPT_COLUMN).isNull(), True)),
                                             (quality.not_null("readable", min_ratio=1 - thresholds.rejected_share),)))
        quality.enforce(quality.evaluate(files.good_lines(raw[name]), checks))


def model(raw: dict[str, DataFrame], processed: str, run_time: datetime, rules: Rules = DEFAULT_RULES,
          fmt: str = "parquet") -> dict[str, int]:
    """Dimensions, fact and segments to the processed zone, unreadable lines to a table of their own. Rows written by
    table."""
    spark = raw["transactions"].sparkSession
    rejects = {f"rejected_{name}": files.rejected_lines(df) for name, df in raw.items() if files.CORRUPT_COLUMN in df.columns}
    raw = {name: files.good_lines(df) for name, df in raw.items()}
    tables = {
        "dim_customer": star.dim_customer(raw["customers"]),
        "dim_product": star.dim_product(raw["transactions"], run_time),
        "dim_calendar": star.dim_calendar(raw["calendar"], run_time),
        "fact_transactions": star.fact_transactions(raw["transactions"], rules, run_time),
        **rejects,
    }
    rows = {name: write_table(df, f"{processed}/{name}", fmt) for name, df in tables.items()}
    fact = read_table(spark, f"{processed}/fact_transactions", fmt)
    segments = customers.customer_segments(fact, rules).withColumn("created_date", files.run_clock(run_time))
    rows["customer_segments"] = write_table(segments, f"{processed}/customer_segments", fmt)
    return rows


def analytics_tables(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The stored analytics set. Give it the stored fact: each table reads its own columns."""
    return {
        "sales_analytics": sales.sales_analytics(fact),
        "refunds_analytics": sales.refunds_analytics(fact),
        "product_family_sales": sales.product_family_sales(fact),
        "regional_rankings": products.regional_rankings(fact),
        "enhanced_customer_segments": customers.percentile_customer_segments(fact, rules),
        "daily_insights": sales.daily_insights(fact, rules),
    }


def analyse(spark: SparkSession, processed: str, run_time: datetime, rules: Rules = DEFAULT_RULES,
            fmt: str = "parquet") -> dict[str, int]:
    """Write the analytics tables from the stored fact. Rows written by table."""
    fact = read_table(spark, f"{processed}/fact_transactions", fmt)
    stamped = {name: df.withColumn("created_date", files.run_clock(run_time))
               for name, df in analytics_tables(fact, rules).items()}
    return write_analytics(stamped, processed, fmt)


def refresh(spark: SparkSession, landing: str, raw: str, processed: str, run_time: datetime,
            rules: Rules = DEFAULT_RULES, suites: dict[str, tuple] | None = None,
            fmt: str = "parquet", thresholds: QualityThresholds = DEFAULT_THRESHOLDS) -> dict[str, int]:
    """One full run. The gate stands between the raw and the processed zone."""
    rows = ingest(spark, landing, raw, run_time, fmt)
    tables = raw_tables(spark, raw, run_time, fmt)
    gate(tables, suites, thresholds)
    rows |= model(tables, processed, run_time, rules, fmt)
    rows |= analyse(spark, processed, run_time, rules, fmt)
    return rows
