"""Customer tables: segments and top customers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.config import DEFAULT_RULES, Rules
from storeloom.functions.money import rate
from storeloom.operators.joins import with_contacts_of_few
from storeloom.operators.order_statistics import percentile_struct, tier
from storeloom.operators.periods import sales_measures, sales_only
from storeloom.operators.ranking import top_overall
from storeloom.scratch import stage

VALUE_LABELS = ("High Value", "Medium Value", "Low Value")
CONTACT_COLUMNS = ["email", "phone", "city", "state"]


def customer_spend(fact: DataFrame) -> DataFrame:
    return sales_only(fact).groupBy("customer_name").agg(
        *sales_measures(fact, "total_spent"), F.max("order_date").alias("last_order_date"))


def customer_segments(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Two segments by one spending threshold."""
    high = F.col("total_spent") >= rate(rules.high_value_customer)
    return customer_spend(fact).withColumn(
        "customer_segment", F.when(high, "High Value").otherwise("Regular"))


def tiered_customer_segments(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Three segments by two fixed thresholds."""
    spent = F.col("total_spent")
    segment = (F.when(spent >= rate(rules.high_value_customer), VALUE_LABELS[0])
               .when(spent >= rate(rules.medium_value_customer), VALUE_LABELS[1])
               .otherwise(VALUE_LABELS[2]))
    return customer_spend(fact).withColumn("customer_segment", segment)


def percentile_customer_segments(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Three segments by the percentiles of spending.

    The metrics are staged: the thresholds and the result both read them, and
    the fact is scanned once.
    """
    metrics = sales_only(fact).groupBy("customer_name").agg(
        *sales_measures(fact, "total_spent"), F.max("order_date").alias("last_order_date"),
        F.count_distinct("product_code").alias("unique_products_purchased"))
    staged = stage(metrics, "customer_metrics")
    cuts = percentile_struct(staged, "total_spent", rules.lower_percentile, rules.upper_percentile)
    return staged.withColumn("customer_segment", tier(F.col("total_spent"), cuts, VALUE_LABELS))


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("count"))


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best buyers with their contact columns; at most one dimension row each."""
    spend = sales_only(fact).groupBy("customer_name", "phone_number", "address").agg(
        *sales_measures(fact, "total_spent"))
    order = [F.desc("total_spent"), F.asc("customer_name"), F.asc("phone_number"), F.asc("address")]
    best = top_overall(spend, order, k)
    return with_contacts_of_few(best, dim_customer, CONTACT_COLUMNS)


def top_customers_with_segment(fact: DataFrame, dim_customer: DataFrame, k: int = 10,
                               rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The ``k`` best customers by name with e-mail and percentile segment."""
    segments = percentile_customer_segments(fact, rules)
    best = top_overall(segments, [F.desc("total_spent"), F.asc("customer_name")], k)
    return with_contacts_of_few(best, dim_customer, ["email"]).select(
        "customer_name", "email", "total_spent", F.col("total_orders").alias("order_count"), "customer_segment")


def spending_threshold(value: int | str | Decimal) -> Rules:
    """Rules with another threshold for a high-value customer."""
    return Rules(high_value_customer=Decimal(str(value)))
