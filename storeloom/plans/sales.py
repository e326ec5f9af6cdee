"""Sales and refund tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.config import DEFAULT_RULES, Rules
from storeloom.functions.dates import day_text, periods
from storeloom.functions.money import REFUND, SALE, average, refund_split, total
from storeloom.functions.text import product_family
from storeloom.operators.joins import with_fiscal_day
from storeloom.operators.order_statistics import percentile_struct_of_few, tier
from storeloom.operators.periods import refunds_by_period, refunds_only, sales_by_period, sales_measures, sales_only
from storeloom.scratch import stage

DAY_LABELS = ("High Sales Day", "Medium Sales Day", "Low Sales Day")
ALL_PERIODS = ["year", "quarter", "month", "week"]
FISCAL_KEYS = ["FISCAL_YEAR", "FISCAL_QUARTER", "FISCAL_MONTH_NAME"]


def sales_analytics(fact: DataFrame) -> DataFrame:
    return sales_by_period(fact, ALL_PERIODS)


def refunds_analytics(fact: DataFrame) -> DataFrame:
    return refunds_by_period(fact, ALL_PERIODS)


def weekly_sales(fact: DataFrame) -> DataFrame:
    return sales_by_period(fact, ["year", "week"])


def monthly_sales(fact: DataFrame) -> DataFrame:
    return sales_by_period(fact, ["year", "month"])


def quarterly_sales(fact: DataFrame) -> DataFrame:
    return sales_by_period(fact, ["year", "quarter"])


def weekly_refunds(fact: DataFrame) -> DataFrame:
    return refunds_by_period(fact, ["year", "week"])


def monthly_refunds(fact: DataFrame) -> DataFrame:
    return refunds_by_period(fact, ["year", "month"])


def quarterly_refunds(fact: DataFrame) -> DataFrame:
    return refunds_by_period(fact, ["year", "quarter"])


PERIOD_KEYS = {"analytics": ALL_PERIODS, "weekly": ["year", "week"], "monthly": ["year", "month"], "quarterly": ["year", "quarter"]}


def period_tables(fact: DataFrame) -> dict[str, DataFrame]:
    """The eight sales and refund tables from one scan of the fact.

    All measures are sums and counts, so the finest table (one row per year, quarter, month, week and type, a number that
    follows from the calendar) is staged once and rolled up; grouping sets would send every line four times.
    """
    finest = fact.groupBy("transaction_type", *periods(F.col("order_date"), ALL_PERIODS)).agg(
        total(fact, "net_amount").alias("amount"), total(fact, "restocking_fee").alias("fees"),
        F.count("order_number").alias("lines"), F.count("net_amount").alias("amounts"))
    parts = stage(finest, "periods")
    amount = F.sum("amount")
    sold = [amount.alias("total_sales"), F.sum("lines").alias("total_orders"), average(amount, F.sum("amounts")).alias("avg_order_value")]
    returned = [amount.alias("total_refunds"), F.sum("fees").alias("total_restocking_fees"), F.sum("lines").alias("total_refund_orders")]
    sales = {f"sales_{n}" if n == "analytics" else f"{n}_sales": sales_only(parts).groupBy(*k).agg(*sold) for n, k in PERIOD_KEYS.items()}
    refunds = {f"refunds_{n}" if n == "analytics" else f"{n}_refunds": refunds_only(parts).groupBy(*k).agg(*returned)
               for n, k in PERIOD_KEYS.items()}
    return sales | refunds


def product_family_sales(fact: DataFrame) -> DataFrame:
    family = product_family(F.col("product_code")).alias("product_family")
    return sales_only(fact).groupBy(family).agg(*sales_measures(fact)).orderBy(
        F.desc("total_sales"), "product_family")


def family_quantities(fact: DataFrame) -> DataFrame:
    """Items sold by product family."""
    family = product_family(F.col("product_code")).alias("product_family")
    return sales_only(fact).groupBy(family).agg(F.sum("quantity").alias("items_sold"))


def daily_insights(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per day: sales, lines, mean, distinct customers and products, and a category."""
    days = sales_only(fact).groupBy("order_date").agg(
        *sales_measures(fact, "daily_sales", "daily_orders", "daily_avg_order"),
        F.count_distinct("customer_name").alias("unique_customers"),
        F.count_distinct("product_code").alias("unique_products"))
    return with_sales_category(days, rules)


def with_sales_category(days: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The days with their date as text and a category by the percentiles of their sales."""
    staged = stage(days.select(day_text(F.col("order_date")).alias("order_date_str"),
                               *[c for c in days.columns if c != "order_date"]), "daily_metrics")
    cuts = percentile_struct_of_few(staged, "daily_sales", rules.lower_percentile, rules.upper_percentile)
    return staged.withColumn("sales_category", tier(F.col("daily_sales"), cuts, DAY_LABELS))


def fiscal_aggregations(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales by fiscal month. Days outside the calendar form the NULL group.

    Sales are summed per day before the calendar join, so the join sees one row
    per day instead of every line.
    """
    days = sales_only(fact).groupBy("order_date").agg(
        total(fact, "net_amount").alias("amount"), F.count("order_number").alias("lines"),
        F.count("net_amount").alias("amounts"))
    amount = F.sum("amount")
    return (with_fiscal_day(days, calendar.select("CALENDAR_DATE", *FISCAL_KEYS))
            .groupBy(*FISCAL_KEYS)
            .agg(amount.alias("fiscal_sales"), F.sum("lines").alias("fiscal_orders"),
                 average(amount, F.sum("amounts")).alias("fiscal_avg_order"))
            .orderBy("FISCAL_YEAR", "FISCAL_QUARTER", "FISCAL_MONTH_NAME"))


def transaction_type_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("count"))


def territory_revenue(fact: DataFrame) -> DataFrame:
    return sales_only(fact).groupBy("territory").agg(
        total(fact, "net_amount").alias("total_revenue")).orderBy(
        F.desc("total_revenue"), "territory")


def monthly_summary(fact: DataFrame) -> DataFrame:
    """Per month: sales, refunds, items sold and refunded, fees, distinct customers."""
    is_sale = F.col("transaction_type") == SALE
    is_refund = F.col("transaction_type") == REFUND
    keys = periods(F.col("order_date"), ["year", "month"])
    months = fact.groupBy(keys[0].alias("year_number"), keys[1].alias("month_number"))
    return months.agg(
        total(fact, "net_amount", is_sale).alias("total_sales"),
        total(fact, "net_amount", is_refund).alias("total_refunds"),
        F.sum(F.when(is_sale, F.col("quantity"))).alias("items_sold"),
        F.sum(F.when(is_refund, F.col("quantity"))).alias("items_refunded"),
        total(fact, "restocking_fee").alias("total_restocking_fees"),
        F.count_distinct("customer_name").alias("unique_customers"))


def refund_analysis(fact: DataFrame, fee_rate: Decimal = Decimal("0.10")) -> DataFrame:
    """Every line with the refund split of its signed amount."""
    flagged = fact.withColumn("is_refund", F.col("transaction_type") == REFUND)
    split = flagged.withColumn("refund_calculation",
                               refund_split(F.col("total_amount"), F.col("is_refund"), fee_rate))
    return split.select("*", F.col("refund_calculation.final_amount").alias("calculated_final_amount"),
                        F.col("refund_calculation.restocking_fee").alias("calculated_restocking_fee"))
