"""Aggregates of the fact table by period or other keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.functions.dates import periods
from storeloom.functions.money import REFUND, SALE, average, total


def sales_only(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("transaction_type") == SALE)


def refunds_only(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("transaction_type") == REFUND)


def sales_measures(fact: DataFrame, amount: str = "total_sales", count: str = "total_orders",
                   mean: str = "avg_order_value") -> list[Column]:
    """Total, number of lines and mean per line."""
    net = total(fact, "net_amount")
    return [net.alias(amount), F.count("order_number").alias(count),
            average(net, F.count("net_amount")).alias(mean)]


def refund_measures(fact: DataFrame) -> list[Column]:
    return [total(fact, "net_amount").alias("total_refunds"),
            total(fact, "restocking_fee").alias("total_restocking_fees"),
            F.count("order_number").alias("total_refund_orders")]


def sales_by_period(fact: DataFrame, keys: list[str]) -> DataFrame:
    return sales_only(fact).groupBy(*periods(F.col("order_date"), keys)).agg(*sales_measures(fact))


def refunds_by_period(fact: DataFrame, keys: list[str]) -> DataFrame:
    return refunds_only(fact).groupBy(*periods(F.col("order_date"), keys)).agg(*refund_measures(fact))
