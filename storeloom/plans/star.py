"""Star schema: customer, product and calendar dimensions and the line fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.config import DEFAULT_RULES, Rules
from storeloom.functions import dates, money, text
from storeloom.operators.combine import latest_per_key
from storeloom.sources.files import run_clock

PRODUCT_LINE = "General"
STATUS = "COMPLETED"


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per customer identifier."""
    selected = customers.select(
        F.col("customer_id").alias("customer_key"), "first_name", "last_name",
        text.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "email", "company_name", "address", "city", "state", "postal_code",
        F.col("phone1").alias("phone"), F.col("ingestion_date").alias("created_date"))
    order = [F.desc("created_date"), *[F.col(c).asc_nulls_last() for c in selected.columns
                                       if c not in ("customer_key", "created_date")]]
    return latest_per_key(selected, ["customer_key"], order)


def dim_product(transactions: DataFrame, run_time: datetime | Column | None = None) -> DataFrame:
    code = F.col("PRODUCTCODE")
    return transactions.select(code).distinct().select(
        code, code.alias("product_key"), text.product_family(code).alias("product_family"),
        F.lit(PRODUCT_LINE).alias("product_line"), run_clock(run_time).alias("created_date"))


def dim_calendar(calendar: DataFrame, run_time: datetime | Column | None = None) -> DataFrame:
    day = F.col("CALENDAR_DATE")
    attributes = [column.alias(name) for name, column in dates.calendar_attributes(day).items()]
    return calendar.select(day.alias("date_key"), *attributes, run_clock(run_time).alias("created_date"))


def fact_transactions(transactions: DataFrame, rules: Rules = DEFAULT_RULES,
                      run_time: datetime | Column | None = None,
                      columns: list[str] | None = None) -> DataFrame:
    """One row per order line. The total keeps its sign; net and fee are sizes.

    ``columns`` names the fact columns to build, all by default; only their
    inputs need to be present.
    """
    amount, quantity, fee_rate = F.col("_amount"), F.col("QUANTITYORDERED"), rules.restocking_fee_rate
    build = {
        "order_number": lambda: F.col("ORDERNUMBER").cast("long"),
        "customer_name": lambda: text.full_name(F.col("CONTACTFIRSTNAME"), F.col("CONTACTLASTNAME")),
        "address": lambda: F.col("ADDRESSLINE1"),
        "phone_number": lambda: F.col("PHONE"),
        "product_code": lambda: F.col("PRODUCTCODE"),
        "quantity": lambda: quantity,
        "unit_price": lambda: money.unit_price(amount, quantity),
        "total_amount": lambda: amount,
        "deal_size": lambda: F.col("DEALSIZE"),
        "territory": lambda: F.col("TERRITORY"),
        "order_date": lambda: dates.order_date(F.col("ORDERDATE")),
        "status": lambda: F.lit(STATUS),
        "product_line": lambda: F.lit(PRODUCT_LINE),
        "created_date": lambda: run_clock(run_time),
        "transaction_type": lambda: money.transaction_type(amount),
        "restocking_fee": lambda: money.restocking_fee(amount, fee_rate),
        "net_amount": lambda: money.net_amount(amount, fee_rate),
        "is_large_order": lambda: money.is_large_order(amount, rules.large_order),
    }
    wanted = list(build) if columns is None else columns
    lines = transactions
    if "TOTAL_AMOUNT" in transactions.columns:
        lines = transactions.withColumn("_amount", money.money(F.col("TOTAL_AMOUNT")))
    return lines.select(*[build[name]().alias(name) for name in wanted])
