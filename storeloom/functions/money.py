"""Money rules. Amounts are exact decimals; averages and ratios are doubles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.functions.text import mentions
from storeloom.schemas import MONEY, NET_MONEY

SALE = "SALE"
REFUND = "REFUND"


def money(amount: Column) -> Column:
    """Exact amount in cents. A value that does not fit raises, never turns NULL."""
    return amount.cast(MONEY)


def total(fact: DataFrame, column: str, only: Column | None = None) -> Column:
    """Exact sum of fees or net amounts of the rows that ``only`` selects.

    A decimal is summed at its own scale, which follows from the fee rate. A fact
    table that stores doubles is read to four places.
    """
    value = F.col(column)
    if not isinstance(fact.schema[column].dataType, T.DecimalType):
        value = value.cast(NET_MONEY)
    return F.sum(value if only is None else F.when(only, value))


def rate(value: Decimal | float | str) -> Column:
    return F.lit(Decimal(str(value)))


def transaction_type(amount: Column) -> Column:
    """Negative amounts are refunds; everything else, NULL included, is a sale."""
    return F.when(amount < 0, REFUND).otherwise(SALE)


def restocking_fee(amount: Column, fee_rate: Decimal) -> Column:
    return F.when(amount < 0, F.abs(amount) * rate(fee_rate)).otherwise(0)


def net_amount(amount: Column, fee_rate: Decimal) -> Column:
    size = F.abs(amount)
    return F.when(amount < 0, size - size * rate(fee_rate)).otherwise(size)


def is_large_order(amount: Column, threshold: Decimal) -> Column:
    """A real boolean: a missing amount is not large."""
    return F.when(F.abs(amount) >= rate(threshold), True).otherwise(False)


def unit_price(amount: Column, quantity: Column) -> Column:
    """Price per piece; a zero quantity gives NULL."""
    return F.try_divide(F.abs(amount).cast("double"), quantity.cast("double"))


def fee_by_status(amount: Column, status: Column, fee_rate: Decimal = Decimal("0.10")) -> Column:
    """Signed fee where the status text mentions a refund, else zero."""
    return F.when(mentions(status, "refund"), amount * rate(fee_rate)).otherwise(0)


def refund_split(amount: Column, is_refund: Column, fee_rate: Decimal = Decimal("0.10")) -> Column:
    """Struct of final amount and fee on the signed amount."""
    fee = amount * rate(fee_rate)
    return F.struct(
        F.when(is_refund, amount - fee).otherwise(amount).alias("final_amount"),
        F.when(is_refund, fee).otherwise(0).alias("restocking_fee"),
    )


def average(total: Column, count: Column) -> Column:
    """Mean from an exact total; NULL for no rows."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def percent_of(part: Column, whole: Column) -> Column:
    """Share in percent with two places, half up; NULL where the whole is zero."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.round(share * 100, 2)
