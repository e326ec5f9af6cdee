"""Order dates, periods and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_DATE_FORMAT = "M/d/yyyy H:mm"

# Period columns by name. ``week`` is the ISO week while ``year`` is the
# calendar year, so the first days of January may show week 52 or 53.
PERIODS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "week": F.weekofyear,
}


def order_date(text: Column) -> Column:
    """Date part of the order time; unreadable text gives NULL."""
    return F.try_to_date(text, ORDER_DATE_FORMAT)


def periods(date: Column, names: list[str]) -> list[Column]:
    return [PERIODS[name](date).alias(name) for name in names]


def day_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def calendar_attributes(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "quarter": F.quarter(date),
        "day_of_week": F.dayofweek(date),
        "month_name": F.date_format(date, "MMMM"),
        "day_name": F.date_format(date, "EEEE"),
    }
