"""Look-up joins of the sales model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.functions.text import name_key
from storeloom.operators.combine import latest_per_key
from storeloom.scratch import stage


def with_fiscal_day(df: DataFrame, calendar: DataFrame, date: str = "order_date") -> DataFrame:
    """Left join to the fiscal calendar; a day outside it keeps NULL fiscal columns.

    No broadcast hint: the planner broadcasts the calendar while its size allows.
    """
    return df.join(calendar, F.col(date) == F.col("CALENDAR_DATE"), "left")


def unique_names(dim_customer: DataFrame, name: str = "full_name") -> DataFrame:
    """One dimension row per normalised name, so that a join by name cannot fan out."""
    keyed = dim_customer.withColumn("name_key", name_key(F.col(name)))
    order = [F.col(c).asc_nulls_last() for c in dim_customer.columns if c != name]
    return latest_per_key(keyed, ["name_key"], [F.asc_nulls_last(name), *order])


def with_contacts(customers: DataFrame, dim_customer: DataFrame, columns: list[str]) -> DataFrame:
    """Left join of customers to their contact columns by normalised name."""
    contacts = unique_names(dim_customer.select("full_name", *columns)).drop("full_name")
    return customers.withColumn("name_key", name_key(F.col("customer_name"))).join(
        contacts, "name_key", "left").drop("name_key")


def with_contacts_of_few(few: DataFrame, dim_customer: DataFrame, columns: list[str]) -> DataFrame:
    """``with_contacts`` for a top-k result: the dimension is first cut down to its names.

    The k rows are staged, since both the cut and the join read them, and the
    dimension is cut before anything is shuffled. The staged rows carry their size,
    so the planner broadcasts them by itself while that is safe.
    """
    staged = stage(few, "few_customers")
    names = staged.select(name_key(F.col("customer_name")).alias("name_key")).distinct()
    contacts = (dim_customer.select("full_name", *columns)
                .withColumn("name_key", name_key(F.col("full_name")))
                .join(names, "name_key", "left_semi").drop("name_key"))
    return with_contacts(staged, contacts, columns)


def key_counts(df: DataFrame, key: Column) -> DataFrame:
    """Rows per key, so a hot key crosses the shuffle as one row per task."""
    return df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))


def orphaned_share(df: DataFrame, key: Column, dimension: DataFrame, dimension_key: Column) -> DataFrame:
    """Rows, orphaned rows and their share. A NULL key has no match and is an orphan."""
    known = dimension.select(dimension_key.alias("k")).filter(F.col("k").isNotNull()).distinct()
    counts = key_counts(df, key).join(known.withColumn("known", F.lit(True)), "k", "left")
    rows = F.coalesce(F.sum("n"), F.lit(0))
    orphans = F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0))
    return counts.agg(rows.alias("rows"), orphans.alias("orphans")).withColumn(
        "share", F.coalesce(F.try_divide(F.col("orphans").cast("double"), F.col("rows").cast("double")), F.lit(0.0)))


def orphans(df: DataFrame, key: Column, dimension: DataFrame, dimension_key: Column) -> DataFrame:
    """The rows without a partner in the dimension."""
    return df.join(dimension.select(dimension_key.alias("_known")), key == F.col("_known"), "left_anti")


def matched(df: DataFrame, key: Column, dimension: DataFrame, dimension_key: Column) -> DataFrame:
    """The rows with a partner in the dimension, none repeated."""
    return df.join(dimension.select(dimension_key.alias("_known")), key == F.col("_known"), "left_semi")
