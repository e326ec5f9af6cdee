"""Transactions, customers and calendar as views over the star tables.

The look-up joins are left joins on unique keys, so they neither drop nor
repeat a line. A look-up that serves none of the requested columns can
therefore be left out with the same result, and is: callers name the columns
they need, as they would in a projection on a flat transactions table.

Join order: the buyer is attached to orders first, and lines are joined to the
finished orders, so the largest table moves once for the order look-up and once
for the part look-up at most.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_COLUMNS = ("ORDERNUMBER", "QUANTITYORDERED", "ORDERLINENUMBER", "TOTAL_AMOUNT", "DEALSIZE")
ORDER_COLUMNS = ("ORDERDATE", "QTR_ID", "MONTH_ID", "YEAR_ID")
CUSTOMER_COLUMNS = ("CUSTOMERNAME", "PHONE", "ADDRESSLINE1", "CONTACTLASTNAME", "CONTACTFIRSTNAME")
NATION_COLUMNS = ("CUSTOMERNAME", "ADDRESSLINE1", "COUNTRY")
REGION_COLUMNS = ("TERRITORY",)
PART_COLUMNS = ("PRODUCTCODE",)
TRANSACTION_COLUMNS = tuple(dict.fromkeys(
    LINE_COLUMNS + ORDER_COLUMNS + PART_COLUMNS + CUSTOMER_COLUMNS + NATION_COLUMNS + REGION_COLUMNS))


STAR_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
              " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
                " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING,"
                " l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan with the declared schema, so no file is opened to plan a query."""
    return spark.read.schema(STAR_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _padded(number: Column, width: int) -> Column:
    """Left-padded with zeros; longer numbers keep all digits."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def transactions(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Order lines in the layout of the transactions file. Returned lines are negative."""
    wanted = list(columns) if columns is not None else list(TRANSACTION_COLUMNS)
    unknown = set(wanted) - set(TRANSACTION_COLUMNS)
    if unknown:
        raise ValueError(f"no such transaction column: {sorted(unknown)}")
    need = set(wanted)
    lines = _lines(spark, sf_dir)
    if need & set(PART_COLUMNS):
        lines = lines.join(_parts(spark, sf_dir), "l_partkey", "left")
    if need - set(LINE_COLUMNS) - set(PART_COLUMNS):
        lines = lines.join(_orders(spark, sf_dir, need), "ORDERNUMBER", "left")
    return lines.select(*wanted)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        F.col("l_orderkey").alias("ORDERNUMBER"),
        F.col("l_quantity").cast("int").alias("QUANTITYORDERED"),
        F.col("l_linenumber").alias("ORDERLINENUMBER"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("TOTAL_AMOUNT"),
        F.when(price < 30000, "Small").when(price < 70000, "Medium").otherwise("Large").alias("DEALSIZE"),
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.expr("substring(p_brand, 7)")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat(F.lit("S"), _padded(brand, 2), F.lit("_"), _padded(F.col("p_partkey"), 6))
        .alias("PRODUCTCODE"),
    )


def _orders(spark: SparkSession, sf_dir: str, need: set[str]) -> DataFrame:
    day = F.col("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ORDERNUMBER"),
        F.col("o_custkey").alias("c_custkey"),
        F.concat_ws("/", F.month(day), F.dayofmonth(day), F.concat(F.year(day), F.lit(" 0:00")))
        .alias("ORDERDATE"),
        F.quarter(day).alias("QTR_ID"), F.month(day).alias("MONTH_ID"), F.year(day).alias("YEAR_ID"),
    )
    if not need & set(CUSTOMER_COLUMNS + NATION_COLUMNS + REGION_COLUMNS):
        return orders.drop("c_custkey")
    orders = orders.join(_buyers(spark, sf_dir), "c_custkey", "left")
    if need & set(NATION_COLUMNS + REGION_COLUMNS):
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("COUNTRY"), "n_regionkey")
        orders = orders.join(nation, "c_nationkey", "left").withColumns({
            "CUSTOMERNAME": F.concat("c_mktsegment", F.lit(" "), "COUNTRY"),
            "ADDRESSLINE1": F.concat(F.col("c_custkey").cast("string"), F.lit(" "), "COUNTRY", F.lit(" St")),
        })
    if need & set(REGION_COLUMNS):
        region = table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("TERRITORY"))
        orders = orders.join(region, "n_regionkey", "left")
    return orders.select("ORDERNUMBER", *[c for c in TRANSACTION_COLUMNS if c in need - set(LINE_COLUMNS + PART_COLUMNS)])


def _buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment",
        F.concat(F.lit("+"), _padded(F.col("c_custkey"), 9)).alias("PHONE"),
        F.expr("substring(c_name, 10)").alias("CONTACTLASTNAME"),
        F.substring("c_name", 1, 8).alias("CONTACTFIRSTNAME"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records in the layout of the cleaned customer files."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    joined = (customer
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
              .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    return joined.select(
        F.lit("Customer").alias("first_name"),
        F.expr("substring(c_name, 10)").alias("last_name"),
        F.concat("c_mktsegment", F.lit(" "), "n_name").alias("company_name"),
        F.concat(key.cast("string"), F.lit(" "), "n_name", F.lit(" St")).alias("address"),
        F.col("n_name").alias("city"),
        F.when(F.col("n_regionkey").isin(0, 1), F.concat(F.lit("County "), F.col("n_nationkey").cast("string")))
        .alias("county"),
        F.when(F.col("n_regionkey") != 1, F.substring("r_name", 1, 2)).alias("state"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias("postal_code"),
        F.concat(F.lit("+"), _padded(key, 9)).alias("phone1"),
        F.when(key % 97 == 0, F.lit(None))
        .when(key % 50 == 0, F.concat(F.lit("bad."), key.cast("string")))
        .otherwise(F.concat(F.lit("c"), key.cast("string"), F.lit("@"),
                            F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))), F.lit(".com")))
        .alias("email"),
        F.concat(F.lower("r_name"), F.lit(".csv")).alias("source_file"),
    )


def repeated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer twice: once as filed, once from a second file in upper-case e-mail."""
    filed = customers(spark, sf_dir)
    again = filed.withColumns({"email": F.upper("email"), "source_file": F.lit("dup.csv")})
    return reduce(DataFrame.unionByName, [filed, again])


# A calendar that starts here leaves the first orders without a fiscal day.
LATE_START = date(1995, 12, 31)


def calendar(spark: SparkSession, sf_dir: str, first_day: date | None = None) -> DataFrame:
    """Fiscal calendar of all order days, or of those from ``first_day`` on: 52 weeks a year in a 4-5-4 month pattern,
    counted from 1995-12-31 in both directions."""
    day = F.col("CALENDAR_DATE")
    week, quarter, month = F.col("FISCAL_WEEK_OF_YEAR"), F.col("FISCAL_QUARTER"), F.col("FISCAL_MONTH_NUMBER")
    week_in_quarter = week - (quarter - 1) * 13
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate").isNotNull())
    if first_day is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(str(first_day)).cast("timestamp_ntz"))
    return (
        orders.select(F.to_date("o_orderdate").alias("CALENDAR_DATE")).distinct()
        .withColumn("index", F.datediff(day, F.lit("1995-12-31").cast("date")))
        .withColumns({
            "FISCAL_YEAR": (1996 + F.floor(F.col("index") / 364)).cast("int"),
            "FISCAL_WEEK_OF_YEAR": (F.floor(F.pmod("index", F.lit(364)) / 7) + 1).cast("int"),
        })
        .withColumn("FISCAL_QUARTER", (F.floor((week - 1) / 13) + 1).cast("int"))
        .withColumn("FISCAL_MONTH_NUMBER", ((quarter - 1) * 3
                    + F.when(week_in_quarter <= 4, 1).when(week_in_quarter <= 9, 2).otherwise(3)).cast("int"))
        .withColumn("FISCAL_MONTH_NAME",
                    F.substring(F.lit("FebMarAprMayJunJulAugSepOctNovDecJan"), (month - 1) * 3 + 1, F.lit(3)))
        .drop("index")
    )
