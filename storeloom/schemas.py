"""Declared schemas of the landing files and of the modelled tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Type of one line amount. With a two-digit fee rate both the fee (17,4) and
# the net amount (18,4) stay within 18 digits, i.e. long-backed in Tungsten.
MONEY = T.DecimalType(14, 2)
NET_MONEY = T.DecimalType(18, 4)

# The column names and types of the landing files.
TRANSACTIONS = T.StructType([
    T.StructField("ORDERNUMBER", T.LongType()),
    T.StructField("QUANTITYORDERED", T.IntegerType()),
    T.StructField("ORDERLINENUMBER", T.IntegerType()),
    T.StructField("TOTAL_AMOUNT", T.DoubleType()),
    T.StructField("ORDERDATE", T.StringType()),
    T.StructField("QTR_ID", T.IntegerType()),
    T.StructField("MONTH_ID", T.IntegerType()),
    T.StructField("YEAR_ID", T.IntegerType()),
    T.StructField("PRODUCTCODE", T.StringType()),
    T.StructField("CUSTOMERNAME", T.StringType()),
    T.StructField("PHONE", T.StringType()),
    T.StructField("ADDRESSLINE1", T.StringType()),
    T.StructField("ADDRESSLINE2", T.StringType()),
    T.StructField("CITY", T.StringType()),
    T.StructField("STATE", T.StringType()),
    T.StructField("POSTALCODE", T.StringType()),
    T.StructField("COUNTRY", T.StringType()),
    T.StructField("TERRITORY", T.StringType()),
    T.StructField("CONTACTLASTNAME", T.StringType()),
    T.StructField("CONTACTFIRSTNAME", T.StringType()),
    T.StructField("DEALSIZE", T.StringType()),
])

CUSTOMERS = T.StructType([
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("county", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("phone1", T.StringType()),
    T.StructField("phone2", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("web", T.StringType()),
])

CALENDAR = T.StructType([
    T.StructField("CALENDAR_DATE", T.DateType()),
    T.StructField("WEEKDAY_NUMBER", T.IntegerType()),
    T.StructField("WEEKDAY_NAME", T.StringType()),
    T.StructField("FISCAL_WEEK_OF_MONTH", T.IntegerType()),
    T.StructField("FISCAL_WEEK_OF_YEAR", T.IntegerType()),
    T.StructField("FISCAL_MONTH_NUMBER", T.IntegerType()),
    T.StructField("FISCAL_MONTH_NAME", T.StringType()),
    T.StructField("FISCAL_FIRST_DAY_OF_WEEK", T.DateType()),
    T.StructField("FISCAL_LAST_DAY_OF_WEEK", T.DateType()),
    T.StructField("FISCAL_FIRST_DAY_OF_MONTH", T.DateType()),
    T.StructField("FISCAL_LAST_DAY_OF_MONTH", T.DateType()),
    T.StructField("FISCAL_DAY_OF_MONTH", T.IntegerType()),
    T.StructField("FISCAL_QUARTER", T.IntegerType()),
    T.StructField("FISCAL_YEAR", T.IntegerType()),
    T.StructField("FISCAL_YEAR_WEEK", T.IntegerType()),
    T.StructField("FISCAL_YEAR_MONTH", T.IntegerType()),
    T.StructField("FISCAL_YEAR_QUARTER", T.IntegerType()),
    T.StructField("CALENDAR_WEEK_OF_MONTH", T.IntegerType()),
    T.StructField("CALENDAR_WEEK_OF_YEAR", T.IntegerType()),
    T.StructField("CALENDAR_FIRST_DAY_OF_MONTH", T.DateType()),
    T.StructField("CALENDAR_LAST_DAY_OF_MONTH", T.DateType()),
    T.StructField("CALENDAR_FIRST_DAY_OF_YEAR", T.DateType()),
    T.StructField("CALENDAR_LAST_DAY_OF_YEAR", T.DateType()),
    T.StructField("WEEKEND", T.BooleanType()),
])

# The columns, precisions and text widths of the warehouse targets.
# A value that does not fit is rejected, not cut.
WAREHOUSE = {
    "dim_customer": T.StructType([
        T.StructField("customer_key", T.VarcharType(500)),
        T.StructField("first_name", T.VarcharType(100)),
        T.StructField("last_name", T.VarcharType(100)),
        T.StructField("full_name", T.VarcharType(200)),
        T.StructField("email", T.VarcharType(200)),
        T.StructField("company_name", T.VarcharType(200)),
        T.StructField("address", T.VarcharType(500)),
        T.StructField("city", T.VarcharType(100)),
        T.StructField("state", T.VarcharType(50)),
        T.StructField("postal_code", T.VarcharType(20)),
        T.StructField("phone", T.VarcharType(50)),
        T.StructField("created_date", T.TimestampType()),
    ]),
    "dim_product": T.StructType([
        T.StructField("PRODUCTCODE", T.VarcharType(50)),
        T.StructField("product_key", T.VarcharType(50)),
        T.StructField("product_family", T.VarcharType(100)),
        T.StructField("product_line", T.VarcharType(100)),
        T.StructField("created_date", T.TimestampType()),
    ]),
    "dim_calendar": T.StructType([
        T.StructField("date_key", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("month_name", T.VarcharType(20)),
        T.StructField("day_name", T.VarcharType(20)),
        T.StructField("created_date", T.TimestampType()),
    ]),
    "fact_transactions": T.StructType([
        T.StructField("order_number", T.LongType()),
        T.StructField("customer_name", T.VarcharType(200)),
        T.StructField("address", T.VarcharType(500)),
        T.StructField("phone_number", T.VarcharType(50)),
        T.StructField("product_code", T.VarcharType(50)),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("total_amount", T.DecimalType(12, 2)),
        T.StructField("deal_size", T.VarcharType(20)),
        T.StructField("territory", T.VarcharType(50)),
        T.StructField("order_date", T.DateType()),
        T.StructField("status", T.VarcharType(50)),
        T.StructField("product_line", T.VarcharType(100)),
        T.StructField("created_date", T.TimestampType()),
        T.StructField("transaction_type", T.VarcharType(20)),
        T.StructField("restocking_fee", T.DecimalType(10, 2)),
        T.StructField("net_amount", T.DecimalType(12, 2)),
        T.StructField("is_large_order", T.BooleanType()),
    ]),
    "customer_segments": T.StructType([
        T.StructField("customer_name", T.VarcharType(200)),
        T.StructField("total_spent", T.DecimalType(12, 2)),
        T.StructField("total_orders", T.IntegerType()),
        T.StructField("avg_order_value", T.DecimalType(10, 2)),
        T.StructField("last_order_date", T.DateType()),
        T.StructField("customer_segment", T.VarcharType(50)),
        T.StructField("created_date", T.TimestampType()),
    ]),
}
