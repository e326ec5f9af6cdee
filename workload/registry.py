"""Registration of queries, shared input frames and the shared SQL views."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.config import DEFAULT_RULES, Rules
from storeloom.plans import star
from storeloom.sources import retail_views as views

RUN_TIME = datetime(2024, 1, 31, 6, 0, 0)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fact column -> columns of the transactions view that it is made of.
FACT_INPUTS = {
    "order_number": ("ORDERNUMBER",),
    "customer_name": ("CONTACTFIRSTNAME", "CONTACTLASTNAME"),
    "address": ("ADDRESSLINE1",),
    "phone_number": ("PHONE",),
    "product_code": ("PRODUCTCODE",),
    "quantity": ("QUANTITYORDERED",),
    "unit_price": ("TOTAL_AMOUNT", "QUANTITYORDERED"),
    "total_amount": ("TOTAL_AMOUNT",),
    "deal_size": ("DEALSIZE",),
    "territory": ("TERRITORY",),
    "order_date": ("ORDERDATE",),
    "status": (),
    "product_line": (),
    "created_date": (),
    "transaction_type": ("TOTAL_AMOUNT",),
    "restocking_fee": ("TOTAL_AMOUNT",),
    "net_amount": ("TOTAL_AMOUNT",),
    "is_large_order": ("TOTAL_AMOUNT",),
}
ALL_FACT = tuple(c for c in FACT_INPUTS if c != "created_date")


def fact(spark: SparkSession, sf_dir: str, columns: Iterable[str], rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The line fact with the named columns; look-ups that serve none of them are left out."""
    names = list(columns)
    inputs = list(dict.fromkeys(i for name in names for i in FACT_INPUTS[name])) or ["ORDERNUMBER"]
    lines = views.transactions(spark, sf_dir, inputs)
    return star.fact_transactions(lines, rules, RUN_TIME, names)


def doubles(df: DataFrame) -> DataFrame:
    """Final result with decimals shown as doubles, the type the SQL twin returns."""
    return df.select(*[F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema])


def query(name: str, sql: str | None = None, views: bool = True):
    """Register a query and, where SQL can say the same, its twin; ``views``: put the shared views before the text."""
    def add(function: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(sql) if views else sql
        return function
    return add


# Shared views in SQL, in an order in which each uses only earlier ones.
SQL_VIEWS = {
    "transactions": """
        SELECT l_orderkey AS ORDERNUMBER, CAST(l_quantity AS INTEGER) AS QUANTITYORDERED,
               l_linenumber AS ORDERLINENUMBER,
               CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS TOTAL_AMOUNT,
               concat(CAST(month(o_orderdate) AS VARCHAR), '/', CAST(day(o_orderdate) AS VARCHAR), '/',
                      CAST(year(o_orderdate) AS VARCHAR), ' 0:00') AS ORDERDATE,
               CAST(quarter(o_orderdate) AS INTEGER) AS QTR_ID,
               CAST(month(o_orderdate) AS INTEGER) AS MONTH_ID,
               CAST(year(o_orderdate) AS INTEGER) AS YEAR_ID,
               concat('S', lpad(substring(p_brand, 7), 2, '0'), '_',
                      lpad(CAST(p_partkey AS VARCHAR), 6, '0')) AS PRODUCTCODE,
               concat(c_mktsegment, ' ', n_name) AS CUSTOMERNAME,
               concat('+', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS PHONE,
               concat(CAST(c_custkey AS VARCHAR), ' ', n_name, ' St') AS ADDRESSLINE1,
               n_name AS COUNTRY, r_name AS TERRITORY,
               substring(c_name, 10) AS CONTACTLASTNAME, substring(c_name, 1, 8) AS CONTACTFIRSTNAME,
               CASE WHEN l_extendedprice < 30000 THEN 'Small' WHEN l_extendedprice < 70000 THEN 'Medium'
                    ELSE 'Large' END AS DEALSIZE
        FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN part ON l_partkey = p_partkey""",
    "fact": """
        SELECT ORDERNUMBER AS order_number,
               concat_ws(' ', CONTACTFIRSTNAME, CONTACTLASTNAME) AS customer_name,
               ADDRESSLINE1 AS address, PHONE AS phone_number, PRODUCTCODE AS product_code,
               QUANTITYORDERED AS quantity,
               CASE WHEN QUANTITYORDERED <> 0 THEN CAST(abs(amt) AS DOUBLE) / QUANTITYORDERED END AS unit_price,
               amt AS total_amount, DEALSIZE AS deal_size, TERRITORY AS territory,
               CAST(try_strptime(ORDERDATE, '%m/%d/%Y %H:%M') AS DATE) AS order_date,
               'COMPLETED' AS status, 'General' AS product_line,
               CASE WHEN amt < 0 THEN 'REFUND' ELSE 'SALE' END AS transaction_type,
               CAST(CASE WHEN amt < 0 THEN abs(amt) * 0.10 ELSE 0 END AS DECIMAL(18,4)) AS restocking_fee,
               CAST(CASE WHEN amt < 0 THEN abs(amt) * 0.90 ELSE abs(amt) END AS DECIMAL(18,4)) AS net_amount,
               coalesce(abs(amt) >= 5000, false) AS is_large_order
        FROM (SELECT *, CAST(TOTAL_AMOUNT AS DECIMAL(14,2)) AS amt FROM transactions) t""",
    "customers": """
        SELECT 'Customer' AS first_name, substring(c_name, 10) AS last_name,
               concat(c_mktsegment, ' ', n_name) AS company_name,
               concat(CAST(c_custkey AS VARCHAR), ' ', n_name, ' St') AS address, n_name AS city,
               CASE WHEN n_regionkey IN (0, 1) THEN concat('County ', CAST(n_nationkey AS VARCHAR)) END AS county,
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
               CASE WHEN n_regionkey <> 1 THEN substring(r_name, 1, 2) END AS state,
               concat('+', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS phone1,
               CASE WHEN c_custkey % 97 = 0 THEN NULL
                    WHEN c_custkey % 50 = 0 THEN concat('bad.', CAST(c_custkey AS VARCHAR))
                    ELSE concat('c', CAST(c_custkey AS VARCHAR), '@',
                                lower(replace(n_name, '_', '-')), '.com') END AS email,
               concat(lower(r_name), '.csv') AS source_file
        FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "repeated_customers": """
        SELECT * FROM customers
        UNION ALL
        SELECT * REPLACE (upper(email) AS email, 'dup.csv' AS source_file) FROM customers""",
    "landed_customers": """
        SELECT *, CASE source_file WHEN 'africa.csv' THEN 'us' WHEN 'america.csv' THEN 'uk'
                                   WHEN 'middle east.csv' THEN 'ca' ELSE 'au' END AS landing
        FROM customers
        UNION ALL
        SELECT * REPLACE (upper(email) AS email), 'dup' AS landing FROM customers""",
    "identified": """
        SELECT *, concat_ws('_', lower(first_name), lower(last_name), lower(email)) AS customer_id
        FROM repeated_customers""",
    "dim_customer": """
        SELECT customer_id AS customer_key, first_name, last_name,
               concat_ws(' ', first_name, last_name) AS full_name, email, company_name, address, city,
               state, postal_code, phone1 AS phone
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY source_file) AS rn FROM identified) r
        WHERE rn = 1""",
    "calendar": """
        SELECT d AS CALENDAR_DATE, CAST(1996 + floor(i / 364.0) AS INTEGER) AS FISCAL_YEAR,
               CAST(w AS INTEGER) AS FISCAL_WEEK_OF_YEAR, CAST(q AS INTEGER) AS FISCAL_QUARTER,
               CAST((q-1)*3 + CASE WHEN w-(q-1)*13 <= 4 THEN 1 WHEN w-(q-1)*13 <= 9 THEN 2 ELSE 3 END
                    AS INTEGER) AS FISCAL_MONTH_NUMBER,
               substring('FebMarAprMayJunJulAugSepOctNovDecJan',
                         CAST(((q-1)*3 + CASE WHEN w-(q-1)*13 <= 4 THEN 0 WHEN w-(q-1)*13 <= 9 THEN 1
                               ELSE 2 END)*3 + 1 AS INTEGER), 3) AS FISCAL_MONTH_NAME
        FROM (SELECT d, i, w, CAST(floor((w-1)/13.0) AS INTEGER) + 1 AS q
              FROM (SELECT d, i, CAST(floor(((i % 364 + 364) % 364)/7.0) AS INTEGER) + 1 AS w
                    FROM (SELECT d, datediff('day', DATE '1995-12-31', d) AS i
                          FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
                                WHERE o_orderdate IS NOT NULL) a) b) c) e""",
    "late_calendar": "SELECT * FROM calendar WHERE CALENDAR_DATE >= DATE '1995-12-31'",
    "families": """
        SELECT *, CASE WHEN instr(product_code, '_') > 0 THEN split_part(product_code, '_', 1)
                       ELSE 'UNKNOWN' END AS product_family FROM fact""",
    "product_sales": """
        SELECT territory, product_code, product_family, sum(net_amount) AS total_sales,
               count(order_number) AS total_orders
        FROM families WHERE transaction_type = 'SALE' GROUP BY ALL""",
    "rankings": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY territory
                                 ORDER BY total_sales DESC, product_code) AS rank FROM product_sales) r
        WHERE rank <= 2""",
    "spend": """
        SELECT customer_name, sum(net_amount) AS total_spent, count(order_number) AS total_orders,
               CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS avg_order_value,
               max(order_date) AS last_order_date, count(DISTINCT product_code) AS unique_products_purchased
        FROM fact WHERE transaction_type = 'SALE' GROUP BY customer_name""",
    "spend_cuts": """
        SELECT list_sort(list(total_spent))[CAST(ceil(CAST(0.33 AS DOUBLE) * count(*)) AS BIGINT)] AS p33,
               list_sort(list(total_spent))[CAST(ceil(CAST(0.67 AS DOUBLE) * count(*)) AS BIGINT)] AS p67
        FROM spend""",
    "segments": """
        SELECT spend.*, CASE WHEN total_spent >= p67 THEN 'High Value' WHEN total_spent >= p33 THEN 'Medium Value'
                        ELSE 'Low Value' END AS customer_segment
        FROM spend, spend_cuts""",
}


def with_views(sql: str) -> str:
    """Prefix the SQL text with the shared views that it uses, directly or through others."""
    needed: set[str] = set()
    text = sql
    for name in reversed(SQL_VIEWS):
        if re.search(rf"\b{name}\b", text):
            needed.add(name)
            text += "\n" + SQL_VIEWS[name]
    ctes = [f"{name} AS ({body})" for name, body in SQL_VIEWS.items() if name in needed]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        ctes.append(body[5:])
        return "WITH " + ",\n".join(ctes)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
