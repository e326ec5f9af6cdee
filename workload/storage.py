"""Sources and sinks: round trips of the provided tables through files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom import schemas
from storeloom.plans import customers, products, sales, star
from storeloom.scratch import scratch_dir, shuffles_dropped
from storeloom.sinks import catalog, tables, warehouse
from storeloom.sources import files
from storeloom.sources import retail_views as views
from storeloom.sources.tables import read_table
from storeloom.sources.type_drift import read_drifting_types
from workload.analytics import MEASURES, SALE
from workload.registry import ALL_FACT, RUN_TIME, doubles, fact, query

# Landing folder -> its regions and its header spellings: standard name -> drifted name.
LAYOUTS = {
    "us": (("AF",), {"postal_code": "zip"}, ()),
    "uk": ((None,), {"postal_code": "postal"}, ("state",)),
    "au": (("AS", "EU"), {"postal_code": "post"}, ("county",)),
    "ca": (("MI",), {"postal_code": "postal", "state": "province"}, ("county",)),
}


def land_customers(spark: SparkSession, d: str, repeated: bool = False) -> str:
    """Write the customers as drifting CSV files, one folder per layout."""
    root = scratch_dir(spark, "landing-customers")
    rows = views.customers(spark, d).drop("source_file")
    state = F.col("state")
    for folder, (states, names, missing) in LAYOUTS.items():
        chosen = rows.filter(state.isNull() if states == (None,) else state.isin(*states)).drop(*missing)
        chosen.withColumnsRenamed(names).write.option("header", True).csv(f"{root}/{folder}")
    if repeated:
        again = rows.withColumn("email", F.upper("email"))
        again.withColumnRenamed("postal_code", "zip").write.option("header", True).csv(f"{root}/dup")
    return root


def land_transactions(spark: SparkSession, d: str, files: int | None = None, compression: str | None = None, **values: Column) -> str:
    """Write the transactions view as CSV in the declared layout, as so many files at least where a number is given; ``values``
    replace columns."""
    root = scratch_dir(spark, "landing-transactions")
    rows = views.transactions(spark, d)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schemas.TRANSACTIONS if f.name not in rows.columns}
    lines = rows.withColumns({**absent, **values}).select(*schemas.TRANSACTIONS.names)
    # Shorter files instead of a shuffle of whole lines; 0 is no bound.
    longest = max(1, views.table(spark, d, "lineitem").count() // files) if files else 0
    with shuffles_dropped(spark):
        lines.write.option("header", True).option("maxRecordsPerFile", longest).csv(root, compression=compression)
    return root


def land_calendar(spark: SparkSession, d: str) -> str:
    root = scratch_dir(spark, "landing-calendar")
    views.calendar(spark, d).write.option("header", True).csv(root)
    return root


def folder(path: str = "source_file"):
    """Name of the folder that holds a file."""
    return F.regexp_extract(path, "([^/]+)/[^/]+$", 1)


# Scans

@query("src_1_csv_all_text", """
    SELECT phone1, company_name, postal_code, state, county, email FROM customers WHERE source_file = 'africa.csv'
    UNION ALL
    SELECT phone1, company_name, postal_code, state, county, email FROM customers WHERE source_file <> 'africa.csv'""")
def csv_all_text(spark, d):
    path = scratch_dir(spark, "customers-csv")
    columns = ["phone1", "company_name", "postal_code", "state", "county", "email"]
    views.customers(spark, d).select(*columns).write.option("header", True).csv(path)
    return files.read_csv(spark, path, files.text_schema(columns))


@query("src_2_csv_glob", """
    SELECT ORDERNUMBER, ORDERLINENUMBER, QUANTITYORDERED, TOTAL_AMOUNT, PRODUCTCODE, ORDERDATE FROM transactions""")
def csv_glob(spark, d):
    root = land_transactions(spark, d)
    return files.read_csv(spark, f"{root}/*.csv", schemas.TRANSACTIONS).select(
        "ORDERNUMBER", "ORDERLINENUMBER", "QUANTITYORDERED", "TOTAL_AMOUNT", "PRODUCTCODE", "ORDERDATE")


@query("src_3_csv_typed_with_corrupt", """
    SELECT TERRITORY, DEALSIZE, count(*) AS lines, CAST(sum(CAST(TOTAL_AMOUNT AS DECIMAL(14,2))) AS DOUBLE) AS amount,
           CAST(0 AS BIGINT) AS corrupt FROM transactions GROUP BY ALL""")
def csv_typed(spark, d):
    rows = files.read_csv_keeping_corrupt(spark, land_transactions(spark, d), schemas.TRANSACTIONS)
    return doubles(rows.groupBy("TERRITORY", "DEALSIZE").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("TOTAL_AMOUNT").cast(schemas.MONEY)).alias("amount"),
        F.count(files.CORRUPT_COLUMN).alias("corrupt")))


@query("src_3_drifting_types", """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 1 THEN concat('C', CAST(o_custkey AS VARCHAR)) ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
           CASE o_orderkey % 3 WHEN 2 THEN round(o_totalprice) ELSE o_totalprice END AS o_totalprice,
           CASE o_orderkey % 3 WHEN 2 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def drifting_types(spark, d):
    """Three deliveries of the orders: numbers, text and other numbers under the same names; one has a column more."""
    root = scratch_dir(spark, "orders-by-delivery")
    kinds = [("bigint", "bigint", "decimal(12,2)", []), ("int", "string", "decimal(15,2)", []), ("bigint", "int", "int", ["o_orderpriority"])]
    for number, (key, customer, price, more) in enumerate(kinds):
        named = F.concat(F.lit("C"), F.col("o_custkey").cast("string")) if customer == "string" else F.col("o_custkey").cast(customer)
        amount = F.round("o_totalprice") if price == "int" else F.col("o_totalprice")
        views.table(spark, d, "orders").filter(F.pmod("o_orderkey", F.lit(3)) == number).select(
            F.col("o_orderkey").cast(key), named.alias("o_custkey"), amount.cast(price).alias("o_totalprice"), *more).write.parquet(
            f"{root}/delivery={number}")
    return doubles(read_drifting_types(spark, [f"{root}/delivery={number}" for number in range(3)]))


@query("src_4_csv_inferred", "SELECT * FROM calendar")
def csv_inferred(spark, d):
    return files.read_csv(spark, land_calendar(spark, d))


@query("src_5_input_files", """
    SELECT DISTINCT landing FROM landed_customers WHERE landing <> 'dup'""")
def input_files(spark, d):
    return files.input_files(spark, land_customers(spark, d)).select(folder().alias("landing")).distinct()


@query("src_6_drifting_files", """
    SELECT phone1, postal_code, state, CASE WHEN landing IN ('us', 'uk') THEN county END AS county, email, landing
    FROM landed_customers WHERE landing <> 'dup'""")
def drifting_files(spark, d):
    rows = files.read_drifting(spark, land_customers(spark, d), files.CUSTOMER_HEADERS, RUN_TIME)
    return rows.select("phone1", "postal_code", "state", "county", "email", folder().alias("landing"))


@query("src_7_table_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'")
def table_scan(spark, d):
    return read_table(spark, f"{d}/lineitem.parquet").filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("srcf_1_source_file_name", """
    SELECT landing, count(*) AS lines FROM landed_customers GROUP BY landing""")
def source_file_name(spark, d):
    rows = files.read_drifting(spark, land_customers(spark, d, repeated=True), files.CUSTOMER_HEADERS, RUN_TIME)
    return rows.groupBy(folder().alias("landing")).agg(F.count(F.lit(1)).alias("lines"))


@query("ing_1_customers_clean", """
    SELECT customer_id, first_name, last_name, company_name, address, city, county, state, postal_code, phone1,
           email, landing
    FROM (SELECT * REPLACE (CASE WHEN landing IN ('us', 'uk', 'dup') THEN county END AS county),
                 concat_ws('_', lower(first_name), lower(last_name), lower(email)) AS customer_id,
                 row_number() OVER (PARTITION BY concat_ws('_', lower(first_name), lower(last_name), lower(email))
                                    ORDER BY landing) AS rn
          FROM landed_customers) t WHERE rn = 1""")
def customers_clean(spark, d):
    rows = files.clean_customers(spark, land_customers(spark, d, repeated=True), RUN_TIME)
    return rows.select("customer_id", "first_name", "last_name", "company_name", "address", "city", "county",
                       "state", "postal_code", "phone1", "email", folder().alias("landing"))


@query("ing_2_raw_transactions", """
    SELECT ORDERNUMBER, QUANTITYORDERED, TOTAL_AMOUNT, ORDERDATE, PRODUCTCODE, TERRITORY,
           DATE '2024-01-31' AS ingestion_date FROM transactions""")
def raw_transactions(spark, d):
    rows = files.raw_transactions(spark, land_transactions(spark, d), RUN_TIME)
    return rows.select("ORDERNUMBER", "QUANTITYORDERED", "TOTAL_AMOUNT", "ORDERDATE", "PRODUCTCODE", "TERRITORY",
                       F.to_date("ingestion_date").alias("ingestion_date"))


@query("ing_2_rejected_lines", """
    SELECT PRODUCTCODE, count(*) FILTER (ORDERNUMBER % 10 = 3) AS rejected, count(*) FILTER (ORDERNUMBER % 10 <> 3) AS good,
           CAST(sum(CAST(TOTAL_AMOUNT AS DECIMAL(14,2))) FILTER (ORDERNUMBER % 10 <> 3) AS DOUBLE) AS good_amount
    FROM transactions GROUP BY ALL""")
def rejected_lines(spark, d):
    """Every line lands; the amounts of some orders are written as text that is no number."""
    raw = scratch_dir(spark, "raw-bad")
    amount = F.when(F.col("ORDERNUMBER") % 10 == 3, "ten").otherwise(F.col("TOTAL_AMOUNT").cast("string"))
    # Compressed, as landing files take far more room than the tables that they are made from.
    landing = land_transactions(spark, d, compression="gzip", TOTAL_AMOUNT=amount)
    tables.write_table(files.raw_transactions(spark, landing, RUN_TIME), raw)
    stored = read_table(spark, raw)
    code = F.split("line", ",")[schemas.TRANSACTIONS.names.index("PRODUCTCODE")]
    rejected = files.rejected_lines(stored).groupBy(code.alias("PRODUCTCODE")).agg(F.count("*").alias("rejected"))
    good = files.good_lines(stored).groupBy("PRODUCTCODE").agg(
        F.count("*").alias("good"), F.sum(F.col("TOTAL_AMOUNT").cast(schemas.MONEY)).alias("good_amount"))
    return doubles(good.join(rejected, "PRODUCTCODE", "full_outer").select(
        "PRODUCTCODE", F.coalesce("rejected", F.lit(0)).alias("rejected"), F.coalesce("good", F.lit(0)).alias("good"), "good_amount"))


@query("ing_2_raw_calendar", "SELECT CALENDAR_DATE, FISCAL_YEAR, FISCAL_MONTH_NAME FROM calendar")
def raw_calendar(spark, d):
    path = scratch_dir(spark, "landing-calendar")
    days = views.calendar(spark, d)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schemas.CALENDAR if f.name not in days.columns}
    days.withColumns(absent).select(*schemas.CALENDAR.names).write.option("header", True).csv(path)
    return files.raw_calendar(spark, path, RUN_TIME).select("CALENDAR_DATE", "FISCAL_YEAR", "FISCAL_MONTH_NAME")


# Sinks

@query("snk_1_overwrite", "SELECT order_number, product_code, CAST(net_amount AS DOUBLE) AS net_amount FROM fact")
def overwrite(spark, d):
    path = scratch_dir(spark, "fact")
    rows = fact(spark, d, ["order_number", "product_code", "net_amount"])
    tables.write_table(rows.filter(F.col("net_amount") > 50000), path)
    tables.write_table(rows, path)
    return doubles(read_table(spark, path))


@query("snk_2_partition_overwrite", """
    SELECT event_id, event_type, CAST(ts AS DATE) AS partition_date,
           CAST(ts AS DATE) < DATE '2024-01-20' AS first_load FROM events""")
def partition_overwrite(spark, d):
    path = scratch_dir(spark, "events-by-day")
    events = files.with_partition_day(views.table(spark, d, "events").select("event_id", "event_type", "ts"), "ts")
    tables.replace_partitions(events.drop("ts").withColumn("first_load", F.lit(True)), path, ["partition_date"])
    late = events.filter(F.to_date("ts") >= F.lit("2024-01-20").cast("date")).drop("ts")
    tables.replace_partitions(late.withColumn("first_load", F.lit(False)), path, ["partition_date"])
    return read_table(spark, path).select("event_id", "event_type",
                                          F.col("partition_date").cast("date").alias("partition_date"), "first_load")


@query("snk_3_schema_merge", """
    SELECT order_number, quantity, CASE WHEN transaction_type = 'REFUND' THEN CAST(restocking_fee AS DOUBLE) END
             AS restocking_fee FROM fact""")
def schema_merge(spark, d):
    path = scratch_dir(spark, "fact-evolving")
    rows = fact(spark, d, ["order_number", "quantity", "transaction_type", "restocking_fee"])
    is_refund = F.col("transaction_type") == "REFUND"
    tables.write_table(rows.filter(~is_refund).select("order_number", "quantity"), path)
    tables.write_table(rows.filter(is_refund).select("order_number", "quantity", "restocking_fee"), path,
                       mode="append", merge_schema=True)
    return doubles(read_table(spark, path, merge_schema=True))


@query("snk_4_generic_writer", "SELECT order_number, deal_size, territory FROM fact")
def generic_writer(spark, d):
    path = scratch_dir(spark, "fact-orc")
    rows = fact(spark, d, ["order_number", "deal_size", "territory"])
    tables.write_table(rows, path, fmt="orc", partition_by=["territory", "deal_size"])
    return read_table(spark, path, fmt="orc").select("order_number", "deal_size", "territory")


@query("snk_5_analytics_tables", f"""
    SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month, {MEASURES}
    FROM fact WHERE transaction_type = 'SALE' GROUP BY 1, 2""")
def analytics_tables(spark, d):
    root = scratch_dir(spark, "processed")
    rows = fact(spark, d, [*SALE, "order_date", "territory"])
    tables.write_analytics({"monthly_sales": sales.monthly_sales(rows),
                            "territory_revenue": sales.territory_revenue(rows)}, root)
    return doubles(read_table(spark, f"{root}/analytics_monthly_sales"))


@query("agg_10_observed_row_counts", """
    SELECT 'analytics_regional_rankings' AS table_name, count(*) AS rows FROM rankings
    UNION ALL SELECT 'analytics_type_counts', count(DISTINCT transaction_type) FROM fact""")
def observed_row_counts(spark, d) -> DataFrame:
    rows = fact(spark, d, [*SALE, "territory", "product_code"])
    counts = tables.write_analytics({"regional_rankings": products.regional_rankings(rows),
                                     "type_counts": sales.transaction_type_counts(rows)},
                                    scratch_dir(spark, "processed"))
    return spark.createDataFrame([(f"analytics_{name}", n) for name, n in counts.items()],
                                 "table_name string, rows bigint")


# Typed tables of the catalogue.

def _new_database(spark) -> tuple[str, str]:
    place = scratch_dir(spark, "warehouse")
    return f"storeloom_{place[-32:]}", place


@query("snk_6_create_if_missing", """
    SELECT product_code AS product_key, product_family, 'varchar(100)' AS line_type,
           CASE WHEN product_code LIKE '%7' THEN 'rejected' ELSE 'stored' END AS state,
           CASE WHEN product_code LIKE '%7' THEN 'product_line' END AS misfits,
           CAST(5 AS BIGINT) AS tables_created, CAST(0 AS BIGINT) AS created_again
    FROM (SELECT DISTINCT product_code, product_family FROM families) p""")
def create_if_missing(spark, d):
    """The warehouse tables are created once and filled twice; the second load replaces the first, and the lines of
    some of its products are longer than their column."""
    database, place = _new_database(spark)
    created = catalog.create_missing(spark, schemas.WAREHOUSE, database, place)
    dim = star.dim_product(views.transactions(spark, d, ["PRODUCTCODE"]), RUN_TIME)
    table, target = f"{database}.dim_product", schemas.WAREHOUSE["dim_product"]
    catalog.fill_table(dim, table, target)
    again = catalog.create_missing(spark, schemas.WAREHOUSE, database, place)
    long = F.when(F.col("product_key").like("%7"), F.repeat(F.lit("line "), 21)).otherwise(F.col("product_line"))
    _, rejects = catalog.fill_table(dim.withColumn("product_line", long), table, target)
    kept = spark.table(table).select("product_key", "product_family", F.lit("stored").alias("state"), F.lit(None).cast("string").alias("misfits"))
    refused = rejects.select("product_key", "product_family", F.lit("rejected").alias("state"), F.array_join("misfits", ",").alias("misfits"))
    return kept.unionByName(refused).select(
        "product_key", "product_family", F.lit(catalog.declared_types(spark, table)["product_line"]).alias("line_type"), "state",
        "misfits", F.lit(len(created)).cast("long").alias("tables_created"), F.lit(len(again)).cast("long").alias("created_again"))


@query("snk_7_refresh_load", """
    SELECT customer_name, CAST(CAST(total_spent AS DECIMAL(12,2)) AS DOUBLE) AS total_spent,
           CAST(total_orders AS INTEGER) AS total_orders, last_order_date,
           CASE WHEN total_spent >= 10000 THEN 'High Value' ELSE 'Regular' END AS customer_segment,
           'decimal(12,2)' AS spent_type
    FROM spend""")
def refresh_load(spark, d):
    """The full-refresh load run to its end, twice: the stored rows of the segments."""
    database, place = _new_database(spark)
    segments = customers.customer_segments(fact(spark, d, [*SALE, "customer_name", "order_date"]))
    for frame in (segments.filter("total_orders > 100"), segments):
        catalog.load_tables({"customer_segments": frame}, schemas.WAREHOUSE, database, place)
    table = f"{database}.customer_segments"
    return doubles(spark.table(table).drop("created_date", "avg_order_value")).withColumn(
        "spent_type", F.lit(catalog.declared_types(spark, table)["total_spent"]))


# Warehouse rows: what a load would insert. The insert itself needs a database.

@query("snk_7_refresh_rows", """
    SELECT customer_name, CAST(CAST(total_spent AS DECIMAL(12,2)) AS DOUBLE) AS total_spent,
           CAST(total_orders AS INTEGER) AS total_orders, last_order_date,
           CASE WHEN total_spent >= 10000 THEN 'High Value' ELSE 'Regular' END AS customer_segment
    FROM spend""")
def refresh_rows(spark, d):
    segments = customers.customer_segments(fact(spark, d, [*SALE, "customer_name", "order_date"]))
    good, _ = warehouse.conform(segments, schemas.WAREHOUSE["customer_segments"])
    return doubles(good.drop("created_date", "avg_order_value"))


@query("snk_8_extra_dimensions", """
    SELECT 'dim_product' AS target, product_code AS key, product_family AS label FROM (
        SELECT DISTINCT product_code, product_family FROM families) p
    UNION ALL SELECT 'dim_calendar', CAST(CALENDAR_DATE AS VARCHAR), monthname(CALENDAR_DATE) FROM calendar""")
def extra_dimensions(spark, d):
    dim_product, _ = warehouse.conform(
        star.dim_product(views.transactions(spark, d, ["PRODUCTCODE"]), RUN_TIME), schemas.WAREHOUSE["dim_product"])
    dim_calendar, _ = warehouse.conform(
        star.dim_calendar(views.calendar(spark, d), RUN_TIME), schemas.WAREHOUSE["dim_calendar"])
    return dim_product.select(F.lit("dim_product").alias("target"), F.col("product_key").alias("key"),
                              F.col("product_family").alias("label")).unionByName(
        dim_calendar.select(F.lit("dim_calendar").alias("target"), F.col("date_key").cast("string").alias("key"),
                            F.col("month_name").alias("label")))


@query("snk_9_conform_to_target", """
    SELECT order_number, product_code, quantity,
           CAST(total_amount AS DOUBLE) AS total_amount, order_date,
           CAST(CAST(restocking_fee AS DECIMAL(10,2)) AS DOUBLE) AS restocking_fee,
           CAST(CAST(net_amount AS DECIMAL(12,2)) AS DOUBLE) AS net_amount, is_large_order
    FROM fact""")
def conform_to_target(spark, d):
    good, rejects = warehouse.conform(fact(spark, d, ALL_FACT), schemas.WAREHOUSE["fact_transactions"])
    # The unit price is a double, so its rounding at a half cent differs between engines; mth_2 checks it.
    return doubles(good.select("order_number", "product_code", "quantity", "total_amount", "order_date",
                               "restocking_fee", "net_amount", "is_large_order"))
