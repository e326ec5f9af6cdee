"""Modelled tables and analytics tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from storeloom.functions import text
from storeloom.operators.combine import union_by_name
from storeloom.operators.joins import with_contacts
from storeloom.operators.ranking import preview
from storeloom.plans import customers, products, sales, star
from storeloom.sources import files
from storeloom.sources import retail_views as views
from workload.registry import ALL_FACT, RUN_TIME, doubles, fact, query

SALE = ("transaction_type", "net_amount", "order_number")
MEASURES = """CAST(sum(net_amount) AS DOUBLE) AS total_sales, count(order_number) AS total_orders,
       CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS avg_order_value"""
REFUND_MEASURES = """CAST(sum(net_amount) AS DOUBLE) AS total_refunds,
       CAST(sum(restocking_fee) AS DOUBLE) AS total_restocking_fees, count(order_number) AS total_refund_orders"""
PERIOD_SQL = {name: f"CAST({name}(order_date) AS INTEGER) AS {name}" for name in ("year", "quarter", "month", "week")}


def dimension(spark, d):
    """The customer dimension of the twice-filed customers."""
    raw = views.repeated_customers(spark, d).withColumn("ingestion_date", F.lit(RUN_TIME))
    return star.dim_customer(files.identify_customers(raw))


@query("mod_1_dim_customer", "SELECT * FROM dim_customer")
def dim_customer(spark, d):
    return dimension(spark, d).drop("created_date")


@query("mod_2_dim_product", """
    SELECT DISTINCT product_code AS PRODUCTCODE, product_code AS product_key, product_family,
           'General' AS product_line FROM families""")
def dim_product(spark, d):
    return star.dim_product(views.transactions(spark, d, ["PRODUCTCODE"]), RUN_TIME).drop("created_date")


@query("mod_3_dim_calendar", """
    SELECT CALENDAR_DATE AS date_key, CAST(year(CALENDAR_DATE) AS INTEGER) AS year,
           CAST(month(CALENDAR_DATE) AS INTEGER) AS month, CAST(day(CALENDAR_DATE) AS INTEGER) AS day,
           CAST(quarter(CALENDAR_DATE) AS INTEGER) AS quarter,
           CAST(dayofweek(CALENDAR_DATE) + 1 AS INTEGER) AS day_of_week,
           monthname(CALENDAR_DATE) AS month_name, dayname(CALENDAR_DATE) AS day_name
    FROM calendar""")
def dim_calendar(spark, d):
    return star.dim_calendar(views.calendar(spark, d), RUN_TIME).drop("created_date")


@query("mod_4_fact_transactions", """
    SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount,
                      CAST(restocking_fee AS DOUBLE) AS restocking_fee, CAST(net_amount AS DOUBLE) AS net_amount)
    FROM fact""")
def fact_transactions(spark, d):
    return doubles(fact(spark, d, ALL_FACT))


@query("mod_5_customer_segments", """
    SELECT customer_name, CAST(total_spent AS DOUBLE) AS total_spent, total_orders, avg_order_value,
           last_order_date, CASE WHEN total_spent >= 1378616 THEN 'High Value' ELSE 'Regular' END AS customer_segment
    FROM spend""")
def customer_segments(spark, d):
    rows = fact(spark, d, [*SALE, "customer_name", "order_date"])
    return doubles(customers.customer_segments(rows, customers.spending_threshold(1378616)))


def _period_query(name, function, measures, kind, keys, extra=()):
    columns = ", ".join(PERIOD_SQL[k] for k in keys)
    sql = f"SELECT {columns}, {measures} FROM fact WHERE transaction_type = '{kind}' GROUP BY ALL"

    @query(name, sql)
    def run(spark, d):
        return doubles(function(fact(spark, d, [*SALE, "order_date", *extra])))


ALL_KEYS = ("year", "quarter", "month", "week")
_period_query("anl_1_sales_analytics", sales.sales_analytics, MEASURES, "SALE", ALL_KEYS)
_period_query("anl_2_refunds_analytics", sales.refunds_analytics, REFUND_MEASURES, "REFUND", ALL_KEYS, ["restocking_fee"])
_period_query("anl_3_weekly_sales", sales.weekly_sales, MEASURES, "SALE", ("year", "week"))
_period_query("anl_4_monthly_sales", sales.monthly_sales, MEASURES, "SALE", ("year", "month"))
_period_query("anl_5_quarterly_sales", sales.quarterly_sales, MEASURES, "SALE", ("year", "quarter"))
_period_query("anl_6_weekly_refunds", sales.weekly_refunds, REFUND_MEASURES, "REFUND", ("year", "week"), ["restocking_fee"])
_period_query("anl_7_monthly_refunds", sales.monthly_refunds, REFUND_MEASURES, "REFUND", ("year", "month"), ["restocking_fee"])
_period_query("anl_8_quarterly_refunds", sales.quarterly_refunds, REFUND_MEASURES, "REFUND", ("year", "quarter"), ["restocking_fee"])


PERIOD_TABLES = {
    "sales_analytics": ("SALE", ALL_KEYS), "weekly_sales": ("SALE", ("year", "week")),
    "monthly_sales": ("SALE", ("year", "month")), "quarterly_sales": ("SALE", ("year", "quarter")),
    "refunds_analytics": ("REFUND", ALL_KEYS), "weekly_refunds": ("REFUND", ("year", "week")),
    "monthly_refunds": ("REFUND", ("year", "month")), "quarterly_refunds": ("REFUND", ("year", "quarter"))}
PERIOD_MEASURES = {"SALE": ("total_sales", "avg_order_value", "total_orders"),
                   "REFUND": ("total_refunds", "total_restocking_fees", "total_refund_orders")}


def _period_table_sql(name):
    kind, keys = PERIOD_TABLES[name]
    columns = ", ".join(PERIOD_SQL[k] if k in keys else f"CAST(NULL AS INTEGER) AS {k}" for k in ALL_KEYS)
    value = {"SALE": "CAST(sum(net_amount) AS DOUBLE) / count(net_amount)", "REFUND": "CAST(sum(restocking_fee) AS DOUBLE)"}[kind]
    return (f"SELECT '{name}' AS \"table\", {columns}, CAST(sum(net_amount) AS DOUBLE) AS amount, {value} AS mean_or_fees, "
            f"count(order_number) AS lines FROM fact WHERE transaction_type = '{kind}' GROUP BY ALL")


@query("anl_1_to_8_period_tables", " UNION ALL ".join(map(_period_table_sql, PERIOD_TABLES)))
def period_tables(spark, d):
    found = sales.period_tables(fact(spark, d, [*SALE, "order_date", "restocking_fee"]))
    frames = []
    for name, (kind, keys) in PERIOD_TABLES.items():
        shown = [F.col(k) if k in keys else F.lit(None).cast("int").alias(k) for k in ALL_KEYS]
        values = [F.col(c).alias(n) for c, n in zip(PERIOD_MEASURES[kind], ("amount", "mean_or_fees", "lines"), strict=True)]
        frames.append(doubles(found[name].select(F.lit(name).alias("table"), *shown, *values)))
    return union_by_name(frames)


@query("anl_9_product_family_sales", f"""
    SELECT product_family, {MEASURES} FROM families WHERE transaction_type = 'SALE'
    GROUP BY product_family ORDER BY sum(net_amount) DESC, product_family""")
def product_family_sales(spark, d):
    return doubles(sales.product_family_sales(fact(spark, d, [*SALE, "product_code"])))


@query("anl_10_regional_rankings", """
    SELECT territory, product_code, product_family, CAST(total_sales AS DOUBLE) AS total_sales, total_orders,
           CAST(rank AS INTEGER) AS rank,
           CASE rank WHEN 1 THEN 'Best Selling' WHEN 2 THEN 'Second Best Selling' END AS ranking_type
    FROM rankings""")
def regional_rankings(spark, d):
    return doubles(products.regional_rankings(fact(spark, d, [*SALE, "territory", "product_code"])))


@query("anl_11_revenue_difference", """
    SELECT territory, best AS best_selling_revenue, second AS second_best_revenue,
           CAST(difference AS DOUBLE) AS revenue_difference,
           round(CAST(difference AS DOUBLE) / best * 100, 2) AS revenue_difference_pct
    FROM (SELECT territory, CAST(max(CASE WHEN rank = 1 THEN total_sales END) AS DOUBLE) AS best,
                 CAST(max(CASE WHEN rank = 2 THEN total_sales END) AS DOUBLE) AS second,
                 max(CASE WHEN rank = 1 THEN total_sales END)
                   - max(CASE WHEN rank = 2 THEN total_sales END) AS difference
          FROM rankings GROUP BY territory) t""")
def revenue_difference(spark, d):
    rankings = products.regional_rankings(fact(spark, d, [*SALE, "territory", "product_code"]))
    return doubles(products.revenue_difference(rankings))


@query("anl_12_enhanced_customer_segments", """
    SELECT * REPLACE (CAST(total_spent AS DOUBLE) AS total_spent) FROM segments""")
def enhanced_customer_segments(spark, d):
    rows = fact(spark, d, [*SALE, "customer_name", "order_date", "product_code"])
    return doubles(customers.percentile_customer_segments(rows))


@query("anl_13_daily_insights", """
    WITH days AS (
        SELECT strftime(order_date, '%Y-%m-%d') AS order_date_str, sum(net_amount) AS daily_sales,
               count(order_number) AS daily_orders, CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS daily_avg_order,
               count(DISTINCT customer_name) AS unique_customers, count(DISTINCT product_code) AS unique_products
        FROM fact WHERE transaction_type = 'SALE' GROUP BY order_date),
    cuts AS (
        SELECT list_sort(list(daily_sales))[CAST(ceil(CAST(0.33 AS DOUBLE) * count(*)) AS BIGINT)] AS p33,
               list_sort(list(daily_sales))[CAST(ceil(CAST(0.67 AS DOUBLE) * count(*)) AS BIGINT)] AS p67 FROM days)
    SELECT days.* REPLACE (CAST(daily_sales AS DOUBLE) AS daily_sales),
           CASE WHEN daily_sales >= p67 THEN 'High Sales Day' WHEN daily_sales >= p33 THEN 'Medium Sales Day'
                ELSE 'Low Sales Day' END AS sales_category
    FROM days, cuts""")
def daily_insights(spark, d):
    rows = fact(spark, d, [*SALE, "customer_name", "order_date", "product_code"])
    return doubles(sales.daily_insights(rows))


@query("anl_14_top_customers", """
    WITH best AS (
        SELECT customer_name, phone_number, address, CAST(sum(net_amount) AS DOUBLE) AS total_spent,
               count(order_number) AS total_orders,
               CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS avg_order_value
        FROM fact WHERE transaction_type = 'SALE' GROUP BY ALL
        ORDER BY sum(net_amount) DESC, customer_name, phone_number, address LIMIT 10),
    contacts AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(full_name)) ORDER BY full_name,
                       email NULLS LAST, phone NULLS LAST, city NULLS LAST, state NULLS LAST) AS rn FROM dim_customer) r
        WHERE rn = 1)
    SELECT best.*, email, phone, city, state
    FROM best LEFT JOIN contacts ON upper(trim(customer_name)) = upper(trim(full_name))""")
def top_customers(spark, d):
    rows = fact(spark, d, [*SALE, "customer_name", "phone_number", "address"])
    return doubles(customers.top_customers(rows, dimension(spark, d)))


@query("anl_15_refund_analysis", """
    SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount,
                      CAST(restocking_fee AS DOUBLE) AS restocking_fee, CAST(net_amount AS DOUBLE) AS net_amount),
           transaction_type = 'REFUND' AS is_refund,
           CAST(CASE WHEN transaction_type = 'REFUND' THEN total_amount * 0.90 ELSE total_amount END AS DOUBLE)
             AS calculated_final_amount,
           CAST(CASE WHEN transaction_type = 'REFUND' THEN total_amount * 0.10 ELSE 0 END AS DOUBLE)
             AS calculated_restocking_fee
    FROM fact""")
def refund_analysis(spark, d):
    return doubles(sales.refund_analysis(fact(spark, d, ALL_FACT)).drop("refund_calculation"))


@query("anl_16_fiscal_aggregations", """
    SELECT FISCAL_YEAR, FISCAL_QUARTER, FISCAL_MONTH_NAME, CAST(sum(net_amount) AS DOUBLE) AS fiscal_sales,
           count(order_number) AS fiscal_orders,
           CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS fiscal_avg_order
    FROM fact LEFT JOIN late_calendar ON strftime(order_date, '%Y-%m-%d') = CAST(CALENDAR_DATE AS VARCHAR)
    WHERE transaction_type = 'SALE' GROUP BY ALL""")
def fiscal_aggregations(spark, d):
    return doubles(sales.fiscal_aggregations(fact(spark, d, [*SALE, "order_date"]), views.calendar(spark, d, views.LATE_START)))


@query("anl_17_segment_counts", """
    SELECT customer_segment, count(*) AS count FROM segments GROUP BY customer_segment""")
def segment_counts(spark, d):
    rows = fact(spark, d, [*SALE, "customer_name", "order_date", "product_code"])
    return customers.segment_counts(customers.percentile_customer_segments(rows))


@query("anl_18_transaction_type_counts", """
    SELECT transaction_type, count(*) AS count FROM fact GROUP BY transaction_type""")
def transaction_type_counts(spark, d):
    return sales.transaction_type_counts(fact(spark, d, ["transaction_type"]))


@query("anl_19_territory_revenue", """
    SELECT territory, CAST(sum(net_amount) AS DOUBLE) AS total_revenue
    FROM fact WHERE transaction_type = 'SALE' GROUP BY territory ORDER BY sum(net_amount) DESC, territory""")
def territory_revenue(spark, d):
    return doubles(sales.territory_revenue(fact(spark, d, [*SALE, "territory"])))


@query("snk_10_preview", """
    SELECT order_number, product_code, CAST(total_amount AS DOUBLE) AS total_amount FROM fact
    WHERE transaction_type = 'REFUND' ORDER BY fact.total_amount, order_number, product_code LIMIT 50""")
def refund_preview(spark, d):
    rows = fact(spark, d, ["order_number", "product_code", "total_amount", "transaction_type"])
    refunds = rows.filter(F.col("transaction_type") == "REFUND").drop("transaction_type")
    return doubles(preview(refunds, [F.asc("total_amount"), F.asc("order_number"), F.asc("product_code")], 50))


@query("jn_1_join_by_normalised_name", """
    SELECT customer_name, CAST(total_spent AS DOUBLE) AS total_spent, email, phone
    FROM spend LEFT JOIN (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(full_name)) ORDER BY full_name,
                       email NULLS LAST, phone NULLS LAST) AS rn FROM dim_customer) r WHERE rn = 1) c
    ON upper(trim(customer_name)) = upper(trim(full_name))""")
def join_by_name(spark, d):
    spend = customers.customer_spend(fact(spark, d, [*SALE, "customer_name", "order_date"]))
    joined = with_contacts(spend.select("customer_name", "total_spent"), dimension(spark, d), ["email", "phone"])
    return doubles(joined)


@query("udf_1_product_family", "SELECT order_number, product_code, product_family FROM families")
def sql_product_family(spark, d):
    text.register_sql_functions(spark)
    rows = fact(spark, d, ["order_number", "product_code"])
    return rows.select("*", F.expr("product_family(product_code)").alias("product_family"))


@query("udf_2_create_customer_id", """
    SELECT phone1, lower(replace(concat(coalesce(first_name, 'None'), '_', coalesce(last_name, 'None'), '_',
                                        coalesce(email, 'None')), ' ', '_')) AS customer_id
    FROM customers""")
def sql_customer_id(spark, d):
    text.register_sql_functions(spark)
    return views.customers(spark, d).selectExpr(
        "phone1", "create_customer_id(first_name, last_name, email) AS customer_id")


@query("udf_3_restocking_fee", """
    SELECT order_number, CAST(CASE WHEN contains(lower(transaction_type), 'refund') THEN total_amount * 0.10
                              ELSE 0 END AS DOUBLE) AS fee FROM fact""")
def sql_restocking_fee(spark, d):
    text.register_sql_functions(spark)
    return fact(spark, d, ["order_number", "total_amount", "transaction_type"]).selectExpr(
        "order_number", "calculate_restocking_fee(total_amount, transaction_type) AS fee")


@query("udf_4_refund_with_fee", """
    SELECT order_number,
           CAST(CASE WHEN total_amount < 0 THEN total_amount * 0.90 ELSE total_amount END AS DOUBLE) AS final_amount,
           CAST(CASE WHEN total_amount < 0 THEN total_amount * 0.10 ELSE 0 END AS DOUBLE) AS restocking_fee
    FROM fact""")
def sql_refund_with_fee(spark, d):
    text.register_sql_functions(spark)
    rows = fact(spark, d, ["order_number", "total_amount", "transaction_type"])
    split = rows.selectExpr("order_number",
                            "calculate_refund_with_fee(total_amount, transaction_type = 'REFUND') AS refund")
    return split.select("order_number", "refund.final_amount", "refund.restocking_fee")
