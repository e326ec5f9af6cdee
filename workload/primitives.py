"""The relational and scalar operators of the sales model, one query each."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from storeloom.functions import dates, money, text
from storeloom.operators import joins
from storeloom.operators.combine import dedup_report, union_by_name
from storeloom.operators.large_ranks import row_numbers, top_by_value
from storeloom.operators.order_statistics import exact_percentiles, percentile_struct
from storeloom.operators.periods import sales_only
from storeloom.operators.quality import has_size, evaluate, profile_rules
from storeloom.operators.ranking import top_overall, top_per_group
from storeloom.plans import customers, products
from storeloom.scratch import stage
from storeloom.sources import files
from storeloom.sources import retail_views as views
from workload.registry import RUN_TIME, doubles, fact, query

LINE = ("order_number", "product_code", "total_amount")


# Projections

@query("prj_1_project_and_rename", """
    SELECT phone1 AS phone, company_name, concat_ws(' ', first_name, last_name) AS full_name FROM customers""")
def project(spark, d):
    return views.customers(spark, d).select(
        F.col("phone1").alias("phone"), "company_name",
        text.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"))


@query("prj_2_add_columns", """
    SELECT order_number, order_date, CAST(year(order_date) AS INTEGER) AS year,
           CAST(month(order_date) AS INTEGER) AS month FROM fact""")
def add_columns(spark, d):
    day = F.col("order_date")
    return fact(spark, d, ["order_number", "order_date"]).withColumns({"year": F.year(day), "month": F.month(day)})


@query("prj_3_literal_columns", "SELECT order_number, status, product_line FROM fact")
def literal_columns(spark, d):
    return fact(spark, d, ["order_number", "status", "product_line"])


@query("prj_4_struct_fields", """
    SELECT order_number, CAST(CASE WHEN total_amount < 0 THEN total_amount * 0.90 ELSE total_amount END AS DOUBLE)
             AS calculated_final_amount,
           CAST(CASE WHEN total_amount < 0 THEN total_amount * 0.10 ELSE 0 END AS DOUBLE) AS calculated_restocking_fee
    FROM fact""")
def struct_fields(spark, d):
    rows = fact(spark, d, ["order_number", "total_amount"])
    split = rows.select("*", money.refund_split(F.col("total_amount"), F.col("total_amount") < 0).alias("r"))
    return doubles(split.select("order_number", F.col("r.final_amount").alias("calculated_final_amount"),
                                F.col("r.restocking_fee").alias("calculated_restocking_fee")))


@query("prj_5_casts", """
    SELECT CAST(ORDERNUMBER AS BIGINT) AS order_number,
           CAST(CAST(TOTAL_AMOUNT AS DECIMAL(14,2)) AS DOUBLE) AS total_amount FROM transactions""")
def casts(spark, d):
    rows = views.transactions(spark, d, ["ORDERNUMBER", "TOTAL_AMOUNT"])
    return doubles(rows.select(F.col("ORDERNUMBER").cast("long").alias("order_number"),
                               money.money(F.col("TOTAL_AMOUNT")).alias("total_amount")))


@query("prj_6_header_drift", "SELECT phone1, postal_code, state FROM customers")
def header_drift(spark, d):
    drifted = views.customers(spark, d).select(
        "phone1",
        F.when(F.col("state").isNotNull(), F.col("postal_code")).alias("zip"),
        F.when(F.col("state").isNull(), F.col("postal_code")).alias("postal"),
        F.col("state").alias("province"))
    return files.rename_drifted(drifted, files.CUSTOMER_HEADERS)


@query("prj_7_audit_columns", """
    SELECT CALENDAR_DATE, DATE '2024-01-31' AS created_date, DATE '2024-01-31' AS updated_date FROM calendar""")
def audit_columns(spark, d):
    rows = files.with_audit(views.calendar(spark, d).select("CALENDAR_DATE"), RUN_TIME)
    return rows.withColumns({c: F.to_date(c) for c in ("created_date", "updated_date")})


@query("prj_8_lineage_columns", """
    SELECT o_orderkey, 'orders.parquet' AS source_file, DATE '2024-01-31' AS ingestion_date FROM orders""")
def lineage_columns(spark, d):
    rows = files.with_lineage(views.table(spark, d, "orders"), RUN_TIME)
    return rows.select("o_orderkey", F.substring_index("source_file", "/", -1).alias("source_file"),
                       F.to_date("ingestion_date").alias("ingestion_date"))


@query("prj_9_partition_day", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS partition_date FROM events")
def partition_day(spark, d):
    return files.with_partition_day(views.table(spark, d, "events").select("event_id", "ts"), "ts").drop("ts")


# Filters and conditions

@query("flt_1_equality", """
    SELECT order_number, product_code, CAST(total_amount AS DOUBLE) AS total_amount
    FROM fact WHERE transaction_type = 'REFUND'""")
def equality(spark, d):
    rows = fact(spark, d, [*LINE, "transaction_type"])
    return doubles(rows.filter(F.col("transaction_type") == money.REFUND).drop("transaction_type"))


@query("flt_2_rank_range", """
    SELECT territory, product_code, CAST(r AS INTEGER) AS rank FROM (
        SELECT territory, product_code, row_number() OVER (PARTITION BY territory
               ORDER BY total_orders DESC, product_code) AS r FROM product_sales) t WHERE r <= 5""")
def rank_range(spark, d):
    rows = fact(spark, d, ["transaction_type", "net_amount", "order_number", "territory", "product_code"])
    totals = products.territory_product_sales(rows).select("territory", "product_code", "total_orders")
    return top_per_group(totals, ["territory"], [F.desc("total_orders"), F.asc("product_code")], 5).drop("total_orders")


@query("flt_3_null_count", """
    SELECT count(*) FILTER (WHERE email IS NULL) AS email_null_count,
           count(*) FILTER (WHERE county IS NULL) AS county_null_count FROM customers""")
def null_count(spark, d):
    return profile_rules(views.customers(spark, d), {"email": {"null_check": True}, "county": {"null_check": True}})


@query("flt_4_negated_pattern", r"""
    SELECT phone1, email FROM customers
    WHERE NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')""")
def negated_pattern(spark, d):
    return views.customers(spark, d).filter(text.is_invalid_email(F.col("email"))).select("phone1", "email")


@query("cnd_1_two_way", """
    SELECT order_number, CAST(total_amount AS DOUBLE) AS total_amount, transaction_type, is_large_order FROM fact""")
def two_way(spark, d):
    return doubles(fact(spark, d, ["order_number", "total_amount", "transaction_type", "is_large_order"]))


@query("cnd_2_multi_way_with_else", """
    SELECT order_number, CASE WHEN abs(total_amount) >= 70000 THEN 'High' WHEN abs(total_amount) >= 30000 THEN 'Medium'
                              ELSE 'Low' END AS size_class FROM fact""")
def multi_way(spark, d):
    size = F.abs("total_amount")
    label = F.when(size >= 70000, "High").when(size >= 30000, "Medium").otherwise("Low")
    return fact(spark, d, ["order_number", "total_amount"]).select("order_number", label.alias("size_class"))


@query("cnd_3_multi_way_without_else", """
    SELECT territory, product_code, CASE r WHEN 1 THEN 'Best Selling' WHEN 2 THEN 'Second Best Selling' END
             AS ranking_type
    FROM (SELECT territory, product_code, row_number() OVER (PARTITION BY territory
                 ORDER BY total_sales DESC, product_code) AS r FROM product_sales) t WHERE r <= 4""")
def without_else(spark, d):
    rows = fact(spark, d, ["transaction_type", "net_amount", "order_number", "territory", "product_code"])
    return products.regional_rankings(rows, k=4).select("territory", "product_code", "ranking_type")


@query("cnd_4_boolean_column", "SELECT order_number, transaction_type = 'REFUND' AS is_refund FROM fact")
def boolean_column(spark, d):
    return fact(spark, d, ["order_number", "transaction_type"]).select(
        "order_number", (F.col("transaction_type") == money.REFUND).alias("is_refund"))


# Joins

@query("jn_2_join_calendar", """
    SELECT order_number, order_date, FISCAL_YEAR, FISCAL_QUARTER FROM fact
    LEFT JOIN late_calendar ON order_date = CALENDAR_DATE""")
def join_calendar(spark, d):
    days = views.calendar(spark, d, views.LATE_START).select("CALENDAR_DATE", "FISCAL_YEAR", "FISCAL_QUARTER")
    return joins.with_fiscal_day(fact(spark, d, ["order_number", "order_date"]), days).drop("CALENDAR_DATE")


@query("jn_3_semi_and_anti", """
    SELECT order_number, order_date, order_date IN (SELECT CALENDAR_DATE FROM late_calendar) AS has_day FROM fact""")
def semi_and_anti(spark, d):
    # Staged, so that lines and orders are joined once and not in two halves of a union that share the cores.
    rows = stage(fact(spark, d, ["order_number", "order_date"]), "fact_days")
    days = views.calendar(spark, d, views.LATE_START)
    key, dim_key = F.col("order_date"), F.col("CALENDAR_DATE")
    return union_by_name([joins.matched(rows, key, days, dim_key).withColumn("has_day", F.lit(True)),
                          joins.orphans(rows, key, days, dim_key).withColumn("has_day", F.lit(False))])


# Aggregates

@query("agg_1_group_by", """
    SELECT territory, deal_size, transaction_type, count(*) AS lines FROM fact GROUP BY ALL""")
def group_by(spark, d):
    keys = ["territory", "deal_size", "transaction_type"]
    return fact(spark, d, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))


@query("agg_2_sum", "SELECT deal_size, CAST(sum(net_amount) AS DOUBLE) AS total FROM fact GROUP BY deal_size")
def sums(spark, d):
    return doubles(fact(spark, d, ["deal_size", "net_amount"]).groupBy("deal_size").agg(F.sum("net_amount").alias("total")))


@query("agg_3_count_column", "SELECT city, count(email) AS with_email FROM customers GROUP BY city")
def count_column(spark, d):
    return views.customers(spark, d).groupBy("city").agg(F.count("email").alias("with_email"))


@query("agg_4_average", """
    SELECT deal_size, CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS mean FROM fact GROUP BY deal_size""")
def averages(spark, d):
    mean = money.average(F.sum("net_amount"), F.count("net_amount"))
    return fact(spark, d, ["deal_size", "net_amount"]).groupBy("deal_size").agg(mean.alias("mean"))


@query("agg_5_max_date", "SELECT customer_name, max(order_date) AS last_order_date FROM fact GROUP BY customer_name")
def max_date(spark, d):
    return fact(spark, d, ["customer_name", "order_date"]).groupBy("customer_name").agg(
        F.max("order_date").alias("last_order_date"))


@query("agg_6_distinct_counts", """
    SELECT territory, count(DISTINCT customer_name) AS unique_customers, count(DISTINCT product_code) AS unique_products
    FROM fact GROUP BY territory""")
def distinct_counts(spark, d):
    return fact(spark, d, ["territory", "customer_name", "product_code"]).groupBy("territory").agg(
        F.count_distinct("customer_name").alias("unique_customers"),
        F.count_distinct("product_code").alias("unique_products"))


@query("agg_7_group_count", "SELECT deal_size, count(*) AS count FROM fact GROUP BY deal_size")
def group_count(spark, d):
    return fact(spark, d, ["deal_size"]).groupBy("deal_size").count()


@query("agg_8_conditional", """
    SELECT territory, CAST(max(CASE WHEN transaction_type = 'SALE' THEN net_amount END) AS DOUBLE) AS best_sale,
           CAST(max(CASE WHEN transaction_type = 'REFUND' THEN net_amount END) AS DOUBLE) AS largest_refund
    FROM fact GROUP BY territory""")
def conditional(spark, d):
    kind = F.col("transaction_type")
    return doubles(fact(spark, d, ["territory", "transaction_type", "net_amount"]).groupBy("territory").agg(
        F.max(F.when(kind == money.SALE, F.col("net_amount"))).alias("best_sale"),
        F.max(F.when(kind == money.REFUND, F.col("net_amount"))).alias("largest_refund")))


@query("agg_9_percentiles", """
    SELECT CAST(0.33 AS DOUBLE) AS probability, CAST(p33 AS DOUBLE) AS value FROM spend_cuts
    UNION ALL SELECT CAST(0.67 AS DOUBLE), CAST(p67 AS DOUBLE) FROM spend_cuts""")
def percentiles(spark, d):
    rows = fact(spark, d, ["customer_name", "net_amount", "order_number", "transaction_type"])
    spend = sales_only(rows).groupBy("customer_name").agg(F.sum("net_amount").alias("total_spent"))
    return doubles(exact_percentiles(stage(spend, "spend"), "total_spent", [0.33, 0.67]))


@query("agg_11_distinct_rows", "SELECT DISTINCT PRODUCTCODE FROM transactions")
def distinct_rows(spark, d):
    return views.transactions(spark, d, ["PRODUCTCODE"]).distinct()


@query("agg_12_distinctness_ratio", """
    SELECT (count(DISTINCT county) + max(CASE WHEN county IS NULL THEN 1 ELSE 0 END)) / CAST(count(*) AS DOUBLE)
             AS county_unique_ratio,
           count(DISTINCT phone1) / CAST(count(*) AS DOUBLE) AS phone1_unique_ratio
    FROM customers""")
def distinctness_ratio(spark, d):
    return profile_rules(views.customers(spark, d), {"county": {"unique_check": True}, "phone1": {"unique_check": True}})


# Windows, sorts, limits

@query("win_1_row_number", """
    SELECT customer_name, order_number, product_code, CAST(total_amount AS DOUBLE) AS total_amount FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_name ORDER BY total_amount DESC, order_number,
               product_code, order_date) AS r FROM fact) t WHERE r = 1""")
def best_line(spark, d):
    rows = fact(spark, d, ["customer_name", *LINE, "order_date"])
    order = [F.desc("total_amount"), F.asc("order_number"), F.asc("product_code"), F.asc("order_date")]
    return doubles(top_per_group(rows, ["customer_name"], order, 1).drop("rank", "order_date"))


@query("win_2_top_k_per_group", """
    SELECT territory, product_code, CAST(total_sales AS DOUBLE) AS total_sales, CAST(rank AS INTEGER) AS rank
    FROM rankings""")
def top_k_per_group(spark, d):
    rows = fact(spark, d, ["transaction_type", "net_amount", "order_number", "territory", "product_code"])
    totals = products.territory_product_sales(rows).select("territory", "product_code", "total_sales")
    return doubles(top_per_group(totals, ["territory"], [F.desc("total_sales"), F.asc("product_code")], 2))


@query("win_2_top_of_large_groups", """
    SELECT * FROM (SELECT TERRITORY, TOTAL_AMOUNT, ORDERNUMBER, ORDERLINENUMBER,
                          row_number() OVER (PARTITION BY TERRITORY ORDER BY TOTAL_AMOUNT DESC NULLS LAST, ORDERNUMBER, ORDERLINENUMBER) AS rank
                   FROM transactions) r
    WHERE rank <= 5000""")
def top_of_large_groups(spark, d):
    """More rows a territory than Spark's group limit takes."""
    lines = views.transactions(spark, d, ["TERRITORY", "TOTAL_AMOUNT", "ORDERNUMBER", "ORDERLINENUMBER"])
    exact = lines.withColumn("TOTAL_AMOUNT", money.money(F.col("TOTAL_AMOUNT")))
    found = top_by_value(stage(exact, "lines"), ["TERRITORY"], "TOTAL_AMOUNT", [F.asc("ORDERNUMBER"), F.asc("ORDERLINENUMBER")], 5000)
    return doubles(found.select("TERRITORY", "TOTAL_AMOUNT", "ORDERNUMBER", "ORDERLINENUMBER", "rank"))


@query("set_2_repeats_after_the_first", """
    SELECT ORDERNUMBER, count(*) AS repeats FROM (
        SELECT ORDERNUMBER, row_number() OVER (PARTITION BY ORDERNUMBER ORDER BY TOTAL_AMOUNT, ORDERLINENUMBER) AS n FROM transactions) r
    WHERE n > 1 GROUP BY ORDERNUMBER""")
def repeats_after_the_first(spark, d):
    lines = views.transactions(spark, d, ["ORDERNUMBER", "TOTAL_AMOUNT", "ORDERLINENUMBER"])
    numbered = row_numbers(lines, ["ORDERNUMBER"], [F.asc("TOTAL_AMOUNT"), F.asc("ORDERLINENUMBER")], "n")
    return numbered.filter("n > 1").groupBy("ORDERNUMBER").agg(F.count(F.lit(1)).alias("repeats"))


@query("srt_1_sort_descending", """
    SELECT product_code, count(*) AS lines FROM fact GROUP BY product_code ORDER BY lines DESC, product_code""")
def sort_descending(spark, d):
    return fact(spark, d, ["product_code"]).groupBy("product_code").agg(F.count(F.lit(1)).alias("lines")).orderBy(
        F.desc("lines"), "product_code")


@query("srt_2_sort_two_keys", """
    SELECT DISTINCT FISCAL_YEAR, FISCAL_QUARTER FROM calendar ORDER BY FISCAL_YEAR, FISCAL_QUARTER""")
def sort_two_keys(spark, d):
    return views.calendar(spark, d).select("FISCAL_YEAR", "FISCAL_QUARTER").distinct().orderBy(
        "FISCAL_YEAR", "FISCAL_QUARTER")


@query("lim_1_top_k", """
    SELECT customer_name, CAST(total_spent AS DOUBLE) AS total_spent FROM spend
    ORDER BY spend.total_spent DESC, customer_name LIMIT 10""")
def top_k(spark, d):
    spend = customers.customer_spend(fact(spark, d, ["customer_name", "net_amount", "order_number",
                                                     "transaction_type", "order_date"]))
    return doubles(top_overall(spend.select("customer_name", "total_spent"),
                               [F.desc("total_spent"), F.asc("customer_name")], 10))


@query("lim_2_limit", """
    SELECT phone1, company_name, city FROM customers ORDER BY phone1 LIMIT 30""")
def limited(spark, d):
    return top_overall(views.customers(spark, d).select("phone1", "company_name", "city"), [F.asc("phone1")], 30)


# Union and deduplication

@query("set_1_union_by_name", """
    SELECT phone1, city, county, CAST(NULL AS VARCHAR) AS email FROM customers WHERE state IS NULL
    UNION ALL SELECT phone1, city, NULL, email FROM customers WHERE state IS NOT NULL""")
def union_drifting(spark, d):
    rows = views.customers(spark, d)
    return union_by_name([rows.filter(F.col("state").isNull()).select("phone1", "city", "county"),
                          rows.filter(F.col("state").isNotNull()).select("phone1", "city", "email")])


@query("set_2_dedup_on_key", """
    SELECT customer_id, email, source_file FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY source_file) AS rn FROM identified) t
    WHERE rn = 1""")
def dedup_on_key(spark, d):
    raw = views.repeated_customers(spark, d).withColumn("ingestion_date", F.lit(RUN_TIME))
    return files.identify_customers(raw).select("customer_id", "email", "source_file")


@query("set_3_dedup_counts", """
    SELECT CAST(count(*) AS BIGINT) AS rows_before, count(DISTINCT customer_id) AS rows_after FROM identified""")
def dedup_counts(spark, d):
    rows = views.repeated_customers(spark, d).select(text.customer_id(
        F.col("first_name"), F.col("last_name"), F.col("email")).alias("customer_id"))
    return dedup_report(rows, ["customer_id"])


# Scalar functions

@query("str_1_customer_id", "SELECT phone1, customer_id FROM identified")
def customer_ids(spark, d):
    return views.repeated_customers(spark, d).select("phone1", text.customer_id(
        F.col("first_name"), F.col("last_name"), F.col("email")).alias("customer_id"))


@query("str_2_full_name", "SELECT order_number, customer_name FROM fact")
def full_names(spark, d):
    return fact(spark, d, ["order_number", "customer_name"])


@query("str_3_normalised_name", "SELECT phone1, upper(trim(company_name)) AS name_key FROM customers")
def normalised_name(spark, d):
    return views.customers(spark, d).select("phone1", text.name_key(F.col("company_name")).alias("name_key"))


@query("str_4_product_family", """
    SELECT DISTINCT product_code, product_family FROM families
    UNION ALL SELECT p_name, CASE WHEN instr(p_name, '_') > 0 THEN split_part(p_name, '_', 1) ELSE 'UNKNOWN' END FROM part""")
def product_families(spark, d):
    codes = views.transactions(spark, d, ["PRODUCTCODE"]).distinct().select(F.col("PRODUCTCODE").alias("product_code"))
    names = views.table(spark, d, "part").select(F.col("p_name").alias("product_code"))
    return union_by_name([codes, names]).select(
        "product_code", text.product_family(F.col("product_code")).alias("product_family"))


@query("str_5_printed_customer_id", """
    SELECT phone1, lower(replace(concat(company_name, '_', last_name, '_', coalesce(email, 'None')), ' ', '_'))
             AS customer_id FROM customers""")
def printed_customer_ids(spark, d):
    return views.customers(spark, d).select("phone1", text.printed_customer_id(
        F.col("company_name"), F.col("last_name"), F.col("email")).alias("customer_id"))


@query("str_6_email_pattern", r"""
    SELECT phone1, regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') AS is_valid
    FROM customers""")
def email_pattern(spark, d):
    return views.customers(spark, d).select("phone1", F.col("email").rlike(text.EMAIL_PATTERN).alias("is_valid"))


@query("str_7_contains_ignoring_case", """
    SELECT o_orderkey, contains(lower(o_orderpriority), 'high') AS is_high FROM orders""")
def contains_ignoring_case(spark, d):
    return views.table(spark, d, "orders").select(
        "o_orderkey", text.mentions(F.col("o_orderpriority"), "High").alias("is_high"))


@query("mth_1_abs", "SELECT order_number, CAST(abs(total_amount) AS DOUBLE) AS size FROM fact")
def absolute(spark, d):
    return doubles(fact(spark, d, ["order_number", "total_amount"]).select("order_number", F.abs("total_amount").alias("size")))


@query("mth_2_unit_price", "SELECT order_number, quantity, unit_price FROM fact")
def unit_prices(spark, d):
    return fact(spark, d, ["order_number", "quantity", "unit_price"])


@query("mth_3_fee_and_net", """
    SELECT order_number, CAST(restocking_fee AS DOUBLE) AS restocking_fee, CAST(net_amount AS DOUBLE) AS net_amount
    FROM fact""")
def fee_and_net(spark, d):
    return doubles(fact(spark, d, ["order_number", "restocking_fee", "net_amount"]))


@query("mth_4_rounded_percentage", """
    SELECT territory, round(CAST(sum(CASE WHEN transaction_type = 'REFUND' THEN net_amount END) AS DOUBLE)
                            / CAST(sum(net_amount) AS DOUBLE) * 100, 2) AS refund_pct
    FROM fact GROUP BY territory""")
def rounded_percentage(spark, d):
    refunds = F.sum(F.when(F.col("transaction_type") == money.REFUND, F.col("net_amount")))
    return fact(spark, d, ["territory", "transaction_type", "net_amount"]).groupBy("territory").agg(
        money.percent_of(refunds, F.sum("net_amount")).alias("refund_pct"))


@query("dt_1_order_date", "SELECT order_number, order_date FROM fact")
def order_dates(spark, d):
    return fact(spark, d, ["order_number", "order_date"])


@query("dt_2_year_quarter_month", """
    SELECT CALENDAR_DATE, CAST(year(CALENDAR_DATE) AS INTEGER) AS year, CAST(quarter(CALENDAR_DATE) AS INTEGER) AS quarter,
           CAST(month(CALENDAR_DATE) AS INTEGER) AS month FROM calendar""")
def year_quarter_month(spark, d):
    day = F.col("CALENDAR_DATE")
    return views.calendar(spark, d).select(day, *dates.periods(day, ["year", "quarter", "month"]))


@query("dt_3_iso_week", "SELECT CALENDAR_DATE, CAST(week(CALENDAR_DATE) AS INTEGER) AS week FROM calendar")
def iso_week(spark, d):
    day = F.col("CALENDAR_DATE")
    return views.calendar(spark, d).select(day, *dates.periods(day, ["week"]))


@query("dt_4_day_numbers", """
    SELECT CALENDAR_DATE, CAST(day(CALENDAR_DATE) AS INTEGER) AS day,
           CAST(dayofweek(CALENDAR_DATE) + 1 AS INTEGER) AS day_of_week FROM calendar""")
def day_numbers(spark, d):
    day = F.col("CALENDAR_DATE")
    attributes = dates.calendar_attributes(day)
    return views.calendar(spark, d).select(day, *[attributes[n].alias(n) for n in ("day", "day_of_week")])


@query("dt_5_date_formats", """
    SELECT CALENDAR_DATE, strftime(CALENDAR_DATE, '%Y-%m-%d') AS text, monthname(CALENDAR_DATE) AS month_name,
           dayname(CALENDAR_DATE) AS day_name FROM calendar""")
def date_formats(spark, d):
    day = F.col("CALENDAR_DATE")
    attributes = dates.calendar_attributes(day)
    return views.calendar(spark, d).select(day, dates.day_text(day).alias("text"),
                                           *[attributes[n].alias(n) for n in ("month_name", "day_name")])


@query("dt_6_run_time", "SELECT DISTINCT PRODUCTCODE, '2024-01-31 06:00:00' AS created FROM transactions")
def run_time(spark, d):
    codes = views.transactions(spark, d, ["PRODUCTCODE"]).distinct()
    return codes.select("PRODUCTCODE", F.date_format(files.run_clock(RUN_TIME), "yyyy-MM-dd HH:mm:ss").alias("created"))


@query("udf_5_size_predicate", "SELECT count(*) >= 1000 AS passed FROM transactions")
def size_predicate(spark, d):
    result = evaluate(views.transactions(spark, d, ["ORDERNUMBER"]), [has_size(1000)])
    return result.select((F.col("status") == "Success").alias("passed"))


@query("udf_3_fee_by_status_expression", """
    SELECT order_number, CAST(CASE WHEN transaction_type = 'REFUND' THEN total_amount * 0.25 ELSE 0 END AS DOUBLE) AS fee
    FROM fact""")
def fee_by_status(spark, d):
    rows = fact(spark, d, ["order_number", "total_amount", "transaction_type"])
    fee = money.fee_by_status(F.col("total_amount"), F.col("transaction_type"), Decimal("0.25"))
    return doubles(rows.select("order_number", fee.alias("fee")))


@query("agg_9_order_size_cuts", """
    WITH sizes AS (SELECT order_number, sum(net_amount) AS order_value FROM fact GROUP BY order_number),
    cuts AS (SELECT list_sort(list(order_value))[CAST(ceil(CAST(0.1 AS DOUBLE) * count(*)) AS BIGINT)] AS lo,
                    list_sort(list(order_value))[CAST(ceil(CAST(0.9 AS DOUBLE) * count(*)) AS BIGINT)] AS hi FROM sizes)
    SELECT order_number, CAST(order_value AS DOUBLE) AS order_value FROM sizes, cuts WHERE order_value >= hi OR order_value < lo""")
def order_size_cuts(spark, d):
    values = fact(spark, d, ["order_number", "net_amount"]).groupBy("order_number").agg(
        F.sum("net_amount").alias("order_value"))
    staged = stage(values, "order_values")
    cuts = percentile_struct(staged, "order_value", 0.1, 0.9)
    return doubles(staged.filter((F.col("order_value") >= cuts.getField("upper"))
                                 | (F.col("order_value") < cuts.getField("lower"))))
