"""Quality checks over the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from storeloom.config import DEFAULT_THRESHOLDS
from storeloom.functions import text
from storeloom.operators import metric_states
from storeloom.operators import quality as dq
from storeloom.operators.combine import union_by_name
from storeloom.plans import star
from storeloom.scratch import scratch_dir, stage
from storeloom.sources import retail_views as views
from workload.analytics import dimension
from workload.registry import doubles, fact, query

RESULT = ["check", "constraint", "level", "status", "value"]


def verdict_sql(name: str, constraint: str, level: str, value: str, source: str, limit: float) -> str:
    return (f"SELECT '{name}' AS \"check\", '{constraint}' AS \"constraint\", '{level}' AS level, "
            f"CASE WHEN v >= {limit} THEN 'Success' ELSE 'Failure' END AS status, v AS value "
            f"FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source}) q")


def completeness(column: str) -> str:
    return f"CAST(count({column}) AS DOUBLE) / count(*)"


def once(column: str, source: str) -> str:
    return f"(SELECT n FROM (SELECT count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}) g) h"


ONCE_SHARE = "CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n)"
EMAIL_SHARE = (r"1 - CAST(count(*) FILTER (WHERE NOT regexp_matches(email, "
               r"'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')) AS DOUBLE) / count(*)")


def lines(spark, d):
    return views.transactions(spark, d, ["ORDERNUMBER", "PRODUCTCODE", "CUSTOMERNAME"])


def identified(spark, d):
    rows = views.repeated_customers(spark, d)
    return rows.withColumn("customer_id", text.customer_id(F.col("first_name"), F.col("last_name"), F.col("email")))


@query("dq_1_size", verdict_sql("size_at_least_1000", "size(*) >= 1000", "Error", "count(*)", "transactions", 1000))
def size(spark, d):
    return dq.evaluate(lines(spark, d), [dq.has_size(1000)]).select(*RESULT)


@query("dq_2_completeness", verdict_sql("county_not_null", "completeness(county) >= 1", "Error",
                                        completeness("county"), "customers", 1)
       + " UNION ALL " + verdict_sql("phone1_not_null", "completeness(phone1) >= 1", "Error",
                                     completeness("phone1"), "customers", 1))
def completeness_checks(spark, d):
    return dq.evaluate(views.customers(spark, d), [dq.not_null("county"), dq.not_null("phone1")]).select(*RESULT)


@query("dq_3_uniqueness", verdict_sql("o_custkey_unique", "uniqueness(o_custkey) >= 1", "Error", ONCE_SHARE,
                                      once("o_custkey", "orders"), 1)
       + " UNION ALL " + verdict_sql("o_orderkey_unique", "uniqueness(o_orderkey) >= 1", "Error", ONCE_SHARE,
                                     once("o_orderkey", "orders"), 1))
def uniqueness(spark, d):
    checks = [dq.unique("o_custkey"), dq.unique("o_orderkey")]
    return dq.evaluate(views.table(spark, d, "orders"), checks).select(*RESULT)


@query("dq_4_run_all", " UNION ALL ".join([
    verdict_sql("size_at_least_1000", "size(*) >= 1000", "Error", "count(*)", "identified", 1000),
    verdict_sql("customer_id_not_null", "completeness(customer_id) >= 1", "Error", completeness("customer_id"), "identified", 1),
    verdict_sql("customer_id_unique", "uniqueness(customer_id) >= 1", "Error", ONCE_SHARE, once("customer_id", "identified"), 1),
    verdict_sql("email_format", "validity(email) >= 1", "Warning", EMAIL_SHARE, "identified", 1)]))
def run_all(spark, d):
    return dq.evaluate(identified(spark, d), [*dq.CUSTOMER_SUITE, dq.email_format()]).select(*RESULT)


@query("dq_5_email_format", r"""
    SELECT count(*) FILTER (WHERE NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'))
             AS invalid_emails FROM customers""")
def invalid_emails(spark, d):
    return views.customers(spark, d).agg(F.count_if(text.is_invalid_email(F.col("email"))).alias("invalid_emails"))


@query("dq_6_rule_profile", """
    SELECT count(*) FILTER (WHERE email IS NULL) AS email_null_count,
           (count(DISTINCT email) + max(CASE WHEN email IS NULL THEN 1 ELSE 0 END)) / CAST(count(*) AS DOUBLE)
             AS email_unique_ratio,
           count(*) FILTER (WHERE state IS NULL) AS state_null_count FROM customers""")
def rule_profile(spark, d):
    rules = {"email": {"null_check": True, "unique_check": True}, "state": {"null_check": True},
             "no_such_column": {"null_check": True}}
    return dq.profile_rules(views.customers(spark, d), rules)


def _entity(sql: str, name: str) -> str:
    return f"SELECT '{name}' AS entity, s.* FROM ({sql}) s"


@query("dq_7_suites", " UNION ALL ".join([
    _entity(verdict_sql("size_at_least_1000", "size(*) >= 1000", "Error", "count(*)", "dim_customer", 1000), "customers"),
    _entity(verdict_sql("customer_id_not_null", "completeness(customer_id) >= 1", "Error",
                        completeness("customer_key"), "dim_customer", 1), "customers"),
    _entity(verdict_sql("customer_id_unique", "uniqueness(customer_id) >= 1", "Error", ONCE_SHARE,
                        once("customer_key", "dim_customer"), 1), "customers"),
    _entity(verdict_sql("size_at_least_1000", "size(*) >= 1000", "Error", "count(*)", "transactions", 1000), "transactions"),
    *[_entity(verdict_sql(f"{c}_not_null", f"completeness({c}) >= 1", "Error", completeness(c), "transactions", 1),
              "transactions") for c in ("ORDERNUMBER", "PRODUCTCODE", "CUSTOMERNAME")],
    _entity(verdict_sql("size_at_least_5000", "size(*) >= 5000", "Warning", "count(*)", "calendar", 5000), "calendar"),
    _entity(verdict_sql("CALENDAR_DATE_not_null", "completeness(CALENDAR_DATE) >= 1", "Warning",
                        completeness("CALENDAR_DATE"), "calendar", 1), "calendar"),
    _entity(verdict_sql("CALENDAR_DATE_unique", "uniqueness(CALENDAR_DATE) >= 1", "Warning", ONCE_SHARE,
                        once("CALENDAR_DATE", "calendar"), 1), "calendar")]))
def suites(spark, d):
    frames = [
        ("customers", dimension(spark, d).withColumnRenamed("customer_key", "customer_id"), dq.CUSTOMER_SUITE),
        ("transactions", lines(spark, d), dq.TRANSACTION_SUITE),
        ("calendar", views.calendar(spark, d), dq.at_level(dq.CALENDAR_SUITE, dq.WARNING)),
    ]
    return union_by_name([dq.evaluate(df, checks).select(F.lit(name).alias("entity"), *RESULT)
                          for name, df, checks in frames])


@query("dq_8_referential_integrity", """
    WITH days AS (SELECT CAST(count(*) FILTER (WHERE CALENDAR_DATE IS NULL) AS DOUBLE) / count(*) AS share
                  FROM fact LEFT JOIN late_calendar ON order_date = CALENDAR_DATE),
    codes AS (SELECT CAST(count(*) FILTER (WHERE k IS NULL) AS DOUBLE) / count(*) AS share
              FROM fact LEFT JOIN (SELECT DISTINCT product_code AS k FROM families) p ON product_code = k)
    SELECT 'order_date_in_CALENDAR_DATE' AS "check", share, CAST(0.05 AS DOUBLE) AS "limit",
           CASE WHEN share <= 0.05 THEN 'Success' ELSE 'Failure' END AS status FROM days
    UNION ALL
    SELECT 'product_code_in_product_key', share, CAST(0.05 AS DOUBLE),
           CASE WHEN share <= 0.05 THEN 'Success' ELSE 'Failure' END FROM codes""")
def referential_integrity(spark, d):
    limit = DEFAULT_THRESHOLDS.orphaned_share
    dim = star.dim_product(views.transactions(spark, d, ["PRODUCTCODE"]))
    return union_by_name([
        dq.referential_integrity(fact(spark, d, ["order_date"]), "order_date", views.calendar(spark, d, views.LATE_START),
                                 "CALENDAR_DATE", limit),
        dq.referential_integrity(fact(spark, d, ["product_code"]), "product_code", dim, "product_key", limit)])


@query("dq_9_anomalies", """
    WITH sizes AS (SELECT order_number, sum(net_amount) AS order_value FROM fact GROUP BY order_number),
    q AS (SELECT CAST(list_sort(list(order_value))[CAST(ceil(CAST(0.25 AS DOUBLE) * count(*)) AS BIGINT)] AS DOUBLE) AS lo,
                 CAST(list_sort(list(order_value))[CAST(ceil(CAST(0.75 AS DOUBLE) * count(*)) AS BIGINT)] AS DOUBLE) AS hi
          FROM sizes)
    SELECT order_number, CAST(order_value AS DOUBLE) AS order_value,
           CAST(order_value AS DOUBLE) < lo - (hi - lo) * 1.5 OR CAST(order_value AS DOUBLE) > hi + (hi - lo) * 1.5
             AS is_anomaly
    FROM sizes, q""")
def order_anomalies(spark, d):
    values = fact(spark, d, ["order_number", "net_amount"]).groupBy("order_number").agg(
        F.sum("net_amount").alias("order_value"))
    return doubles(dq.anomalies(stage(values, "order_values"), "order_value"))


@query("dq_10_ratio_thresholds", " UNION ALL ".join([
    verdict_sql("county_not_null", "completeness(county) >= 0.95", "Error", completeness("county"), "customers", 0.95),
    verdict_sql("email_not_null", "completeness(email) >= 0.95", "Error", completeness("email"), "customers", 0.95),
    verdict_sql("email_format", "validity(email) >= 0.9", "Warning", EMAIL_SHARE, "customers", 0.9)]))
def ratio_thresholds(spark, d):
    limits = DEFAULT_THRESHOLDS
    return dq.evaluate(views.customers(spark, d), [
        dq.not_null("county", min_ratio=limits.completeness), dq.not_null("email", min_ratio=limits.completeness),
        dq.email_format(min_ratio=limits.email_validity)]).select(*RESULT)


@query("dq_11_pattern_and_sign", " UNION ALL ".join([
    verdict_sql("product_code_format", "validity(product_code) >= 1", "Error",
                "1 - CAST(count(*) FILTER (WHERE NOT regexp_matches(product_code, '^S[0-9]+_[0-9]+$')) AS DOUBLE) / count(*)",
                "fact", 1),
    verdict_sql("total_amount_positive", "positivity(total_amount) >= 1", "Warning",
                "CAST(count(*) - count(*) FILTER (WHERE total_amount <= 0) AS DOUBLE) / count(*)", "fact", 1)]))
def pattern_and_sign(spark, d):
    rows = fact(spark, d, ["product_code", "total_amount"])
    return dq.evaluate(rows, [dq.product_code_format("product_code"), dq.positive("total_amount")]).select(*RESULT)


@query("dq_12_quarantine", r"""
    SELECT phone1, concat_ws(',',
             CASE WHEN NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') THEN 'email_format' END,
             CASE WHEN email IS NULL THEN 'email_missing' END,
             CASE WHEN state IS NULL THEN 'state_missing' END) AS reasons,
           (NOT coalesce(regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'), true)
            OR email IS NULL OR state IS NULL) AS rejected
    FROM customers""")
def quarantine(spark, d):
    rules = {"email_format": F.col("email").rlike(text.EMAIL_PATTERN), "email_missing": F.col("email").isNotNull(),
             "state_missing": F.col("state").isNotNull()}
    good, rejects = dq.quarantine(views.customers(spark, d), rules)
    return union_by_name([
        good.select("phone1", F.lit("").alias("reasons"), F.lit(False).alias("rejected")),
        rejects.select("phone1", F.array_join("reject_reasons", ",").alias("reasons"), F.lit(True).alias("rejected"))])


def _profile_sql(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, count(*) AS row_count, count(*) - count({column}) AS null_count, "
            f"count(DISTINCT {column}) AS distinct_count, CAST(count({column}) AS DOUBLE) / count(*) AS completeness, "
            f"CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value FROM fact")


PROFILED = ["order_number", "quantity", "product_code", "territory", "order_date"]


@query("dq_13_column_profile", " UNION ALL ".join(_profile_sql(c) for c in PROFILED))
def column_profile(spark, d):
    return dq.profile_columns(fact(spark, d, PROFILED), PROFILED)


def record_thirds(spark, d, path, checks, columns):
    """The lines in three deliveries by their order number, each recorded by itself; the first two are merged."""
    rows = fact(spark, d, PROFILED)
    fields = rows.select(*columns).schema
    for number in range(3):
        metric_states.record(rows.filter(F.pmod("order_number", F.lit(3)) == number), path, number, checks, columns)
        if number == 1:
            metric_states.merge(spark, path, fields)
    return fields


@query("dq_13_profile_from_states", " UNION ALL ".join(
    _profile_sql(c).replace(" AS max_value FROM fact", " AS max_value, (count(DISTINCT {0}) + max(CASE WHEN {0} IS NULL THEN 1 ELSE 0 END))"
                            " / CAST(count(*) AS DOUBLE) AS unique_ratio FROM fact".format(c)) for c in PROFILED))
def profile_from_states(spark, d):
    path = scratch_dir(spark, "metric-states")
    return metric_states.profile(spark, path, record_thirds(spark, d, path, [], PROFILED))


@query("dq_3_checks_from_states", " UNION ALL ".join([
    verdict_sql("size_at_least_1000", "size(*) >= 1000", "Error", "count(*)", "fact", 1000),
    verdict_sql("territory_not_null", "completeness(territory) >= 1", "Error", completeness("territory"), "fact", 1),
    verdict_sql("product_code_format", "validity(product_code) >= 1", "Error",
                "1 - CAST(count(*) FILTER (WHERE NOT regexp_matches(product_code, '^S[0-9]+_[0-9]+$')) AS DOUBLE) / count(*)",
                "fact", 1),
    verdict_sql("order_number_unique", "uniqueness(order_number) >= 1", "Error", ONCE_SHARE, once("order_number", "fact"), 1),
    verdict_sql("product_code_unique", "uniqueness(product_code) >= 0", "Error", ONCE_SHARE, once("product_code", "fact"), 0)]))
def checks_from_states(spark, d):
    path = scratch_dir(spark, "metric-states")
    checks = [dq.has_size(1000), dq.not_null("territory"), dq.product_code_format("product_code"), dq.unique("order_number"),
              dq.unique("product_code", min_ratio=0.0)]
    fields = record_thirds(spark, d, path, checks, ["order_number", "product_code"])
    return metric_states.evaluate(spark, path, checks, fields).select(*RESULT)
