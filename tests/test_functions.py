from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from storeloom.functions import dates, money, privacy, text
from storeloom.plans import star
from storeloom.sources import files


def values(df):
    return [r[0] for r in df.collect()]


def test_product_family_edges(spark):
    codes = spark.createDataFrame([("S10_4757",), ("abc",), ("_x",), ("",), (None,), ("a_b_c",)], "c string")
    assert values(codes.select(text.product_family(F.col("c")))) == ["S10", "UNKNOWN", "", "UNKNOWN", "UNKNOWN", "a"]


def test_customer_id_skips_nulls(spark):
    df = spark.createDataFrame([("Ann", "LEE", "A@B.co"), ("Ann", None, None), (None, None, None)],
                               "f string, l string, e string")
    ids = values(df.select(text.customer_id(F.col("f"), F.col("l"), F.col("e"))))
    assert ids == ["ann_lee_a@b.co", "ann", ""]


def test_printed_customer_id_prints_none(spark):
    df = spark.createDataFrame([("Mary Ann", "Lee", None)], "f string, l string, e string")
    assert values(df.select(text.printed_customer_id(F.col("f"), F.col("l"), F.col("e")))) == ["mary_ann_lee_none"]


def test_null_email_is_not_invalid(spark):
    df = spark.createDataFrame([("a@b.co",), ("bad",), ("a@b",), (None,)], "e string")
    assert df.filter(text.is_invalid_email(F.col("e"))).count() == 2


def test_fact_edges(spark):
    lines = spark.createDataFrame(
        [(1, 2, -100.0, "1/10/2003 0:00"), (2, 0, 0.0, "12/31/2020 23:59"), (3, 1, 4999.99, "#ERROR!"),
         (4, 3, 5000.0, None), (5, 4, None, "2/30/2020 0:00")],
        "ORDERNUMBER int, QUANTITYORDERED int, TOTAL_AMOUNT double, ORDERDATE string")
    names = ["order_number", "transaction_type", "restocking_fee", "net_amount", "unit_price", "is_large_order",
             "total_amount", "order_date"]
    got = {r["order_number"]: tuple(r)[1:] for r in star.fact_transactions(lines, columns=names).collect()}
    assert got[1] == ("REFUND", Decimal(10), Decimal(90), 50.0, False, Decimal(-100), date(2003, 1, 10))
    assert got[2] == ("SALE", Decimal(0), Decimal(0), None, False, Decimal(0), date(2020, 12, 31))
    assert got[3] == ("SALE", Decimal(0), Decimal("4999.99"), 4999.99, False, Decimal("4999.99"), None)
    assert got[4][4] is True and got[4][6] is None
    assert got[5] == ("SALE", Decimal(0), None, None, False, None, None)


def test_fee_and_net_add_up(spark):
    lines = spark.range(1, 5000).select((-F.col("id") / 100).alias("a")).select(money.money(F.col("a")).alias("a"))
    rate = Decimal("0.10")
    wrong = lines.filter(money.restocking_fee(F.col("a"), rate) + money.net_amount(F.col("a"), rate) != F.abs("a"))
    assert wrong.count() == 0


def test_money_types_stay_compact(spark):
    df = spark.createDataFrame([(1.0,)], "a double").select(money.money(F.col("a")).alias("a"))
    out = df.select(money.restocking_fee(F.col("a"), Decimal("0.10")).alias("f"),
                    money.net_amount(F.col("a"), Decimal("0.10")).alias("n"))
    assert [f.dataType.precision for f in out.schema] == [17, 18]


def test_too_large_amount_raises(spark):
    df = spark.createDataFrame([(1e15,)], "a double")
    with pytest.raises(ArithmeticException):
        df.select(money.money(F.col("a"))).collect()


def test_refund_split_keeps_the_sign(spark):
    df = spark.createDataFrame([(Decimal("-200.00"), True), (Decimal("50.00"), False), (None, True)],
                               "a decimal(14,2), r boolean")
    split = df.select(money.refund_split(F.col("a"), F.col("r")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in split] == [(Decimal(-180), Decimal(-20)), (Decimal(50), Decimal(0)), (None, None)]


def test_fee_by_status(spark):
    df = spark.createDataFrame([(Decimal(100), "Full REFUND"), (Decimal(100), "Shipped"), (Decimal(100), None)],
                               "a decimal(14,2), s string")
    assert values(df.select(money.fee_by_status(F.col("a"), F.col("s")))) == [Decimal(10), 0, 0]


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(Decimal(1), Decimal(3)), (Decimal(1), Decimal(0))], "p decimal(9,2), w decimal(9,2)")
    assert values(df.select(money.percent_of(F.col("p"), F.col("w")))) == [33.33, None]


def test_iso_week_of_new_year(spark):
    df = spark.createDataFrame([(date(2021, 1, 1),)], "d date")
    row = df.select(*dates.periods(F.col("d"), ["year", "week"])).first()
    assert tuple(row) == (2021, 53)


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(date(2010, 1, 31),)], "CALENDAR_DATE date")
    row = star.dim_calendar(df).drop("created_date").first()
    assert tuple(row) == (date(2010, 1, 31), 2010, 1, 31, 1, 1, "January", "Sunday")


def test_rename_drifted_prefers_first_value(spark):
    df = spark.createDataFrame([("1", None, "x", None), ("2", "z", None, "q")],
                               "id string, zip string, postal_code string, Province string")
    out = files.rename_drifted(df, files.CUSTOMER_HEADERS)
    assert out.columns == ["id", "postal_code", "state"]
    assert [tuple(r) for r in out.collect()] == [("1", "x", None), ("2", "z", "q")]


def test_masking(spark):
    df = spark.createDataFrame([("ann@b.co", "+001234567"), ("bad", "12"), ("n/a", "none"), (None, None)], "e string, p string")
    got = [tuple(r) for r in df.select(privacy.masked_email(F.col("e")), privacy.masked_phone(F.col("p"))).collect()]
    assert got == [("a***@b.co", "+*****4567"), ("***", "**"), ("***", "***"), (None, None)]


def test_sql_functions_are_inlined(spark):
    text.register_sql_functions(spark)
    df = spark.createDataFrame([("S10_1",)], "c string").selectExpr("product_family(c) AS f")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.first()[0] == "S10" and "Python" not in plan
    row = spark.sql("SELECT calculate_restocking_fee(100, 'Refund'), calculate_refund_with_fee(-50, true).final_amount").first()
    assert tuple(row) == (10.0, -45.0)


def test_totals_are_exact_for_any_fee_rate(spark):
    from dataclasses import replace
    from decimal import Decimal

    from storeloom.config import DEFAULT_RULES
    from storeloom.operators.periods import refund_measures
    from storeloom.plans import star

    lines = spark.range(1000).selectExpr("id AS ORDERNUMBER", "CAST(-0.33 AS DOUBLE) AS TOTAL_AMOUNT")
    rules = replace(DEFAULT_RULES, restocking_fee_rate=Decimal("0.125"))
    fact = star.fact_transactions(lines, rules, columns=["order_number", "net_amount", "restocking_fee"])
    row = fact.agg(*refund_measures(fact)).first()
    assert (row["total_refunds"], row["total_restocking_fees"]) == (Decimal("288.75"), Decimal("41.25"))


def test_scratch_without_a_checkpoint_folder(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = ("from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
            "from storeloom.scratch import scratch_root, stage\n"
            "assert stage(spark.range(3), 'x').count() == 3\n"
            "assert scratch_root(spark) == scratch_root(spark)\n")
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, cwd=Path(__file__).resolve().parents[1], timeout=180)
