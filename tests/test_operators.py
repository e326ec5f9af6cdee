import math
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storeloom.operators import combine, history, joins, ranking
from storeloom.operators.order_statistics import exact_percentiles, percentile_struct, rank_within
from storeloom.operators.periods import refunds_by_period, sales_by_period
from storeloom.plans import customers, products, sales


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_union_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    assert rows(combine.union_by_name([a, b])) == [(1, "x", None), (2, None, "y")]


def test_latest_per_key_limits_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), (None, 1, "n")], "k string, v int, s string")
    out = combine.latest_per_key(df, ["k"], [F.desc("v"), F.asc("s")])
    assert rows(out) == [(None, 1, "n"), ("k", 2, "b")]
    assert "Partial" in plan_of(out) and "WindowGroupLimit" in plan_of(out)


def test_dedup_report(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert tuple(combine.dedup_report(df, ["k"]).first()) == (4, 3)
    assert tuple(combine.dedup_report(df.limit(0), ["k"]).first()) == (0, 0)


@pytest.mark.parametrize("kind,scale", [("decimal(18,2)", 2), ("decimal(28,4)", 4), ("bigint", 0)])
def test_exact_percentiles_match_sorting(spark, kind, scale):
    rng = random.Random(7)
    units = [rng.choice([0, 0, 0, -5, rng.randrange(-10 ** 14, 10 ** 14), rng.randrange(-3000, 3000)])
             for _ in range(701)]
    data = [(Decimal(u).scaleb(-scale) if scale else u,) for u in units] + [(None,)] * 9
    df = spark.createDataFrame(data, f"v {kind}")
    probabilities = [0.0, 0.001, 0.25, 0.33, 0.5, 0.67, 0.9, 1.0]
    got = {r["probability"]: r["value"] for r in exact_percentiles(df, "v", probabilities).collect()}
    ordered = sorted(v for (v,) in data if v is not None)
    for p in probabilities:
        assert got[p] == ordered[max(1, math.ceil(p * len(ordered))) - 1]


def test_percentiles_of_extreme_longs(spark):
    values = [-(1 << 63) + 1, -(1 << 42), -1, 0, 1, (1 << 42) - 1, (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = sorted(r["value"] for r in exact_percentiles(df, "v", [(i + 0.5) / 7 for i in range(7)]).collect())
    assert got == values


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([], "v decimal(18,2)")
    assert exact_percentiles(df, "v", [0.5]).count() == 0
    assert df.withColumn("t", percentile_struct(df, "v", 0.3, 0.6)).count() == 0


def test_rank_matches_window_rank(spark, rows):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]),
             rng.choice([None, Decimal(0), Decimal(rng.randrange(-50, 50)), Decimal(rng.randrange(10 ** 13)) / 100]), i)
            for i in range(600)]
    df = spark.createDataFrame(data, "g string, v decimal(18,2), i int")
    expected = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))).cast("bigint"))
    assert rows(rank_within(df, "g", "v", "r")) == rows(expected)


def test_top_per_group_breaks_ties(spark, rows):
    df = spark.createDataFrame([("t", "b", 5), ("t", "a", 5), ("t", "c", 5), ("u", "x", 1)], "t string, p string, v int")
    out = ranking.top_per_group(df, ["t"], [F.desc("v"), F.asc("p")], 2)
    assert rows(out) == [("t", "a", 5, 1), ("t", "b", 5, 2), ("u", "x", 1, 1)]
    assert "WindowGroupLimit" in plan_of(out)


def fact(spark, lines):
    return spark.createDataFrame(lines, """order_number long, customer_name string, phone_number string, address string,
        product_code string, territory string, quantity int, order_date date, transaction_type string,
        total_amount decimal(14,2), net_amount decimal(18,4), restocking_fee decimal(17,4), product_line string""")


def line(order=1, name="Ann Lee", code="S10_1", territory="NA", quantity=1, day=date(2020, 1, 5), amount="10"):
    amount = Decimal(amount)
    refund = amount < 0
    net = -amount * Decimal("0.9") if refund else amount
    return (order, name, "1", "st", code, territory, quantity, day, "REFUND" if refund else "SALE", amount, net,
            -amount * Decimal("0.1") if refund else Decimal(0), "General")


def test_periods(spark, rows):
    df = fact(spark, [line(amount="10"), line(amount="30"), line(amount="-20"), line(day=date(2020, 2, 1), amount="5")])
    assert rows(sales_by_period(df, ["year", "month"])) == [
        (2020, 1, Decimal(40), 2, 20.0), (2020, 2, Decimal(5), 1, 5.0)]
    assert rows(refunds_by_period(df, ["year"])) == [(2020, Decimal(18), Decimal(2), 1)]


def test_monthly_sums_roll_up_to_quarters(spark):
    df = fact(spark, [line(day=date(2020, 1 + i % 12, 3), amount=str(i + 1)) for i in range(48)])
    months = sales.monthly_sales(df).groupBy(F.ceil(F.col("month") / 3).alias("q")).agg(F.sum("total_sales").alias("s"))
    quarters = sales.quarterly_sales(df).select(F.col("quarter").alias("q"), F.col("total_sales").alias("s"))
    assert {tuple(r) for r in months.collect()} == {tuple(r) for r in quarters.collect()}


def test_rankings_and_difference(spark, rows):
    df = fact(spark, [line(code="S10_2", amount="50"), line(code="S10_1", amount="50"), line(code="S10_3", amount="20"),
                      line(code="S12_1", territory="EMEA", amount="7"), line(code="S12_2", territory="APAC", amount="-9")])
    rankings = products.regional_rankings(df)
    assert [(r["territory"], r["product_code"], r["ranking_type"]) for r in rankings.orderBy("territory", "rank").collect()] == [
        ("EMEA", "S12_1", "Best Selling"), ("NA", "S10_1", "Best Selling"), ("NA", "S10_2", "Second Best Selling")]
    assert rows(products.revenue_difference(rankings)) == [
        ("EMEA", Decimal(7), None, None, None), ("NA", Decimal(50), Decimal(50), Decimal(0), 0.0)]


@pytest.mark.parametrize("count", [0, 1, 2, 3])
def test_percentile_segments_of_tiny_groups(spark, count):
    df = fact(spark, [line(name=f"c{i}", amount=str(10 * (i + 1))) for i in range(count)])
    out = {r["customer_name"]: r["customer_segment"] for r in customers.percentile_customer_segments(df).collect()}
    expected = {0: {}, 1: {"c0": "High Value"}, 2: {"c0": "Medium Value", "c1": "High Value"},
                3: {"c0": "Medium Value", "c1": "Medium Value", "c2": "High Value"}}
    assert out == expected[count]


def test_fact_with_double_amounts_gives_the_same_tables(spark, rows):
    df = fact(spark, [line(name=f"c{i % 5}", code=f"S1_{i % 3}", amount=f"{i}.{abs(i):02d}") for i in range(-20, 60)])
    loose = df.withColumns({c: F.col(c).cast("double") for c in ("total_amount", "net_amount", "restocking_fee")})
    for table in (sales.sales_analytics, sales.refunds_analytics, sales.monthly_summary, sales.daily_insights,
                  products.regional_rankings, products.product_performance, customers.percentile_customer_segments):
        assert rows(table(df)) == rows(table(loose))


def test_segment_threshold_is_inclusive(spark):
    df = fact(spark, [line(name="a", amount="10000"), line(name="b", amount="9999.99")])
    out = {r["customer_name"]: r["customer_segment"] for r in customers.customer_segments(df).collect()}
    assert out == {"a": "High Value", "b": "Regular"}


def test_top_customers_do_not_fan_out(spark):
    df = fact(spark, [line(name=" ann LEE ", amount="50"), line(name="Bob", amount="40")])
    dim = spark.createDataFrame([("Ann Lee", "a@b.co", "1", "X", "S"), ("ANN LEE", "z@b.co", "2", "Y", "T")],
                                "full_name string, email string, phone string, city string, state string")
    out = customers.top_customers(df, dim).collect()
    assert sorted((r["customer_name"], r["email"]) for r in out) == [(" ann LEE ", "z@b.co"), ("Bob", None)]


def test_fiscal_gap_forms_a_null_group(spark):
    df = fact(spark, [line(day=date(2003, 1, 10), amount="5"), line(day=date(2020, 1, 5), amount="7"), line(day=None, amount="1")])
    calendar = spark.createDataFrame([(date(2020, 1, 5), 2020, 4, "Dec")],
                                     "CALENDAR_DATE date, FISCAL_YEAR int, FISCAL_QUARTER int, FISCAL_MONTH_NAME string")
    out = [tuple(r) for r in sales.fiscal_aggregations(df, calendar).collect()]
    assert out == [(None, None, None, Decimal(6), 2, 3.0), (2020, 4, "Dec", Decimal(7), 1, 7.0)]


def test_orphans_and_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "d string")
    assert joins.orphans(df, F.col("k"), dim, F.col("d")).count() == 2
    assert joins.matched(df, F.col("k"), dim, F.col("d")).count() == 2
    assert tuple(joins.orphaned_share(df, F.col("k"), dim, F.col("d")).first()) == (4, 2, 0.5)


def test_product_performance_ties_and_null_territory(spark):
    df = fact(spark, [line(code="S1_1", amount="10"), line(code="S1_2", amount="10", order=2), line(code="S1_3", amount="4"),
                      line(code="S1_3", amount="4", order=2), line(code="S1_9", territory=None, amount="3")])
    out = {(r["territory"], r["product_code"]): (r["revenue_rank"], r["order_count"], r["revenue_diff_from_best"])
           for r in products.product_performance(df).collect()}
    assert out == {("NA", "S1_1"): (1, 1, 0), ("NA", "S1_2"): (1, 1, 0), ("NA", "S1_3"): (3, 2, 2), (None, "S1_9"): (1, 1, 0)}


def test_cross_sell_matches_brute_force(spark):
    rng = random.Random(5)
    lines = [line(order=rng.randrange(40), code=f"S1_{rng.randrange(12)}") for _ in range(200)]
    lines += [line(order=99, code=f"S1_{i}") for i in range(12) for _ in range(20)]  # one order holds most rows
    got = {(r["anchor"], r["product_code"]): r["orders_together"] for r in products.cross_sell(fact(spark, lines), products.most_ordered(fact(spark, lines), 3)).collect()}
    baskets = {}
    for row in lines:
        baskets.setdefault(row[0], set()).add(row[4])
    counts = {}
    for held in baskets.values():
        for code in held:
            counts[code] = counts.get(code, 0) + 1
    expected = {}
    for anchor in sorted(counts, key=lambda c: (-counts[c], c))[:3]:
        for held in baskets.values():
            for other in held - {anchor} if anchor in held else ():
                expected[anchor, other] = expected.get((anchor, other), 0) + 1
    assert got == expected


def test_categories(spark):
    df = spark.createDataFrame([("S10",), ("S99",), (None,)], "product_family string")
    assert [r[1] for r in products.with_category(df).collect()] == ["Scale Models", None, None]


def test_snapshot_steps(spark, rows):
    day = [date(2024, 1, d) for d in (1, 2, 3)]
    first = spark.createDataFrame([("a", "X"), ("b", None), ("c", "Z")], "k string, v string")
    second = spark.createDataFrame([("a", "Y"), ("b", None), ("d", "W")], "k string, v string")
    opened = history.new_history(first, day[0])
    step = history.apply_snapshot(opened, second, "k", ["v"], day[1])
    expected = [("a", "X", day[0], day[1], False), ("a", "Y", day[1], None, True), ("b", None, day[0], None, True),
                ("c", "Z", day[0], None, True), ("d", "W", day[1], None, True)]
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(rows(step), key=key) == sorted(expected, key=key)
    again = history.apply_snapshot(step, second, "k", ["v"], day[2])
    assert sorted(rows(again), key=key) == sorted(expected, key=key)
    closed = history.apply_snapshot(step, second, "k", ["v"], day[2], close_missing=True)
    assert ("c", "Z", day[0], day[2], False) in rows(closed)


def test_retention_prunes_by_date(spark, rows):
    df = spark.createDataFrame([(1, date(2020, 1, 1)), (2, date(2020, 1, 31)), (3, None)], "i int, d date")
    assert [r[0] for r in rows(history.retained(df, "d", date(2020, 2, 1), 1))] == [2, 3]


def test_history_null_key_is_stable_and_repeated_keys_raise(spark):
    first = spark.createDataFrame([(None, "a"), ("x", "b")], "k string, v string")
    state = history.new_history(first, date(2024, 1, 1))
    for month in (2, 3, 4):
        state = history.apply_snapshot(state, first, "k", ["v"], date(2024, month, 1))
    assert sorted((r["k"] or "", r["v"], r["is_current"]) for r in state.collect()) == [("", "a", True), ("x", "b", True)]
    twice = spark.createDataFrame([("x", "b"), ("x", "c")], "k string, v string")
    with pytest.raises(Exception, match="more than once"):
        history.apply_snapshot(state, twice, "k", ["v"], date(2024, 5, 1)).collect()


def test_history_keeps_rows_without_a_current_flag(spark):
    old = spark.createDataFrame([("x", "b", date(2024, 1, 1), None, None)],
                                "k string, v string, valid_from date, valid_to date, is_current boolean")
    new = spark.createDataFrame([("x", "b")], "k string, v string")
    assert history.apply_snapshot(old, new, "k", ["v"], date(2024, 2, 1)).count() == 2
