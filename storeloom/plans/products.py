"""Product tables: regional rankings, gaps to the best seller, cross-sell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.config import DEFAULT_RULES, Rules
from storeloom.functions.money import average, percent_of, total
from storeloom.functions.text import product_family
from storeloom.operators.order_statistics import rank_within
from storeloom.operators.pairs import frequent_pairs
from storeloom.operators.periods import sales_only
from storeloom.operators.ranking import top_overall, top_per_group
from storeloom.scratch import stage


def territory_product_sales(fact: DataFrame) -> DataFrame:
    """Sales per territory and product. The family depends on the product alone,
    so it is attached after the aggregate instead of being a group key."""
    totals = sales_only(fact).groupBy("territory", "product_code").agg(
        total(fact, "net_amount").alias("total_sales"), F.count("order_number").alias("total_orders"))
    return totals.withColumn("product_family", product_family(F.col("product_code")))


def regional_rankings(fact: DataFrame, k: int = 2) -> DataFrame:
    """The best sellers of each territory; equal sales are ordered by product code."""
    ranked = top_per_group(territory_product_sales(fact), ["territory"],
                           [F.desc("total_sales"), F.asc("product_code")], k)
    label = F.when(F.col("rank") == 1, "Best Selling").when(F.col("rank") == 2, "Second Best Selling")
    return ranked.withColumn("ranking_type", label)


def revenue_difference(rankings: DataFrame) -> DataFrame:
    """Best against second best per territory; NULL where there is only one product."""
    best, second = F.col("best_selling_revenue"), F.col("second_best_revenue")
    pair = rankings.groupBy("territory").agg(
        F.max(F.when(F.col("rank") == 1, F.col("total_sales"))).alias("best_selling_revenue"),
        F.max(F.when(F.col("rank") == 2, F.col("total_sales"))).alias("second_best_revenue"))
    return pair.withColumns({
        "revenue_difference": best - second,
        "revenue_difference_pct": percent_of(best - second, best)})


def gap_to_best(fact: DataFrame) -> DataFrame:
    """Every product's distance to the best seller of its territory.

    The best value comes from an aggregate and an equi-join rather than from a
    window, so a large territory is never gathered in one task.
    """
    return _with_best(stage(territory_product_sales(fact), "territory_products"),
                      "total_sales", "best_sales", "difference_to_best")


def _with_best(products: DataFrame, value: str, best: str, gap: str) -> DataFrame:
    greatest = products.groupBy(F.col("territory").alias("_territory")).agg(F.max(value).alias(best))
    joined = products.join(greatest, F.col("territory").eqNullSafe(F.col("_territory"))).drop("_territory")
    return joined.withColumn(gap, F.col(best) - F.col(value))


def product_performance(fact: DataFrame) -> DataFrame:
    """Per territory and product: revenue, quantity, orders, price, rank and gap to the best."""
    revenue, quantity = total(fact, "net_amount"), F.sum("quantity")
    totals = sales_only(fact).groupBy("territory", "product_code", "product_line").agg(
        revenue.alias("total_revenue"), quantity.alias("total_quantity"),
        F.count_distinct("order_number").alias("order_count"),
        average(revenue, quantity).alias("avg_price"))
    staged = stage(totals, "product_performance")
    ranked = rank_within(staged, "territory", "total_revenue", "revenue_rank")
    return _with_best(ranked, "total_revenue", "best_revenue", "revenue_diff_from_best")


def with_category(products: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Attach the category of the product family; an unknown family has none."""
    pairs = [F.lit(text) for pair in rules.product_categories.items() for text in pair]
    return products.withColumn("product_category", F.try_element_at(F.create_map(*pairs), F.col("product_family")))


def cross_sell_pairs(fact: DataFrame, min_orders: int) -> DataFrame:
    """Every pair of products that at least ``min_orders`` orders hold together, with the orders of each product."""
    found = frequent_pairs(sales_only(fact).select("order_number", "product_code"), min_orders, "order_number", "product_code")
    return found.select(
        F.col("first").alias("product_code"), F.col("second").alias("other_product_code"), F.col("together").alias("orders_together"),
        F.col("first_baskets").alias("orders"), F.col("second_baskets").alias("other_orders"),
        F.col("share_of_first").alias("share_of_orders"), F.col("share_of_second").alias("share_of_other_orders"))


def most_ordered(fact: DataFrame, k: int) -> DataFrame:
    """The ``k`` products in most orders, as (product_code)."""
    orders = sales_only(fact).select("order_number", "product_code").distinct()
    counts = orders.groupBy("product_code").agg(F.count(F.lit(1)).alias("orders"))
    return top_overall(counts, [F.desc("orders"), F.asc("product_code")], k).select("product_code")


def cross_sell(fact: DataFrame, anchors: DataFrame) -> DataFrame:
    """For each of the given anchor products: orders that also hold another product, complete for the anchors.

    Only lines that meet an anchor are paired, so an order of ``m`` products
    with ``a`` anchors yields ``a * m`` rows instead of ``m * m``.
    """
    baskets = stage(sales_only(fact).select("order_number", "product_code").distinct(), "baskets")
    chosen = anchors.select(F.col("product_code").alias("anchor")).distinct()
    held = stage(baskets.join(chosen, F.col("product_code") == F.col("anchor")).select("order_number", "anchor"), "anchored")
    orders = held.groupBy("anchor").agg(F.count(F.lit(1)).alias("anchor_orders"))
    pairs = baskets.join(held, "order_number").filter(F.col("product_code") != F.col("anchor"))
    together = pairs.groupBy("anchor", "product_code").agg(F.count(F.lit(1)).alias("orders_together"))
    return orders.join(together, "anchor").withColumn(
        "share_of_anchor_orders", average(F.col("orders_together"), F.col("anchor_orders")))
