"""Item pairs that occur together in many baskets: complete above a support bound.

Only items that reach the bound by themselves can be part of such a pair, so the others go before anything is paired. A
basket of ``m`` items is dealt to blocks of about BLOCK items, and each pair of blocks is a group of its own, so the
pairs of a large basket are made in many tasks. The pairs are then counted twice: first by hash, in at most
HASH_BUCKETS counters, which combine before the shuffle and hold at least as much as any pair in them; then exactly,
but only pairs whose counter reaches the bound. Rare pairs, which are most of them, never cross the second shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.functions.money import average
from storeloom.scratch import stage

BLOCK = 64
HASH_BUCKETS = 1 << 20
PAIRS_PER_TASK = 4_000_000


def item_counts(baskets: DataFrame, item: str, min_support: int) -> DataFrame:
    """(item, baskets) of the items in at least ``min_support`` baskets."""
    counts = baskets.groupBy(F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("baskets"))
    return counts.filter(F.col("baskets") >= min_support)


def in_blocks(baskets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(basket, low, high, part, item): every item once for each block of its basket, under the pair of the two blocks.

    ``baskets`` is (basket, item) without repeats. ``part`` is the item's own block, ``low`` or ``high``.
    """
    sizes = baskets.groupBy("basket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).filter(F.col("blocks") > 0)
    part = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    dealt = baskets.join(sizes, "basket").withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("basket", "item", "part", other).select(
        "basket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "item")


def pairs_in_baskets(baskets: DataFrame, block: int = BLOCK, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """(first, second): all pairs of two items of a basket, the smaller item first; once for each basket.

    The number of tasks follows from the number of pairs, not from the bytes of the baskets, which are few. So
    adaptive execution cannot bring the blocks of a large basket together again.
    """
    size = F.count(F.lit(1))
    sizes = baskets.groupBy("basket").agg((size * (size - 1) / 2).alias("pairs"))
    total = sizes.agg(F.sum("pairs").alias("pairs")).first()["pairs"] or 0
    tasks = max(1, math.ceil(total / pairs_per_task))
    parallel = max(tasks, int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = ["basket", "low", "high"]
    grouped = (in_blocks(baskets, block).repartition(parallel, *keys)
               .groupBy(*keys).agg(F.collect_list(F.struct("part", "item")).alias("held")))

    def items(part: str) -> Column:
        return F.transform(F.filter("held", lambda h: h["part"] == F.col(part)), lambda h: h["item"])

    crossed = (grouped.select("low", "high", items("low").alias("left"), items("high").alias("right"))
               .select("low", "high", F.explode("left").alias("a"), "right")
               .select("low", "high", "a", F.explode("right").alias("b"))
               .filter((F.col("low") < F.col("high")) | (F.col("a") < F.col("b"))))
    return crossed.select(F.least("a", "b").alias("first"), F.greatest("a", "b").alias("second"))


def frequent_pairs(baskets: DataFrame, min_support: int, basket: str = "basket", item: str = "item", block: int = BLOCK,
                   hash_buckets: int = HASH_BUCKETS, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Every pair of items that at least ``min_support`` baskets hold: first, second, together, the baskets of each item
    and the shares of these that hold the other.

    Repeated lines of a basket count once; lines without a basket or an item are left out.
    """
    if min_support < 1:
        raise ValueError("the support bound is at least one basket")
    lines = baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    distinct = stage(lines.filter(F.col("basket").isNotNull() & F.col("item").isNotNull()).distinct(), "baskets")
    counts = stage(item_counts(distinct, "item", min_support), "frequent-items")
    kept = stage(distinct.join(counts.select("item"), "item", "left_semi"), "frequent-baskets")
    pairs = pairs_in_baskets(kept, block, pairs_per_task)
    counter = F.pmod(F.xxhash64("first", "second"), F.lit(hash_buckets)).cast("int")
    hashed = (pairs.groupBy(counter.alias("counter")).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= min_support).select("counter"))
    # At most HASH_BUCKETS integers, whatever the data, so they can go to every task.
    likely = pairs.join(F.broadcast(stage(hashed, "frequent-counters")), counter == F.col("counter"), "left_semi")
    together = likely.groupBy("first", "second").agg(F.count(F.lit(1)).alias("together")).filter(F.col("together") >= min_support)
    one = counts.select(F.col("item").alias("first"), F.col("baskets").alias("first_baskets"))
    two = counts.select(F.col("item").alias("second"), F.col("baskets").alias("second_baskets"))
    return together.join(one, "first").join(two, "second").select(
        "first", "second", "together", "first_baskets", "second_baskets",
        average(F.col("together"), F.col("first_baskets")).alias("share_of_first"),
        average(F.col("together"), F.col("second_baskets")).alias("share_of_second"))
