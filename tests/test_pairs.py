"""Frequent pairs against all pairs of small baskets, and how the pairs of a large one are dealt out."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storeloom.operators import pairs
from storeloom.scratch import stage


def brute(lines, least):
    held = {}
    for basket, item in set(lines):
        if basket is not None and item is not None:
            held.setdefault(basket, set()).add(item)
    items = Counter(i for h in held.values() for i in h)
    both = Counter(p for h in held.values() for p in itertools.combinations(sorted(h), 2))
    return {(a, b, n, items[a], items[b]) for (a, b), n in both.items() if n >= least}


@pytest.mark.parametrize("least,block,buckets", [(1, 64, 1 << 20), (2, 3, 7), (3, 2, 1), (40, 64, 16)])
def test_frequent_pairs(spark, least, block, buckets):
    rng = random.Random(least)
    lines = [(rng.randrange(60), f"p{int(rng.random() ** 2 * 25)}") for _ in range(500)]
    lines += lines[:40] + [(None, "p1"), (1, None), (None, None)] + [(100, f"p{i}") for i in range(25)] + [(101, "lone")]
    frame = spark.createDataFrame(lines, "b int, i string")
    got = pairs.frequent_pairs(frame, least, "b", "i", block, buckets)
    out = got.collect()
    assert Counter(tuple(r)[:5] for r in out) == Counter(brute(lines, least))
    assert all(r["share_of_first"] == r["together"] / r["first_baskets"] and r["share_of_second"] == r["together"] / r["second_baskets"]
               for r in out)


def test_no_baskets(spark):
    frame = spark.createDataFrame([], "b int, i string")
    assert pairs.frequent_pairs(frame, 1, "b", "i").count() == 0
    with pytest.raises(ValueError):
        pairs.frequent_pairs(frame, 0, "b", "i")


def test_a_large_basket_is_spread_over_tasks(spark):
    """5,000 products in one basket are 12.5 million pairs."""
    items = stage(spark.range(5000).select(F.lit(1).alias("basket"), F.col("id").alias("item")), "one-basket")
    spread = pairs.pairs_in_baskets(items, pairs_per_task=500_000)
    made = spread.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in made) == 5000 * 4999 // 2
    assert len(made) >= 20 and max(r["n"] for r in made) < 2 * 500_000
    groups = pairs.in_blocks(items).groupBy("low", "high").count()
    assert groups.agg(F.max("count")).first()[0] <= 4 * pairs.BLOCK


def test_support_comes_before_pairing(spark):
    """Pairs are made of frequent items only."""
    lines = spark.range(3000).select((F.col("id") % 3).alias("b"), F.col("id").alias("i"))
    both = lines.unionByName(spark.createDataFrame([(b, i) for b in range(3) for i in (-1, -2)], "b long, i long"))
    got = pairs.frequent_pairs(both, 2, "b", "i").collect()
    assert [tuple(r)[:5] for r in got] == [(-2, -1, 3, 3, 3)]
