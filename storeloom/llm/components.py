"""Connected components of a link table, by repeated contraction.

In each round every node hangs itself below its smallest smaller neighbour, chains are shortened by pointer jumping,
and the links are redrawn between the roots. All links of a hub vanish in one round. Tables are staged in the
shared folder; the driver learns no more than whether a table has rows. Each join runs once: what it changed is a column of
the staged table. Spark's driver keeps a thread for a minute for every exchange, so exchanges cost it memory on any input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.scratch import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in links (a, b) of longs; component is the smallest node. Self links and nulls
    are ignored, repeated links count once; no links give no rows."""
    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")

    left = stage(ordered(links.where("a is not null and b is not null")), "links")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        below = stage(left.groupBy(F.col("b").alias("child")).agg(F.min("a").alias("parent")), "parents")
        moved = True
        while moved:
            up = below.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
            jumped = stage(below.join(up, "parent", "left").select(
                "child", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")), "parents")
            below, moved = jumped.select("child", "parent"), not jumped.where("moved").isEmpty()
        rounds.append(below)
        one = below.select(F.col("child").alias("a"), F.col("parent").alias("root_a"))
        two = below.select(F.col("child").alias("b"), F.col("parent").alias("root_b"))
        left = stage(ordered(left.join(one, "a", "left").join(two, "b", "left")
                             .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))), "links")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("a").alias("component"))
    # A child of a later round is a root of all rounds before it, so each node is a child once, or a root of the last round.
    labels = rounds.pop().select(F.col("child").alias("node"), F.col("parent").alias("component"))
    while rounds:
        later = labels.select(F.col("node").alias("parent"), F.col("component").alias("above"))
        labels = stage(rounds.pop().join(later, "parent", "left").select(
            F.col("child").alias("node"), F.coalesce("above", "parent").alias("component")).unionByName(labels), "labels")
    roots = labels.select("component").distinct().select(F.col("component").alias("node"), "component")
    return stage(labels.unionByName(roots), "labels")
