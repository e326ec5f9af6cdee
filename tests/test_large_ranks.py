import random

import pytest
from pyspark.sql import functions as F

from storeloom.operators.large_ranks import row_numbers, top_by_value


def expected(data, k):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    out = []
    for found in groups.values():
        found.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        out += [(*row, n + 1) for n, row in enumerate(found[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [1, 40, 1500])
def test_top_by_value_matches_sorting(spark, k):
    rng = random.Random(k)
    values = [None, 0, -7, 3, (1 << 62), -(1 << 62), *range(50)]
    data = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice(values), i) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, v bigint, i int").repartition(7)
    got = top_by_value(df, ["g"], "v", [F.asc("i")], k)
    assert got.columns == ["g", "v", "i", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(data, k)


def test_row_numbers_of_a_hot_group_spread_over_tasks(spark):
    df = spark.range(30_000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 30_011).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = row_numbers(df, ["g"], [F.asc("v")])
        held = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        ranks = [r["rank"] for r in got.orderBy("v").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranks == list(range(1, 30_001))
    assert len(held) > 1 and max(held) < 30_000


def test_no_rows_and_few_rows(spark):
    df = spark.createDataFrame([("a", 1, 1)], "g string, v bigint, i int")
    assert top_by_value(df.limit(0), ["g"], "v", [F.asc("i")], 5).collect() == []
    assert [tuple(r) for r in top_by_value(df, ["g"], "v", [F.asc("i")], 5).collect()] == [("a", 1, 1, 1)]
