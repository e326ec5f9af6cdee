"""Every registered query against its SQL twin, and the shape of the headline plans."""

import duckdb
import pytest

from __spark_entry__ import entry
from workload import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "events"]
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def canonical(rows, order):
    return sorted(tuple("" if r[i] is None else repr(r[i]) for i in order) for r in rows)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    answer = duck.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(got.columns) == sorted(columns)
    kinds = dict(got.dtypes)
    assert {c: TYPES[kinds[c]] for c in columns} == {c[0]: str(c[1]) for c in answer.description}
    by_name = sorted(columns)
    left = canonical(got.collect(), [got.columns.index(c) for c in by_name])
    assert left == canonical(answer.fetchall(), [columns.index(c) for c in by_name])


def test_entry(spark):
    assert entry(spark).count() == 10


LAZY = [n for n in sorted(QUERIES) if n.split("_")[0] not in ("src", "snk", "ing", "srcf")
        and not n.startswith(("doc_10", "agg_10"))]


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_python_and_no_cross_join(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert word not in plan


@pytest.mark.parametrize("name,columns", [
    ("anl_4_monthly_sales", {"l_orderkey", "l_extendedprice", "l_returnflag", "o_orderkey", "o_orderdate"}),
    ("anl_18_transaction_type_counts", {"l_extendedprice", "l_returnflag"}),
    ("agg_2_sum", {"l_extendedprice", "l_returnflag"}),
])
def test_scans_read_only_what_is_used(spark, name, columns):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    read = {c.split(":")[0] for part in plan.split("ReadSchema: struct<")[1:] for c in part.split(">")[0].split(",")}
    assert read == columns


def test_refund_flag_filter_reaches_the_scan(spark):
    plan = QUERIES["src_7_table_scan"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan


def test_semi_and_anti_joins_lines_to_orders_once(spark, rows, tmp_path):
    day = "timestamp_ntz'{}'".format
    spark.sql(f"""SELECT * FROM VALUES (1L, 7L, {day("1995-12-30")}), (2L, 7L, {day("1995-12-31")}), (3L, 7L, {day("1996-05-01")}), (4L, 7L, null)
                  AS t(o_orderkey, o_custkey, o_orderdate)""").selectExpr(
        "*", "'O' o_orderstatus", "1.0D o_totalprice", "'x' o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT * FROM VALUES (1L), (2L), (2L), (3L), (4L), (5L), (null) AS t(l_orderkey)").selectExpr(
        "*", "1L l_partkey", "1L l_suppkey", "1 l_linenumber", "1.0D l_quantity", "1.0D l_extendedprice", "0.0D l_discount", "0.0D l_tax",
        "'N' l_returnflag", "'O' l_linestatus", f"{day('1996-01-01')} l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["jn_3_semi_and_anti"](spark, str(tmp_path))
    assert sorted((n or 0, has_day) for n, _, has_day in rows(found)) == [
        (0, False), (1, False), (2, True), (2, True), (3, True), (4, False), (5, False)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan, "lines are read once, before the halves of the union"
