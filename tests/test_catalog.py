"""Typed catalogue tables: created once, filled with rows that fit, longer texts refused."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from storeloom import schemas
from storeloom.sinks import catalog

ITEMS = T.StructType([T.StructField("code", T.VarcharType(4)), T.StructField("price", T.DecimalType(6, 2)),
                      T.StructField("Made On", T.DateType())])


@pytest.fixture
def database(spark, tmp_path):
    name = f"typed_{uuid.uuid4().hex}"
    yield name, str(tmp_path / "typed")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_tables_are_created_once(spark, database):
    name, place = database
    assert catalog.create_missing(spark, schemas.WAREHOUSE, name, place) == list(schemas.WAREHOUSE)
    assert catalog.create_missing(spark, schemas.WAREHOUSE, name, place) == []
    kinds = catalog.declared_types(spark, f"{name}.fact_transactions")
    assert (kinds["customer_name"], kinds["unit_price"], kinds["is_large_order"]) == ("varchar(200)", "decimal(10,2)", "boolean")
    assert list(kinds) == schemas.WAREHOUSE["fact_transactions"].names


def test_a_fill_replaces_and_an_existing_table_keeps_its_rows(spark, database, rows):
    name, place = database
    table = f"{name}.items"
    catalog.create_missing(spark, {"items": ITEMS}, name, place)
    frame = spark.createDataFrame([("ab", Decimal("1.005")), ("abcd", None), (None, None)], "code string, price decimal(9,3)")
    assert catalog.fill_table(frame, table, ITEMS)[0] == 3
    stored, rejects = catalog.fill_table(spark.createDataFrame(
        [("äöüß", Decimal("2.5"), "x"), ("abcde", Decimal("1"), "x"), ("ok", Decimal("123456.7"), "x")], "code string, price decimal(9,3), more string"), table, ITEMS)
    assert (stored, sorted((r["code"], r["misfits"]) for r in rejects.collect())) == (1, [("abcde", ["code"]), ("ok", ["price"])])
    assert catalog.create_missing(spark, {"items": ITEMS}, name, place) == []
    assert rows(spark.table(table)) == [("äöüß", Decimal("2.50"), None)]
    assert catalog.insert_rows(spark.createDataFrame([(None, "add", Decimal("1"))], "`Made On` date, code string, price decimal(6,2)"), table,
                               overwrite=False) == 1
    assert [r["code"] for r in spark.table(table).orderBy("code").collect()] == ["add", "äöüß"]


def test_a_long_text_is_refused_by_the_table_itself(spark, database):
    name, place = database
    catalog.create_missing(spark, {"items": ITEMS}, name, place)
    table = f"{name}.items"
    catalog.fill_table(spark.createDataFrame([("ab", Decimal(1))], "code string, price decimal(6,2)"), table, ITEMS)
    long = spark.createDataFrame([("abcde", Decimal(1), None)], "code string, price decimal(6,2), `Made On` date")
    with pytest.raises(Exception, match="(?i)length|varchar"):
        catalog.insert_rows(long, table, overwrite=False)
    assert [r["code"] for r in spark.table(table).collect()] == ["ab"]


def test_other_columns_under_the_same_name_are_an_error(spark, database):
    name, place = database
    catalog.create_missing(spark, {"items": ITEMS}, name, place)
    other = T.StructType([T.StructField("code", T.VarcharType(5)), *ITEMS.fields[1:]])
    with pytest.raises(ValueError, match="code"):
        catalog.create_missing(spark, {"items": other}, name, place)


def test_load_creates_and_partitions(spark, database):
    name, place = database
    assert catalog.load_tables({}, {}, name) == {}
    catalog.create_missing(spark, {"items": ITEMS}, name, place, partition_by={"items": ["code"]})
    frame = spark.createDataFrame([("a", Decimal(1)), ("b", Decimal(2))], "code string, price decimal(6,2)")
    done = catalog.load_tables({"items": frame}, {"items": ITEMS}, name, place)
    assert done["items"][0] == 2 and done["items"][1].count() == 0
    assert {r["code"]: r["price"] for r in spark.table(f"{name}.items").collect()} == {"a": 1, "b": 2}
