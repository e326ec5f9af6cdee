import random
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from storeloom.sources.type_drift import agreeing_parts, join_schemas, join_types, read_drifting_types

BYTE, INT, LONG, FLOAT, DOUBLE, TEXT, DATE = (T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.DateType())
ALL = [BYTE, INT, LONG, FLOAT, DOUBLE, TEXT, DATE, T.DecimalType(12, 2), T.DecimalType(30, 10), T.BooleanType(), T.NullType()]


@pytest.mark.parametrize("a,b,joined", [
    (INT, LONG, LONG), (INT, T.DecimalType(5, 2), T.DecimalType(12, 2)), (LONG, T.DecimalType(30, 20), TEXT),
    (T.DecimalType(10, 4), T.DecimalType(12, 2), T.DecimalType(14, 4)), (FLOAT, DOUBLE, DOUBLE), (INT, DOUBLE, DOUBLE),
    (LONG, DOUBLE, TEXT), (DOUBLE, T.DecimalType(4, 1), TEXT), (DATE, INT, TEXT), (T.NullType(), DATE, DATE)])
def test_join_of_two_types(a, b, joined):
    assert join_types(a, b) == join_types(b, a) == joined


def test_join_is_a_join():
    for a in ALL:
        assert join_types(a, a) == a
        for b in ALL:
            assert join_types(a, join_types(a, b)) == join_types(a, b)


def test_nested_types_must_agree():
    with pytest.raises(TypeError):
        join_types(T.ArrayType(INT), INT)


def test_names_match_whatever_their_case():
    joined = join_schemas([T.StructType([T.StructField("Id", INT)]), T.StructType([T.StructField("x", TEXT), T.StructField("id", LONG)])])
    assert [(f.name, f.dataType) for f in joined] == [("Id", LONG), ("x", TEXT)]


def test_clashing_files_read_as_one_table(spark, tmp_path, rows):
    random.seed(3)
    paths, want, kinds = [], [], ["id int, v bigint", "id bigint, v decimal(9,2)", "id string, v int, more string"]
    for i in range(11):
        kind = kinds[random.randrange(3)]
        data = {kinds[0]: [(i, 10 ** 15 + i)], kinds[1]: [(i, Decimal("1.25"))], kinds[2]: [(f"x{i}", i, "m"), (None, None, None)]}[kind]
        paths.append(str(tmp_path / f"part{i}"))
        spark.createDataFrame(data, kind).coalesce(1).write.parquet(paths[-1])
        want += [(None if r[0] is None else str(r[0]), None if r[1] is None else Decimal(r[1]).quantize(Decimal("0.01")),
                  r[2] if len(r) > 2 else None) for r in data]
    parts = agreeing_parts(spark, paths)
    assert 1 < len(parts) <= 6 and sorted(p for _, part in parts for p in part) == sorted(paths)
    got = read_drifting_types(spark, paths)
    assert dict(got.dtypes) == {"id": "string", "v": "decimal(21,2)", "more": "string"}
    order = ["id", "v", "more"]
    assert sorted(map(tuple, got.select(*order).collect()), key=str) == sorted(want, key=str)
