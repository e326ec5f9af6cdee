"""Tables whose files disagree on column types: a type lattice over their schemas, one scan per signature.

Paths (files or delivery folders) are read with the schema that Spark merges for them. Where that fails because types
clash, the paths are halved until each part agrees, so the number of schema reads follows the number of clashes and not
of files. Parts with the same columns and types are scanned together; every scan is cast to the join of all types.

The join holds every value of both types: integers widen, integers and decimals meet in a decimal with room for both,
fractions meet in a double if that is exact, all other pairs in text. Nothing turns NULL and nothing is rounded.

A path whose own files clash is an error; give its files instead.

Defined cases: a column that a part lacks is NULL there; names match whatever their case, as in Spark, and the first
spelling stays. Nested types must be equal. A boolean, date or time joined to anything else is text.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.operators.combine import union_by_name

#: Digits that hold every value of an integer type.
INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
INTEGERS = list(INTEGER_DIGITS)
#: Integer digits that a fraction type holds exactly.
FRACTION_DIGITS = {T.FloatType: 7, T.DoubleType: 15}
MOST_DIGITS = 38
CLASH = "CANNOT_MERGE_SCHEMAS"


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds every value of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for kind in (a, b):
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            raise TypeError(f"no common type for {a.simpleString()} and {b.simpleString()}")
    if type(a) in INTEGER_DIGITS and type(b) in INTEGER_DIGITS:
        return INTEGERS[max(INTEGERS.index(type(a)), INTEGERS.index(type(b)))]()
    if all(isinstance(x, T.DecimalType) or type(x) in INTEGER_DIGITS for x in (a, b)):
        whole, scale = (max(x) for x in zip(*map(_digits, (a, b)), strict=True))
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else T.StringType()
    if type(a) in FRACTION_DIGITS and type(b) in FRACTION_DIGITS:
        return T.DoubleType()
    for one, other in ((a, b), (b, a)):
        if type(one) in FRACTION_DIGITS and type(other) in INTEGER_DIGITS and INTEGER_DIGITS[type(other)] <= FRACTION_DIGITS[T.DoubleType]:
            return T.DoubleType()
    return T.StringType()


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (INTEGER_DIGITS[type(kind)], 0)


def join_schemas(schemas: list[T.StructType]) -> T.StructType:
    """Columns in the order in which they first appear, each with the join of its types."""
    found: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema):
        name = field.name.lower()
        known = found.get(name)
        found[name] = T.StructField(known.name, join_types(known.dataType, field.dataType)) if known else T.StructField(
            field.name, field.dataType)
    return T.StructType(list(found.values()))


def agreeing_parts(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """(schema, paths) of parts whose files Spark can merge; parts of equal schema are one."""
    parts: dict[str, tuple[T.StructType, list[str]]] = {}
    waiting = [paths]
    while waiting:
        part = waiting.pop()
        try:
            schema = spark.read.option("mergeSchema", True).parquet(*part).schema
        except Py4JJavaError as failed:
            if CLASH not in str(failed.java_exception) or len(part) == 1:
                raise
            middle = len(part) // 2
            waiting += [part[middle:], part[:middle]]
        else:
            parts.setdefault(schema.json(), (schema, []))[1].extend(part)
    return list(parts.values())


def read_drifting_types(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All rows of Parquet files with clashing types as one table, typed by the join of their schemas."""
    parts = agreeing_parts(spark, paths)
    joined = join_schemas([schema for schema, _ in parts])
    frames = []
    for schema, part in parts:
        own = {f.name.lower(): f for f in schema}
        frames.append(spark.read.schema(schema).parquet(*part).select(*[
            (F.col(f"`{own[f.name.lower()].name}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in joined]))
    return union_by_name(frames)
