"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
               merge_schema: bool = False) -> DataFrame:
    """Lazy table scan. ``fmt`` may name any installed source, e.g. ``delta``."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)
