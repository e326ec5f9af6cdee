"""Warehouse load over JDBC: conform to the target, then a parallel full refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 10_000
CONNECTIONS = 4


def column_types(target: T.StructType) -> str:
    """Column list for ``createTableColumnTypes``."""
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in target)


def _plain(kind: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(kind, (T.VarcharType, T.CharType)) else kind


def _fitted(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`").try_cast(_plain(field.dataType))
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        return F.when(F.length(value) <= field.dataType.length, value)
    return value


def conform(df: DataFrame, target: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows in the target's columns and types, and rejects with the columns that do not fit.

    A target column that ``df`` lacks is NULL. Decimals are rounded to the
    target scale; a value too large or a text too long is rejected, not cut.
    """
    present = {name.lower() for name in df.columns}
    for field in target:
        if field.name.lower() not in present:
            df = df.withColumn(field.name, F.lit(None).cast(_plain(field.dataType)))
    misfit = F.array_compact(F.array(*[
        F.when(F.col(f"`{f.name}`").isNotNull() & _fitted(f).isNull(), F.lit(f.name)) for f in target]))
    judged = df.withColumn("misfits", misfit)
    fits = F.size("misfits") == 0
    good = judged.filter(fits).select(*[_fitted(f).alias(f.name) for f in target])
    return good, judged.filter(~fits)


def jdbc_options(url: str, table: str, target: T.StructType, batch_rows: int = BATCH_ROWS,
                 connections: int = CONNECTIONS) -> dict[str, str]:
    """Writer options: typed create-if-missing, truncate on refresh, batched inserts.

    ``numPartitions`` bounds the open connections; Spark coalesces to it.
    """
    return {
        "url": url, "dbtable": table, "truncate": "true",
        "createTableColumnTypes": column_types(target),
        "batchsize": str(batch_rows), "numPartitions": str(connections),
    }


def load_full(df: DataFrame, url: str, table: str, target: T.StructType,
              connection: dict[str, str] | None = None, batch_rows: int = BATCH_ROWS,
              connections: int = CONNECTIONS) -> DataFrame:
    """Replace the contents of a warehouse table; returns the rejects, lazily.

    Each task inserts its own partition; nothing passes through the driver.
    Truncate and insert are not one transaction: load a staging table and swap
    it in the warehouse where readers must never see a partial load.
    """
    good, rejects = conform(df, target)
    (good.write.format("jdbc")
     .options(**jdbc_options(url, table, target, batch_rows, connections), **(connection or {}))
     .mode("overwrite").save())
    return rejects


def load_dimensions(dimensions: dict[str, DataFrame], url: str, targets: dict[str, T.StructType],
                    connection: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Load several dimension tables; rejects by table name."""
    return {name: load_full(df, url, name, targets[name], connection) for name, df in dimensions.items()}
