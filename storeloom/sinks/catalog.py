"""Typed tables in Spark's catalogue: created if missing from a declared schema, filled with rows that fit.

The declared text lengths are part of the table, so Spark itself refuses a longer text from any writer. ``fill_table``
goes further: it puts aside the rows that do not fit and stores the others.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import takewhile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.sinks.warehouse import conform


def _quoted(*names: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for name in names for part in name.split("."))


def column_list(target: T.StructType) -> str:
    """Columns of a CREATE TABLE statement with their lengths and precisions."""
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in target)


def declared_types(spark: SparkSession, table: str) -> dict[str, str]:
    """Declared type of each column of a catalogue table, e.g. ``varchar(100)``."""
    described = spark.sql(f"DESCRIBE TABLE {_quoted(table)}").select("col_name", "data_type").collect()
    # Behind the columns comes a blank line or a heading, and then the partitioning.
    columns = takewhile(lambda row: row["col_name"] and not row["col_name"].startswith("# "), described)
    return {row["col_name"]: row["data_type"] for row in columns}


def create_missing(spark: SparkSession, targets: Mapping[str, T.StructType], database: str, location: str | None = None,
                   fmt: str = "parquet", partition_by: Mapping[str, list[str]] | None = None) -> list[str]:
    """Create the database and every target table that it lacks; names of the tables created.

    An existing table is left as it is, rows included, but must have the declared columns: a table of other columns under
    the same name is an error, since a load would fill the wrong ones.
    """
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{place}")
    created = []
    for name, target in targets.items():
        table = f"{database}.{name}"
        wanted = {f.name.lower(): f.dataType.simpleString() for f in target}
        if not spark.catalog.tableExists(table):
            parts = (partition_by or {}).get(name)
            by = f" PARTITIONED BY ({', '.join(map(_quoted, parts))})" if parts else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({column_list(target)}) USING {fmt}{by}")
            created.append(name)
        found = {column.lower(): kind for column, kind in declared_types(spark, table).items()}
        if found != wanted:
            differing = sorted(c for c in found.keys() | wanted.keys() if found.get(c) != wanted.get(c))
            raise ValueError(f"{table} has other columns than declared: {', '.join(differing)}")
    return created


def insert_rows(df: DataFrame, table: str, overwrite: bool = True) -> int:
    """Insert rows by column name and return their number. A text longer than its column is an error, and nothing is stored."""
    spark = df.sparkSession
    written = Observation()
    ordered = df.select(*[F.col(_quoted(name)) for name in declared_types(spark, table)])
    ordered.observe(written, F.count(F.lit(1)).alias("rows")).write.insertInto(table, overwrite=overwrite)
    spark.catalog.refreshTable(table)
    return written.get["rows"]


def fill_table(df: DataFrame, table: str, target: T.StructType, overwrite: bool = True) -> tuple[int, DataFrame]:
    """Store the rows that fit the declared types; their number, and the others with the names of the misfit columns."""
    good, rejects = conform(df, target)
    return insert_rows(good, table, overwrite), rejects


def load_tables(frames: Mapping[str, DataFrame], targets: Mapping[str, T.StructType], database: str,
                location: str | None = None, fmt: str = "parquet") -> dict[str, tuple[int, DataFrame]]:
    """The full-refresh load into the catalogue: create what is missing, replace the contents of every given table. Rows
    stored and rejects by table."""
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    create_missing(spark, {name: targets[name] for name in frames}, database, location, fmt)
    return {name: fill_table(df, f"{database}.{name}", targets[name]) for name, df in frames.items()}
