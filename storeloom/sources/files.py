"""CSV landing files: declared schemas, drifting headers, lineage columns."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom import schemas
from storeloom.functions import text
from storeloom.operators.combine import latest_per_key, union_by_name

CORRUPT_COLUMN = "_corrupt_record"

# Header spellings seen in customer files -> standard name.
CUSTOMER_HEADERS = {
    "zip": "postal_code",
    "post": "postal_code",
    "postal": "postal_code",
    "province": "state",
}


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan with a declared schema; types are inferred only where none is given."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_keeping_corrupt(spark: SparkSession, path: str | list[str],
                             schema: T.StructType) -> DataFrame:
    """Typed scan that keeps unreadable lines whole in ``_corrupt_record``.

    A file whose header names other columns, or the same in another order, is an error: its values would land in the
    wrong columns. All fields of a line are parsed whatever a query selects, else an unreadable one would go unnoticed.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    return (spark.read.schema(full)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .option("columnPruning", False)
            .csv(path))


def input_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """One row per input file. Only the listing is read, never the contents."""
    return (spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True)
            .load(path)
            .select(F.col("path").alias("source_file"), "length"))


def first_lines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(source_file, line): the first line of every file that has one, read in the tasks.

    A file begins in the split that starts at 0, and lines arrive in their order, so the first line of a file is the one
    where the file name changes. A split that ends before its file does fills a task by itself: after one batch of lines
    the task has seen all it can give and stops reading. So of a large file one batch a split is read, and its tail. Where
    a session bounds the number of tasks, splits are packed anew, and every line is looked at.
    """
    alone = not spark.conf.get("spark.sql.files.maxPartitionNum", None)
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
             .select(F.when(F.col("_metadata.file_block_start") == 0, F.col("value")).alias("line"),
                     F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start"),
                     (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")).alias("end"),
                     F.col("_metadata.file_size").alias("size")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, start = batch.column("source_file"), batch.column("start")
            before = pa.concat_arrays([pa.array([last], files.type), files[:-1]])
            begins = pc.and_(pc.fill_null(pc.not_equal(files, before), True), pc.equal(start, 0))
            chosen = batch.select(["source_file", "line"]).filter(begins)
            if chosen.num_rows:
                yield chosen
            last = files[-1].as_py()
            if alone and batch.column("end")[0].as_py() < batch.column("size")[0].as_py():
                return

    return lines.mapInArrow(run, "source_file string, line string")


def files_by_header(spark: SparkSession, path: str, glob: str = "*.csv") -> dict[tuple[str, ...], list[str]]:
    """Group the input files by their header line.

    First lines are read and grouped in the tasks. The driver gets one row per distinct header with the names of its
    files, which it needs to plan their scan; files without a header are left out.
    """
    lines = first_lines(spark, path, glob)
    text = F.regexp_replace("line", "^\ufeff", "")
    grouped = lines.groupBy(text.alias("line")).agg(F.array_sort(F.collect_list("source_file")).alias("files"))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in grouped.collect():
        header = tuple(name.strip() for name in next(csv.reader([row["line"]]), []))
        if header:
            groups[header] += [unquote(file) for file in row["files"]]  # file names come as URIs
    return dict(groups)


def rename_drifted(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Bring drifted column names to their standard name.

    Where several spellings (or the standard name itself) occur together, the
    first non-NULL value wins, so no duplicate column can arise.
    """
    spellings: dict[str, list[str]] = defaultdict(list)
    for name in df.columns:
        spellings[mapping.get(name.lower(), name)].append(name)
    return df.select([
        (F.col(f"`{names[0]}`") if len(names) == 1 else F.coalesce(*[F.col(f"`{n}`") for n in names]))
        .alias(standard)
        for standard, names in spellings.items()
    ])


def with_lineage(df: DataFrame, run_time: datetime | Column | None = None) -> DataFrame:
    """Add the source file and the ingestion time to a file scan."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"),
                     run_clock(run_time).alias("ingestion_date"))


def run_clock(run_time: datetime | Column | None) -> Column:
    """The run's timestamp: given by the caller, else the start of the query."""
    if run_time is None:
        return F.current_timestamp()
    return run_time if isinstance(run_time, Column) else F.lit(run_time)


def with_audit(df: DataFrame, run_time: datetime | Column | None = None) -> DataFrame:
    return df.withColumns({"created_date": run_clock(run_time), "updated_date": run_clock(run_time)})


def with_partition_day(df: DataFrame, moment: str = "ingestion_date") -> DataFrame:
    return df.withColumn("partition_date", F.date_format(moment, "yyyy-MM-dd"))


def has_surplus(line: Column, columns: int) -> Column:
    """Whether a CSV line has more fields than columns. Quoted fields hide their separators."""
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= columns


def read_drifting(spark: SparkSession, path: str, mapping: dict[str, str],
                  run_time: datetime | Column | None = None) -> DataFrame:
    """All files of one entity with headers brought together: one scan per header.

    A line with more fields than its header has a value that belongs to no column: such a line is kept whole in
    ``_corrupt_record``, for ``good_lines`` and ``rejected_lines`` to part. A shorter line lacks its last values.
    """
    scans = []
    for header, paths in sorted(files_by_header(spark, path).items()):
        literal = [re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for path in paths]  # names are not patterns
        schema = T.StructType([*text_schema(list(header)).fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        scan = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("columnPruning", False).csv(literal))
        line = F.col(CORRUPT_COLUMN)
        # A scan must read a column of the file beside the unreadable line, so the condition names one; any text passes it.
        surplus = has_surplus(line, len(header)) & (F.coalesce(F.col(f"`{header[0]}`"), F.lit("")) >= "")
        judged = with_lineage(scan, run_time).withColumn(CORRUPT_COLUMN, F.when(surplus, line))
        scans.append(rename_drifted(judged, mapping))
    if not scans:
        raise FileNotFoundError(f"no CSV file with a header below {path}")
    return union_by_name(scans)


def drifted_customers(spark: SparkSession, path: str, run_time: datetime | Column | None = None) -> DataFrame:
    """Every line of the customer files in the declared columns, surplus lines whole in ``_corrupt_record``."""
    raw = read_drifting(spark, path, CUSTOMER_HEADERS, run_time)
    for field in schemas.CUSTOMERS:
        if field.name not in raw.columns:
            raw = raw.withColumn(field.name, F.lit(None).cast(field.dataType))
    return raw


def clean_customers(spark: SparkSession, path: str,
                    run_time: datetime | Column | None = None) -> DataFrame:
    """Customer landing files: one header, an identifier, one row per customer."""
    return identify_customers(good_lines(drifted_customers(spark, path, run_time)))


def rejected_customers(spark: SparkSession, path: str, run_time: datetime | Column | None = None) -> DataFrame:
    """The lines of the customer files that ``clean_customers`` leaves out."""
    return rejected_lines(drifted_customers(spark, path, run_time))


def identify_customers(raw: DataFrame) -> DataFrame:
    """Add ``customer_id`` and keep the newest row of each; ties fall to file and content."""
    named = raw.withColumn("customer_id", text.customer_id(
        F.col("first_name"), F.col("last_name"), F.col("email")))
    content = [F.col(f"`{name}`").asc_nulls_last() for name in raw.columns
               if name not in ("ingestion_date", "source_file")]
    return latest_per_key(named, ["customer_id"],
                          [F.desc("ingestion_date"), F.asc("source_file"), *content])


def raw_transactions(spark: SparkSession, path: str,
                     run_time: datetime | Column | None = None) -> DataFrame:
    """Every line of the files; ``good_lines`` and ``rejected_lines`` part them once they are stored."""
    return with_lineage(read_csv_keeping_corrupt(spark, path, schemas.TRANSACTIONS), run_time)


def raw_calendar(spark: SparkSession, path: str,
                 run_time: datetime | Column | None = None) -> DataFrame:
    return with_lineage(read_csv_keeping_corrupt(spark, path, schemas.CALENDAR), run_time)


def good_lines(raw: DataFrame) -> DataFrame:
    """The lines of a stored raw table that could be read, without the column of unreadable ones."""
    if CORRUPT_COLUMN not in raw.columns:
        return raw
    return raw.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def rejected_lines(raw: DataFrame) -> DataFrame:
    """(line, source_file, ingestion_date) of the unreadable lines of a stored raw table."""
    return raw.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(
        F.col(CORRUPT_COLUMN).alias("line"), "source_file", "ingestion_date")
