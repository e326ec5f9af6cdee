"""Text keys, names and patterns."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Accepted e-mail and product-code patterns.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PRODUCT_CODE_PATTERN = r"^S[0-9]+_[0-9]+$"

UNKNOWN_FAMILY = "UNKNOWN"


def customer_id(first: Column, last: Column, email: Column) -> Column:
    """Lower-cased parts joined by ``_``; NULL parts are left out."""
    return F.concat_ws("_", F.lower(first), F.lower(last), F.lower(email))


def printed_customer_id(first: Column, last: Column, email: Column) -> Column:
    """Key variant of the SQL function: NULL prints as ``none``, blanks become ``_``."""
    parts = [F.coalesce(part, F.lit("None")) for part in (first, last, email)]
    joined = F.concat(parts[0], F.lit("_"), parts[1], F.lit("_"), parts[2])
    return F.lower(F.replace(joined, F.lit(" "), F.lit("_")))


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def name_key(name: Column) -> Column:
    """Normal form under which two spellings of a name count as equal."""
    return F.upper(F.trim(name))


def product_family(code: Column) -> Column:
    """Text before the first underscore; UNKNOWN where there is none."""
    return F.when(F.instr(code, "_") > 0, F.substring_index(code, "_", 1)).otherwise(UNKNOWN_FAMILY)


def mentions(text: Column, word: str) -> Column:
    """Case-insensitive containment."""
    return F.lower(text).contains(word.lower())


def is_invalid_email(email: Column) -> Column:
    """True for a malformed address; NULL stays NULL and so is never counted."""
    return ~email.rlike(EMAIL_PATTERN)


def register_sql_functions(spark: SparkSession) -> None:
    """Expose the domain functions to SQL text as inlined SQL functions."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION product_family(code STRING) RETURNS STRING
        RETURN CASE WHEN instr(code, '_') > 0 THEN substring_index(code, '_', 1) ELSE 'UNKNOWN' END
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION create_customer_id(
            first_name STRING, last_name STRING, email STRING) RETURNS STRING
        RETURN lower(replace(concat(coalesce(first_name, 'None'), '_', coalesce(last_name, 'None'),
                                    '_', coalesce(email, 'None')), ' ', '_'))
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION calculate_restocking_fee(
            amount DECIMAL(18,4), status STRING, fee_rate DECIMAL(12,10) DEFAULT 0.1) RETURNS DOUBLE
        RETURN CASE WHEN contains(lower(status), 'refund') THEN CAST(amount * fee_rate AS DOUBLE) ELSE 0D END
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION calculate_refund_with_fee(
            original_amount DECIMAL(18,4), is_refund BOOLEAN)
        RETURNS STRUCT<final_amount: DOUBLE, restocking_fee: DOUBLE>
        RETURN CASE WHEN is_refund
            THEN named_struct('final_amount', CAST(original_amount - original_amount * 0.10 AS DOUBLE),
                              'restocking_fee', CAST(original_amount * 0.10 AS DOUBLE))
            ELSE named_struct('final_amount', CAST(original_amount AS DOUBLE), 'restocking_fee', 0D) END
    """)
