"""Quality gate: checks as data, one aggregate pass, a result frame, a raise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.functions.text import EMAIL_PATTERN, PRODUCT_CODE_PATTERN
from storeloom.operators.combine import union_by_name
from storeloom.operators.joins import orphaned_share
from storeloom.operators.order_statistics import percentile_struct

ERROR = "Error"
WARNING = "Warning"
SUCCESS = "Success"
FAILURE = "Failure"


class QualityError(AssertionError):
    """At least one error-level check failed; the message lists every failure."""


@dataclass(frozen=True)
class Check:
    """A metric of a frame that must reach ``at_least``."""

    name: str
    metric: str
    at_least: float
    column: str | None = None
    pattern: str | None = None
    level: str = ERROR

    @property
    def constraint(self) -> str:
        return f"{self.metric}({self.column or '*'}) >= {self.at_least:g}"


def has_size(min_rows: int, level: str = ERROR) -> Check:
    return Check(f"size_at_least_{min_rows}", "size", float(min_rows), level=level)


def not_null(column: str, level: str = ERROR, min_ratio: float = 1.0) -> Check:
    return Check(f"{column}_not_null", "completeness", min_ratio, column, level=level)


def unique(column: str, level: str = ERROR, min_ratio: float = 1.0) -> Check:
    """Share of non-NULL rows whose value occurs once."""
    return Check(f"{column}_unique", "uniqueness", min_ratio, column, level=level)


def matches(column: str, pattern: str, level: str = ERROR, min_ratio: float = 1.0,
            name: str | None = None) -> Check:
    """Share of rows that do not contradict the pattern; NULL does not."""
    return Check(name or f"{column}_format", "validity", min_ratio, column, pattern, level)


def email_format(column: str = "email", level: str = WARNING, min_ratio: float = 1.0) -> Check:
    return matches(column, EMAIL_PATTERN, level, min_ratio)


def product_code_format(column: str = "PRODUCTCODE", level: str = ERROR, min_ratio: float = 1.0) -> Check:
    return matches(column, PRODUCT_CODE_PATTERN, level, min_ratio)


def positive(column: str, level: str = WARNING, min_ratio: float = 1.0) -> Check:
    """Not part of any suite by default: refunds are negative by design."""
    return Check(f"{column}_positive", "positivity", min_ratio, column, level=level)


CUSTOMER_SUITE = (has_size(1000), not_null("customer_id"), unique("customer_id"))
TRANSACTION_SUITE = (has_size(1000), not_null("ORDERNUMBER"), not_null("PRODUCTCODE"),
                     not_null("CUSTOMERNAME"))
CALENDAR_SUITE = (has_size(5000), not_null("CALENDAR_DATE"), unique("CALENDAR_DATE"))


def at_level(checks: tuple[Check, ...], level: str) -> tuple[Check, ...]:
    """The same checks at another level, e.g. a suite that only warns."""
    return tuple(Check(c.name, c.metric, c.at_least, c.column, c.pattern, level) for c in checks)


def share(count: Column, total: Column) -> Column:
    """A share of no rows at all is complete."""
    return F.coalesce(F.try_divide(count.cast("double"), total.cast("double")), F.lit(1.0))


def passing_rows(check: Check) -> Column:
    """Aggregate: the rows that pass a check of single rows."""
    rows = F.count(F.lit(1))
    if check.metric == "size":
        return rows
    column = F.col(check.column)
    if check.metric == "completeness":
        return F.count(column)
    if check.metric == "validity":
        return rows - F.count_if(~column.rlike(check.pattern))
    if check.metric == "positivity":
        return rows - F.count_if(column <= 0)
    raise ValueError(f"no such metric: {check.metric}")


def _scan_metric(check: Check) -> Column:
    passing = passing_rows(check)
    return passing.cast("double") if check.metric == "size" else share(passing, F.count(F.lit(1)))


def _uniqueness(df: DataFrame, check: Check) -> DataFrame:
    counts = (df.filter(F.col(check.column).isNotNull())
              .groupBy(check.column).agg(F.count(F.lit(1)).alias("n")))
    return counts.agg(share(F.count_if(F.col("n") == 1), F.sum("n")).alias("value"))


def verdict(check: Check, value: Column) -> Column:
    passed = value >= F.lit(check.at_least)
    return F.struct(
        F.lit(check.name).alias("check"), F.lit(check.constraint).alias("constraint"),
        F.lit(check.level).alias("level"),
        F.when(passed, SUCCESS).otherwise(FAILURE).alias("status"),
        value.alias("value"),
        F.when(~passed, F.concat(F.lit("value "), value.cast("string"), F.lit(f" is below {check.at_least:g}")))
        .otherwise(F.lit("")).alias("message"),
    )


def evaluate(df: DataFrame, checks: tuple[Check, ...] | list[Check]) -> DataFrame:
    """One row per check. All scan metrics share one pass; each uniqueness adds a group-by."""
    scans = [c for c in checks if c.metric != "uniqueness"]
    frames = []
    if scans:
        metrics = df.agg(*[_scan_metric(c).alias(f"m{i}") for i, c in enumerate(scans)])
        rows = F.array(*[verdict(c, F.col(f"m{i}")) for i, c in enumerate(scans)])
        frames.append(metrics.select(F.inline(rows)))
    for check in checks:
        if check.metric == "uniqueness":
            frames.append(_uniqueness(df, check).select(F.inline(F.array(verdict(check, F.col("value"))))))
    return union_by_name(frames)


def enforce(results: DataFrame) -> list:
    """Return the result rows, or raise one error that lists every error-level failure.

    A result frame has one row per check, so collecting it is bounded by the suite.
    """
    rows = results.collect()
    failed = [r for r in rows if r["status"] == FAILURE and r["level"] == ERROR]
    if failed:
        listed = "; ".join(f"{r['constraint']} ({r['message']})" for r in failed)
        raise QualityError(f"{len(failed)} of {len(rows)} checks do not hold: {listed}")
    return rows


def profile_rules(df: DataFrame, rules: dict[str, dict[str, bool]]) -> DataFrame:
    """One row: ``<column>_null_count`` and ``<column>_unique_ratio`` as asked for.

    Unknown columns are skipped. The ratio is distinct values over rows, with
    NULL as one value, and 0 for an empty frame.
    """
    rows = F.count(F.lit(1))
    metrics = []
    for column, rule in rules.items():
        if column not in df.columns:
            continue
        if rule.get("null_check"):
            metrics.append(F.count_if(F.col(column).isNull()).alias(f"{column}_null_count"))
        if rule.get("unique_check"):
            distinct = F.count_distinct(column) + F.coalesce(
                F.max(F.col(column).isNull().cast("int")), F.lit(0))
            ratio = F.try_divide(distinct.cast("double"), rows.cast("double"))
            metrics.append(F.coalesce(ratio, F.lit(0.0)).alias(f"{column}_unique_ratio"))
    return df.agg(*(metrics or [rows.alias("row_count")]))


def profile_columns(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, completeness, least and greatest value."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    rows = F.count(F.lit(1))
    stats = df.agg(rows.alias("rows"), *[
        F.struct(F.count(F.col(c)).alias("filled"), distinct(F.col(c)).alias("distinct_count"),
                 F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value")).alias(f"s{i}")
        for i, c in enumerate(columns)])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("row_count"),
                 (F.col("rows") - F.col(f"s{i}.filled")).alias("null_count"),
                 F.col(f"s{i}.distinct_count").alias("distinct_count"),
                 share(F.col(f"s{i}.filled"), F.col("rows")).alias("completeness"),
                 F.col(f"s{i}.min_value").alias("min_value"), F.col(f"s{i}.max_value").alias("max_value"))
        for i, c in enumerate(columns)])
    return stats.select(F.inline(entries))


def within_share(measured: DataFrame, limit: float, name: str) -> DataFrame:
    """Verdict row for a measured ``share`` that must not exceed ``limit``."""
    return measured.select(
        F.lit(name).alias("check"), F.col("share"), F.lit(float(limit)).alias("limit"),
        F.when(F.col("share") <= F.lit(float(limit)), SUCCESS).otherwise(FAILURE).alias("status"))


def referential_integrity(df: DataFrame, key: str, dimension: DataFrame, dimension_key: str,
                          limit: float) -> DataFrame:
    measured = orphaned_share(df, F.col(key), dimension, F.col(dimension_key))
    return within_share(measured, limit, f"{key}_in_{dimension_key}")


def anomalies(df: DataFrame, column: str, spread: float = 1.5) -> DataFrame:
    """Flag rows outside the quartiles widened by ``spread`` times their distance.

    The quartiles come from counting passes over the one column.
    """
    quartiles = percentile_struct(df, column, 0.25, 0.75)
    low, high = (quartiles.getField(f).cast("double") for f in ("lower", "upper"))
    value = F.col(column).cast("double")
    reach = (high - low) * F.lit(float(spread))
    outside = (value < low - reach) | (value > high + reach)
    return df.withColumn("is_anomaly", F.coalesce(outside, F.lit(False)))


def anomalous_share(df: DataFrame, column: str, spread: float = 1.5) -> DataFrame:
    rows, flagged = F.count(F.lit(1)), F.count_if("is_anomaly")
    return anomalies(df, column, spread).agg(
        rows.alias("rows"), flagged.alias("anomalies"),
        F.coalesce(F.try_divide(flagged.cast("double"), rows.cast("double")), F.lit(0.0)).alias("share"))


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add the names of all row rules that a row breaks; an unknown outcome is no breach."""
    broken = F.array(*[F.when(~holds, F.lit(name)) for name, holds in rules.items()])
    return df.withColumn("reject_reasons", F.array_compact(broken))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that pass every rule and rejects with their reasons."""
    judged = with_reasons(df, rules)
    clean = F.size("reject_reasons") == 0
    return judged.filter(clean).drop("reject_reasons"), judged.filter(~clean)
