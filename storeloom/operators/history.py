"""Slowly changing dimension, look-up of the version of a day, and retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.scratch import stage


def new_history(snapshot: DataFrame, valid_from: date | Column) -> DataFrame:
    """Open a history: every row of the snapshot is current."""
    start = valid_from if isinstance(valid_from, Column) else F.lit(valid_from)
    return snapshot.withColumns({
        "valid_from": start.cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str],
                   valid_from: date | Column, close_missing: bool = False) -> DataFrame:
    """Type-2 step: close changed rows, open their new versions, add new keys.

    One full outer join of the current rows with the snapshot. Tracked columns
    are compared as values, not as hashes, so no change can be missed. Closed
    rows of earlier steps pass through untouched. A NULL key meets itself; a row
    without ``is_current`` is past; a key that the snapshot repeats is an error.
    """
    start = (valid_from if isinstance(valid_from, Column) else F.lit(valid_from)).cast("date")
    past = history.filter(~F.coalesce("is_current", F.lit(False)))
    columns = [key, *tracked]
    now = history.filter("is_current").select(
        F.col(key).alias("k"),
        F.struct(*columns, "valid_from").alias("old"))
    row = F.struct(*columns)
    repeated = F.raise_error(F.concat(F.lit("the snapshot has a key more than once: "), F.coalesce(F.col("s").cast("string"), F.lit("NULL"))))
    new = (snapshot.select(F.col(key).alias("s"), row.alias("new")).groupBy("s")
           .agg(F.count(F.lit(1)).alias("n"), F.first("new").alias("new"))
           .select("s", F.when(F.col("n") == 1, F.col("new")).otherwise(repeated).alias("new")))
    pair = now.join(new, F.col("k").eqNullSafe(F.col("s")), "full_outer")

    is_old, is_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = F.lit(True)
    for column in tracked:
        same = same & F.col(f"old.{column}").eqNullSafe(F.col(f"new.{column}"))
    ends = is_old & ((is_new & ~same) | (F.lit(close_missing) & ~is_new))
    opens = is_new & (~is_old | ~same)

    def version(side: str, valid_from: Column, valid_to: Column, current: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns],
                        valid_from.alias("valid_from"), valid_to.alias("valid_to"), current.alias("is_current"))

    kept = version("old", F.col("old.valid_from"), F.when(ends, start), ~ends)
    opened = version("new", start, F.lit(None).cast("date"), F.lit(True))
    rows = F.array_compact(F.array(F.when(is_old, kept), F.when(opens, opened)))
    current = pair.select(F.inline(rows))
    return past.select(*current.columns).unionByName(current)


def apply_late_snapshot(history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], day: date | Column,
                        next_day: date | Column) -> DataFrame:
    """Type-2 step for a complete snapshot of ``day`` that comes after a later one, of ``next_day``, was applied.

    The result is the history that all snapshots in the order of their days would have given. The state of ``day`` holds up
    to ``next_day``, the first later day that was applied, so the version that spans ``day`` is split: it ends there, the
    state of the snapshot takes its place, and it opens anew on ``next_day`` if it holds beyond it. A key that the
    snapshot lacks has no version between the two days. Where the state equals that of the version that starts on
    ``next_day``, both become one. History and snapshots must be complete (``apply_snapshot`` with ``close_missing``).

    Only the versions around ``day`` are joined, at most two a key; all others pass through untouched. A NULL key meets
    itself; a key that the snapshot repeats is an error.
    """
    start, following = (((d if isinstance(d, Column) else F.lit(d)).cast("date")) for d in (day, next_day))
    columns = [key, *tracked]
    spans = (F.col("valid_from") < start) & (F.col("valid_to").isNull() | (F.col("valid_to") > start))
    follows = F.col("valid_from") == following
    row = F.struct(*columns, "valid_from", "valid_to", "is_current")
    around = history.filter(spans | follows).groupBy(F.col(key).alias("k")).agg(
        F.max(F.when(spans, row)).alias("old"), F.max(F.when(follows, row)).alias("next"))
    repeated = F.raise_error(F.concat(F.lit("the snapshot has a key more than once: "), F.coalesce(F.col("s").cast("string"), F.lit("NULL"))))
    state = (snapshot.select(F.col(key).alias("s"), F.struct(*columns).alias("new")).groupBy("s")
             .agg(F.count(F.lit(1)).alias("n"), F.first("new").alias("new"))
             .select("s", F.when(F.col("n") == 1, F.col("new")).otherwise(repeated).alias("new")))
    pair = around.join(state, F.col("k").eqNullSafe(F.col("s")), "full_outer")

    def alike(one: str, other: str) -> Column:
        same = F.lit(True)
        for column in tracked:
            same = same & F.col(f"{one}.{column}").eqNullSafe(F.col(f"{other}.{column}"))
        return F.col(one).isNotNull() & F.col(other).isNotNull() & same

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], valid_from.alias("valid_from"),
                        valid_to.alias("valid_to"), valid_to.isNull().alias("is_current"))

    old, new, after = F.col("old").isNotNull(), F.col("new").isNotNull(), F.col("next").isNotNull()
    holds, joins = alike("old", "new"), alike("new", "next")
    lasts = F.col("old.valid_to").isNull() | (F.col("old.valid_to") > following)
    versions = F.array_compact(F.array(
        F.when(old & holds, version("old", F.col("old.valid_from"), F.col("old.valid_to"))),
        F.when(old & ~holds, version("old", F.col("old.valid_from"), start)),
        F.when(new & ~holds, version("new", start, F.when(joins, F.col("next.valid_to")).otherwise(following))),
        F.when(old & ~holds & lasts, version("old", following, F.col("old.valid_to"))),
        F.when(after & (holds | ~joins), version("next", F.col("next.valid_from"), F.col("next.valid_to")))))
    untouched = history.filter(~F.coalesce(spans | follows, F.lit(False)))
    changed = pair.select(F.inline(versions))
    return untouched.select(*changed.columns).unionByName(changed)


def valid_at(facts: DataFrame, history: DataFrame, fact_key: str, history_key: str, day: str, columns: list[str],
             most_rows: int = 1_000_000) -> DataFrame:
    """Every fact with the columns of the version of its key that was valid on its day, NULL where there was none.

    An equi-join on the key with the interval as a further condition; the versions of a key do not overlap, so no fact is
    repeated. A key with more than ``most_rows`` facts is split: its facts are dealt to parts, and its few versions are given
    to each of them. The part follows from the values of a fact, so a repeated task deals it alike; facts alike in all columns
    stay together. Of all facts over ``most_rows`` there are at most that many such keys.
    """
    counts = facts.groupBy(F.col(fact_key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_rows)
    hot = stage(counts.select("hot_key", F.ceil(F.col("n") / most_rows).cast("int").alias("parts")), "hot-keys")
    dealt = facts.join(hot, F.col(fact_key) == F.col("hot_key"), "left").withColumn(
        "part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(*facts.columns), F.col("parts")).cast("int")).otherwise(0)).drop("hot_key", "parts")
    versions = history.select(F.col(history_key).alias("version_key"), "valid_from", "valid_to", *columns)
    given = versions.join(hot, F.col("version_key") == F.col("hot_key"), "left").withColumn(
        "version_part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("hot_key", "parts")
    valid = ((F.col(fact_key) == F.col("version_key")) & (F.col("part") == F.col("version_part")) & (F.col(day) >= F.col("valid_from"))
             & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to"))))
    return dealt.join(given, valid, "left").drop("part", "version_key", "version_part", "valid_from", "valid_to")


def retained(df: DataFrame, day: str, as_of: date | Column, keep_days: int) -> DataFrame:
    """Rows inside the retention period; a plain date filter, so partitions are pruned.

    Rows without a day stay: their age is unknown.
    """
    limit = F.date_sub(as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date"), keep_days)
    return df.filter(F.col(day).isNull() | (F.col(day) >= limit))
