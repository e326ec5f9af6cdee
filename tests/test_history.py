"""Late snapshots against the history of all snapshots in order; the version of a day against a search of the intervals."""

import itertools
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from storeloom.operators import history as h

DAYS = [date(2020, 1, 1) + timedelta(days=30 * i) for i in range(5)]
SCHEMA = "k string, a string, b int"


def snapshots(rng):
    """Complete states of a few keys, which come, go, change and change back."""
    out = []
    for _ in DAYS:
        keys = [k for k in ["u", "v", "w", "x", "y", None] if rng.random() < 0.7]
        out.append([(k, rng.choice(["p", "q", None]), rng.choice([1, 1, None])) for k in keys])
    return out


def in_order(states):
    out = set()
    for k in {r[0] for s in states for r in s}:
        opened = None
        for day, state in [*zip(DAYS, states), (None, [])]:
            value = next((r[1:] for r in state if r[0] == k), "absent") if day else "end"
            if opened and value != opened[0]:
                out.add((k, *opened[0], opened[1], day, day is None))
                opened = None
            if day and value != "absent" and not opened:
                opened = (value, day)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_late_snapshots_give_the_history_in_order(spark, seed):
    rng = random.Random(seed)
    states = snapshots(rng)
    frames = [spark.createDataFrame(s, SCHEMA) for s in states]
    # The first and the last come in time, the others late, in any order.
    late = [1, 2, 3]
    rng.shuffle(late)
    got = h.new_history(frames[0], DAYS[0])
    got = h.apply_snapshot(got, frames[4], "k", ["a", "b"], DAYS[4], close_missing=True)
    known = [0, 4]
    for i in late:
        following = DAYS[min(j for j in known if j > i)]
        got = spark.createDataFrame(h.apply_late_snapshot(got, frames[i], "k", ["a", "b"], DAYS[i], following).collect(),
                                    f"{SCHEMA}, valid_from date, valid_to date, is_current boolean")
        known.append(i)
    assert {tuple(r) for r in got.collect()} == in_order(states) and got.count() == len(in_order(states))


def test_all_ways_a_version_can_be_split(spark):
    """One key whose state takes any of two values or is absent, in all combinations over three days."""
    values = ["p", "q", None]
    keys = [(f"{i}", c) for i, c in enumerate(itertools.product(values, repeat=3))]
    frames = [spark.createDataFrame([(k, c[i], 1) for k, c in keys if c[i]], SCHEMA) for i in range(3)]
    got = h.apply_snapshot(h.new_history(frames[0], DAYS[0]), frames[2], "k", ["a", "b"], DAYS[4], close_missing=True)
    got = h.apply_late_snapshot(got, frames[1], "k", ["a", "b"], DAYS[2], DAYS[4])
    states = [[(k, c[i], 1) for k, c in keys if c[i]] for i in (0, 0, 1, 1, 2)]
    assert {tuple(r) for r in got.collect()} == in_order(states)


def test_a_repeated_key_is_an_error(spark):
    one = spark.createDataFrame([("u", "p", 1)], SCHEMA)
    got = h.apply_late_snapshot(h.new_history(one, DAYS[0]), one.union(one), "k", ["a", "b"], DAYS[1], DAYS[2])
    with pytest.raises(Exception, match="more than once"):
        got.collect()


@pytest.mark.parametrize("most_rows", [1_000_000, 50])
def test_the_version_of_a_day(spark, most_rows):
    rng = random.Random(9)
    history = [("u", "p", DAYS[0], DAYS[1]), ("u", "q", DAYS[1], DAYS[3]), ("u", "r", DAYS[4], None), ("v", "s", DAYS[2], None),
               (None, "t", DAYS[0], None)]
    facts = [(i, rng.choice(["u"] * 8 + ["v", "w", None]), rng.choice([*DAYS, DAYS[0] - timedelta(days=1), DAYS[4] + timedelta(days=9), None]))
             for i in range(400)]
    frame = spark.createDataFrame(facts, "i int, who string, day date")
    versions = spark.createDataFrame([(*v, v[3] is None) for v in history],
                                     "k string, level string, valid_from date, valid_to date, is_current boolean")
    got = h.valid_at(frame, versions, "who", "k", "day", ["level"], most_rows)
    want = {(i, who, day, next((s for k, s, a, b in history if k == who is not None and day and a <= day and (b is None or day < b)), None))
            for i, who, day in facts}
    assert {tuple(r) for r in got.collect()} == want and got.count() == 400
    assert got.columns == ["i", "who", "day", "level"]
    assert h.valid_at(frame, versions.filter(F.lit(False)), "who", "k", "day", ["level"], most_rows).filter("level is not null").count() == 0
