import time
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom import schemas
from storeloom.plans import sales, star
from storeloom.sources import files
from storeloom.streaming import generations, landing

HEAD = ",".join(schemas.TRANSACTIONS.names)


def drop_file(folder, name, *orders):
    folder.mkdir(exist_ok=True)
    body = [f"{n},1,1,{amount},{day} 0:00,1,1,2020,S1_1,c,p,a,,c,,1,US,NA,Lee,Ann,Small" for n, amount, day in orders]
    (folder / name).write_text("\n".join([HEAD, *body]) + "\n")


def totals(spark, path):
    return {(str(r["order_date"]), r["transaction_type"]): (float(r["net_amount"]), r["lines"])
            for r in landing.daily_totals(spark, path).collect()}


def test_daily_totals_grow_with_new_files(spark, tmp_path):
    zone, out, state = tmp_path / "zone", str(tmp_path / "partials"), str(tmp_path / "state")

    def run():
        lines = landing.landing_stream(spark, str(zone), schemas.TRANSACTIONS, files_per_batch=1)
        landing.run_daily_partials(star.fact_transactions(lines, run_time=datetime(2024, 1, 1)), out, state)
        return totals(spark, out)

    drop_file(zone, "a.csv", (1, 10, "1/2/2020"), (2, -20, "1/2/2020"))
    drop_file(zone, "b.csv", (3, 5, "1/3/2020"))
    assert run() == {("2020-01-02", "SALE"): (10.0, 1), ("2020-01-02", "REFUND"): (18.0, 1), ("2020-01-03", "SALE"): (5.0, 1)}
    assert run()["2020-01-02", "SALE"] == (10.0, 1)  # nothing new: nothing counted twice
    drop_file(zone, "c.csv", (4, 7, "1/2/2020"))  # a late line adds to its day
    assert run()["2020-01-02", "SALE"] == (17.0, 2)


def test_retried_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "partials")
    rows = spark.createDataFrame([(1,)], "i int").select(
        F.lit("2020-01-02").cast("date").alias("order_date"), F.lit("SALE").alias("transaction_type"),
        F.lit(3).cast("decimal(18,4)").alias("net_amount"), F.lit(0).cast("decimal(17,4)").alias("restocking_fee"))
    kept = {}
    original = landing.run_batches
    try:
        landing.run_batches = lambda stream, handle, checkpoint: kept.update(handle=handle)
        landing.run_daily_partials(rows, out, "unused")
    finally:
        landing.run_batches = original
    for batch in (0, 0, 1):
        kept["handle"](rows, batch)
    assert totals(spark, out) == {("2020-01-02", "SALE"): (6.0, 2)}


def test_a_batch_leaves_no_shuffle_files_and_holds_what_it_uses(spark, tmp_path, monkeypatch):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    kept, held, persist = {}, [], type(spark.range(1)).persist
    monkeypatch.setattr(landing, "run_batches", lambda stream, handle, checkpoint: kept.update(handle=handle))
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda df, *level: held.append(df.columns) or persist(df, *level))
    lines = spark.range(100).selectExpr(
        "id as ORDERNUMBER", "1 as QUANTITYORDERED", "id - 50D as TOTAL_AMOUNT", "'1/2/2020 0:00' as ORDERDATE", "concat('S1_', id) as PRODUCTCODE",
        "'+1' as PHONE", "'1 St' as ADDRESSLINE1", "'NA' as TERRITORY", "'Lee' as CONTACTLASTNAME", "'Ann' as CONTACTFIRSTNAME", "'Small' as DEALSIZE")
    out = str(tmp_path / "partials")
    landing.run_daily_partials(star.fact_transactions(lines, run_time=datetime(2024, 1, 1)), out, "unused", merge_every=2)
    before = shuffled()
    for batch in range(2):
        kept["handle"](star.fact_transactions(lines, run_time=datetime(2024, 1, 1)), batch)  # no shuffle of its own
    deadline = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    assert [sorted(c) for c in held] == [sorted([*landing.DAILY_KEYS, "net_amount", "restocking_fee", "order_number", "customer_name", "product_code"])] * 2
    assert totals(spark, out) == {("2020-01-02", "REFUND"): (0.9 * 1275 * 2, 100), ("2020-01-02", "SALE"): (1225.0 * 2, 100)}


SUMS = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("m", T.DecimalType(38, 2))])


def state(spark, store):
    return {tuple(r) for r in generations.read(spark, store).collect()}


def test_generations(spark, tmp_path, monkeypatch):
    store = generations.sums_store(str(tmp_path / "sums"), SUMS, ["k"])
    assert state(spark, store) == set() and generations.merge_batches(spark, store) == 0

    def batch(number, *rows):
        generations.write_batch(store, spark.createDataFrame(rows, "k string, n int, m decimal(9,2)"), number)

    batch(0, ("a", 1, Decimal(2)), ("a", 1, None), (None, 5, None))
    batch(1, ("a", 1, Decimal(1)))
    want = {("a", 3, Decimal(3)), (None, 5, None)}
    assert state(spark, store) == want
    assert generations.merge_batches(spark, store) == 2 and state(spark, store) == want
    batch(1, ("a", 1, Decimal(1)))  # retried after the merge: already part of it
    assert state(spark, store) == want and generations.merge_batches(spark, store) == 0
    batch(2, ("b", 1, Decimal(1)))
    # A job lost before the marker is written leaves the old state; one lost before the clean-up the new one.
    with monkeypatch.context() as lost:
        lost.setattr(generations, "COMMIT", None)
        with pytest.raises(Exception):
            generations.merge_batches(spark, store)
    want = want | {("b", 1, Decimal(1))}
    assert state(spark, store) == want and [c[0] for c in generations.commits(spark, store)] == [1]
    with monkeypatch.context() as lost:
        lost.setattr(generations, "clean", lambda *_: None)
        assert generations.merge_batches(spark, store) == 1
    assert state(spark, store) == want
    for number in range(3, 12):
        batch(number, ("c", 1, Decimal(1)))
        generations.merge_batches(spark, store)
    assert state(spark, store) == want | {("c", 9, Decimal(9))}
    left = {kind: len(list((tmp_path / "sums" / kind).iterdir())) for kind in ("batch", "generation", "commit")}
    assert left == {"batch": 1, "generation": 2, "commit": 2}  # no more with more batches


def test_sets_keep_a_member_once(spark, tmp_path):
    store = generations.set_store(str(tmp_path / "set"), T.StructType([T.StructField("d", T.DateType()), T.StructField("m", T.StringType())]))
    for number in range(4):
        generations.write_batch(store, spark.createDataFrame([(None, "x"), (None, "x"), (None, f"y{number // 2}")], "d date, m string"), number)
        if number == 1:
            generations.merge_batches(spark, store)
    assert sorted(m for _, m in state(spark, store)) == ["x", "y0", "y1"] and generations.read(spark, store).count() == 3


def test_insights_from_the_stream_equal_the_batch(spark, tmp_path):
    zone, out, progress = tmp_path / "zone", str(tmp_path / "partials"), str(tmp_path / "state")
    for i in range(7):
        drop_file(zone, f"{i}.csv", *[(j, 10 * j - 15, f"1/{1 + (i + j) % 5}/2020") for j in range(6)])
        if i in (3, 6):
            lines = landing.landing_stream(spark, str(zone), schemas.TRANSACTIONS, files_per_batch=1)
            landing.run_daily_partials(star.fact_transactions(lines, run_time=datetime(2024, 1, 1)), out, progress, merge_every=3)
    fact = star.fact_transactions(files.read_csv(spark, str(zone), schemas.TRANSACTIONS), run_time=datetime(2024, 1, 1))
    want, got = sales.daily_insights(fact), landing.daily_insights(spark, out)
    assert got.columns == want.columns
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and want.count() == 5


def test_ingest_is_exactly_once(spark, tmp_path):
    zone, out, state = tmp_path / "zone", str(tmp_path / "raw"), str(tmp_path / "state")
    for name in ("a.csv", "b.csv"):
        drop_file(zone, name, (1, 10, "1/2/2020"))
        for _ in range(2):
            landing.run_to_table(landing.landing_stream(spark, str(zone), schemas.TRANSACTIONS), out, state)
    assert spark.read.parquet(out).count() == 2


def test_windows_close_by_watermark(spark, tmp_path):
    zone, out, state = str(tmp_path / "zone"), str(tmp_path / "out"), str(tmp_path / "state")
    spark.createDataFrame([(datetime(2024, 1, d, 12), "a", d) for d in (1, 1, 2, 4)],
                          "ts timestamp, kind string, v int").write.parquet(zone)
    stream = landing.landing_stream(spark, zone, spark.read.parquet(zone).schema, fmt="parquet")
    landing.run_to_table(landing.windowed_totals(stream, "ts", "v", ["kind"]), out, state)
    got = sorted((r["window_start"].day, r["events"], r["total"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 2, 2), (2, 1, 2)]


def test_repeats_are_dropped(spark, tmp_path):
    zone, out, state = str(tmp_path / "zone"), str(tmp_path / "out"), str(tmp_path / "state")
    events = spark.createDataFrame([(datetime(2024, 1, 1, h), h) for h in range(5)], "ts timestamp, id int")
    for _ in range(3):
        events.write.mode("append").parquet(zone)
    stream = landing.landing_stream(spark, zone, events.schema, fmt="parquet")
    landing.run_to_table(landing.distinct_events(stream, ["id"], "ts", "1 day"), out, state)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
