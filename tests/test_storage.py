from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from storeloom import schemas, scratch
from storeloom.config import QualityThresholds
from storeloom.operators import quality
from storeloom.plans import refresh
from storeloom.sinks import tables, warehouse
from storeloom.sources import files
from storeloom.sources.tables import read_table
from workload import storage

RUN = datetime(2024, 1, 31, 6, 0)

HEADERS = {
    "us": "first_name,last_name,company_name,address,city,county,state,zip,phone1,phone2,email,web",
    "uk": "first_name,last_name,company_name,address,city,county,postal,phone1,phone2,email,web",
    "au": "first_name,last_name,company_name,address,city,state,post,phone1,phone2,email,web",
    "ca": "first_name,last_name,company_name,address,city,province,postal,phone1,phone2,email,web",
}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    write = lambda name, *lines: (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    write("us.csv", "\ufeff" + HEADERS["us"], 'Ann,Lee,"Lee, Inc",1 St,Reno,Washoe,NV,00123,1,2,a@b.co,w',
          "Bob,Ray,Ray,2 St,Reno,,NV,00124,1,2,bob@b.co,w")
    write("us2.csv", HEADERS["us"], "Cid,Fox,Fox,3 St,Reno,,NV,00125,1,2,cid@b.co,w")
    write("uk.csv", HEADERS["uk"], "Dee,Hay,Hay,4 St,Bath,Avon,BA1 1AA,1,2,dee@b.co,w")
    write("au.csv", HEADERS["au"], "Eve,Ash,Ash,5 St,Perth,WA,6000,1,2,eve@b.co,w")
    write("ca.csv", HEADERS["ca"], "ANN,LEE,Lee,6 St,Banff,AB,T1L,1,2,A@B.CO,w")
    return str(folder)


def test_one_scan_per_header(spark, landing):
    groups = files.files_by_header(spark, landing)
    assert sorted(len(paths) for paths in groups.values()) == [1, 1, 1, 2]
    assert all(header[0] == "first_name" for header in groups)


def test_drifting_headers_land_in_the_right_column(spark, landing):
    out = {r["first_name"]: r for r in files.read_drifting(spark, landing, files.CUSTOMER_HEADERS, RUN).collect()}
    assert (out["Ann"]["postal_code"], out["Ann"]["state"], out["Ann"]["company_name"]) == ("00123", "NV", "Lee, Inc")
    assert (out["Dee"]["postal_code"], out["Dee"]["state"], out["Dee"]["county"]) == ("BA1 1AA", None, "Avon")
    assert (out["Eve"]["postal_code"], out["Eve"]["state"], out["Eve"]["county"]) == ("6000", "WA", None)
    assert (out["ANN"]["postal_code"], out["ANN"]["state"]) == ("T1L", "AB")
    assert out["Dee"]["source_file"].endswith("uk.csv") and out["Dee"]["ingestion_date"] == RUN


def test_ten_thousand_small_files(spark, tmp_path):
    heads = ["id,zip", "id,postal,state", "id,province,zip"]
    for i in range(10_000):
        folder = tmp_path / str(i % 100)
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.csv").write_text(f"{heads[i % 3]}\n{i},a,b\n" if i % 3 else f"{heads[0]}\n{i},a\n")
    groups = files.files_by_header(spark, str(tmp_path))
    assert {",".join(h): len(p) for h, p in groups.items()} == {heads[0]: 3334, heads[1]: 3333, heads[2]: 3333}
    got = files.read_drifting(spark, str(tmp_path), files.CUSTOMER_HEADERS, RUN)
    out = got.groupBy((F.col("id").cast("int") % 3).alias("kind"), "postal_code", "state").count().collect()
    assert {tuple(r) for r in out} == {(0, "a", None, 3334), (1, "a", "b", 3333), (2, "b", "a", 3333)}


@pytest.mark.parametrize("most_tasks", [None, "2"])
def test_first_lines_of_split_files(spark, tmp_path, monkeypatch, most_tasks):
    """Files of many splits beside small, empty and blank ones."""
    for i in range(5):
        (tmp_path / f"large{i}.csv").write_text(f"head{i},b\n" + "1,2\n" * 60_000)
        (tmp_path / f"small{i}.csv").write_text(f"tiny{i}\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\nx,y\n")
    for key, value in (("spark.sql.files.maxPartitionBytes", "50000"), ("spark.sql.files.openCostInBytes", "100"),
                       ("spark.sql.files.maxPartitionNum", most_tasks)):
        if value is not None:
            spark.conf.set(key, value)
    try:
        got = {r["source_file"].rsplit("/", 1)[1]: r["line"] for r in files.first_lines(spark, str(tmp_path)).collect()}
    finally:
        for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionNum"):
            spark.conf.unset(key)
    assert got == {**{f"large{i}.csv": f"head{i},b" for i in range(5)}, **{f"small{i}.csv": f"tiny{i}" for i in range(5)}, "blank.csv": ""}
    assert sorted(h[0] for h in files.files_by_header(spark, str(tmp_path))) == sorted([f"head{i}" for i in range(5)] + [f"tiny{i}" for i in range(5)])


def test_surplus_fields_are_rejected(spark, tmp_path):
    lines = ["u1,NV,", 'u2,"a, b",', "u3,NV", "u4", "u5,NV,,", 'u6,"x,""y"", z",1,more', "u7,NV,5,,x", r'u8,"q \" , w",2', ""]
    (tmp_path / "c.csv").write_text("\n".join(["first_name,state,zip", *lines]) + "\n")
    got = files.drifted_customers(spark, str(tmp_path), RUN).collect()
    kept = {r["first_name"]: r["state"] for r in got if r[files.CORRUPT_COLUMN] is None}
    assert set(kept) == {"u1", "u2", "u3", "u4", "u8"} and kept["u2"] == "a, b" and kept["u4"] is None
    rejected = files.rejected_customers(spark, str(tmp_path), RUN)
    assert sorted(r["line"] for r in rejected.collect()) == sorted([lines[4], lines[5], lines[6]])
    assert files.clean_customers(spark, str(tmp_path), RUN).count() == 5


def test_customers_are_deduplicated_across_files(spark, landing):
    out = files.clean_customers(spark, landing, RUN)
    ids = sorted(r["customer_id"] for r in out.collect())
    assert ids == ["ann_lee_a@b.co", "bob_ray_bob@b.co", "cid_fox_cid@b.co", "dee_hay_dee@b.co", "eve_ash_eve@b.co"]
    kept = out.filter("customer_id = 'ann_lee_a@b.co'").first()
    assert kept["source_file"].endswith("ca.csv")  # first file name wins a tie


def test_file_names_are_not_patterns(spark, landing):
    from pathlib import Path
    (Path(landing) / "us [1] {a} +%20é.csv").write_text(HEADERS["us"] + "\nGil,Orr,Orr,7 St,Reno,,NV,00126,1,2,gil@b.co,w\n")
    out = files.read_drifting(spark, landing, files.CUSTOMER_HEADERS, RUN)
    assert sorted(r["first_name"] for r in out.collect()) == ["ANN", "Ann", "Bob", "Cid", "Dee", "Eve", "Gil"]


def test_missing_landing_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):
        files.clean_customers(spark, str(tmp_path / "empty"), RUN).collect()


def test_corrupt_lines_are_kept(spark, tmp_path):
    path = tmp_path / "t.csv"
    names = ",".join(schemas.TRANSACTIONS.names)
    good = "1,2,1,10.5,1/2/2020 0:00,1,1,2020,S1_1,c,p,a,,c,,1,US,NA,Lee,Ann,Small"
    path.write_text(f"{names}\n{good}\n{good.replace('10.5', 'ten')}\n")
    out = files.read_csv_keeping_corrupt(spark, str(path), schemas.TRANSACTIONS).collect()
    assert [r["TERRITORY"] for r in out] == ["NA", "NA"]
    assert out[0][files.CORRUPT_COLUMN] is None and "ten" in out[1][files.CORRUPT_COLUMN]
    assert out[1]["TOTAL_AMOUNT"] is None


def test_swapped_header_is_an_error(spark, tmp_path):
    names = list(schemas.TRANSACTIONS.names)
    names[1], names[2] = names[2], names[1]
    (tmp_path / "swapped.csv").write_text(",".join(names) + "\n" + ",".join(["1"] * len(names)) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.raw_transactions(spark, str(tmp_path / "swapped.csv")).collect()


def test_csv_without_header_or_schema(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("1,x\n2,y\n")
    assert [tuple(r) for r in files.read_csv(spark, str(path), header=False).collect()] == [(1, "x"), (2, "y")]


def test_write_counts_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_table(spark.range(100), path) == 100
    assert tables.write_table(spark.range(7), path) == 7
    assert read_table(spark, path).count() == 7


def test_partition_rerun_replaces_only_its_day(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    frame = lambda data: spark.createDataFrame(data, "v int, day string")
    tables.replace_partitions(frame([(1, "2024-01-01"), (2, "2024-01-02")]), path, ["day"])
    assert tables.replace_partitions(frame([(9, "2024-01-02")]), path, ["day"]) == 1
    assert rows(read_table(spark, path).select("v")) == [(1,), (9,)]


def test_schema_merge(spark, tmp_path, rows):
    path = str(tmp_path / "m")
    tables.write_table(spark.range(1), path)
    tables.write_table(spark.range(1, 2).withColumn("extra", F.lit("x")), path, mode="append", merge_schema=True)
    assert rows(read_table(spark, path, merge_schema=True)) == [(0, None), (1, "x")]


def test_scratch_uses_the_named_folder(spark):
    staged = scratch.stage(spark.range(10), "ten")
    root = spark.conf.get(scratch.CHECKPOINT_DIR)
    assert staged.count() == 10 and all(root in f for f in staged.inputFiles())


def test_conform_rejects_what_does_not_fit(spark):
    df = spark.createDataFrame(
        [("ok", Decimal("12.345"), 5), ("x" * 201, Decimal("1"), 5), ("big", Decimal("99999999999.00"), 5), (None, None, None)],
        "customer_name string, total_spent decimal(20,3), total_orders long")
    good, rejects = warehouse.conform(df, schemas.WAREHOUSE["customer_segments"])
    assert [(r["customer_name"], r["total_spent"], r["customer_segment"]) for r in good.collect()] == [
        ("ok", Decimal("12.35"), None), (None, None, None)]
    assert good.schema.names == schemas.WAREHOUSE["customer_segments"].names
    assert sorted(r["misfits"][0] for r in rejects.collect()) == ["customer_name", "total_spent"]


def test_jdbc_options_carry_typed_columns():
    options = warehouse.jdbc_options("jdbc:x", "customer_segments", schemas.WAREHOUSE["customer_segments"], 500, 8)
    assert options["createTableColumnTypes"].startswith("customer_name VARCHAR(200), total_spent DECIMAL(12,2), total_orders INT")
    assert (options["truncate"], options["batchsize"], options["numPartitions"]) == ("true", "500", "8")


def test_load_hands_conforming_rows_to_the_writer(spark, monkeypatch):
    seen = {}

    def save(writer, *args, **kwargs):
        seen["rows"] = writer._df.count()

    monkeypatch.setattr(DataFrameWriter, "save", save)
    df = spark.createDataFrame([("ok", Decimal(1)), ("x" * 201, Decimal(2))], "customer_name string, total_spent decimal(9,2)")
    rejects = warehouse.load_dimensions({"customer_segments": df}, "jdbc:x", schemas.WAREHOUSE, {"user": "u"})
    assert seen["rows"] == 1 and rejects["customer_segments"].count() == 1


def test_column_types_parse(spark):
    for target in schemas.WAREHOUSE.values():
        assert T.StructType.fromDDL(warehouse.column_types(target)) == target


def _landing_zone(tmp_path, landing):
    transactions = tmp_path / "transactions"
    transactions.mkdir()
    head = ",".join(schemas.TRANSACTIONS.names)
    body = [f"{100 + i},{i % 5 + 1},1,{-20 if i % 4 == 0 else 30 + i},{i % 12 + 1}/7/2020 0:00,1,1,2020,S1{i % 2}_{i},"
            f"Shop,+1,{i} St,,Reno,,1,US,NA,Lee,Ann{i % 3},Small" for i in range(24)]
    (transactions / "t.csv").write_text("\n".join([head, *body]) + "\n")
    calendar = tmp_path / "calendar"
    calendar.mkdir()
    row = lambda m: ",".join([f"2020-{m:02d}-07"] + ["" if f.dataType.typeName() != "string" else "x"
                                                     for f in schemas.CALENDAR.fields[1:]])
    (calendar / "c.csv").write_text("\n".join([",".join(schemas.CALENDAR.names), *[row(m) for m in range(1, 13)]]) + "\n")
    return str(tmp_path)


def small_suites():
    return {"customers": (quality.has_size(5), quality.unique("customer_id")),
            "transactions": (quality.has_size(24), quality.not_null("ORDERNUMBER")),
            "calendar": (quality.has_size(12), quality.unique("CALENDAR_DATE"))}


def test_full_refresh(spark, tmp_path, landing):
    zone = _landing_zone(tmp_path, landing)
    raw, processed = str(tmp_path / "raw"), str(tmp_path / "processed")
    rows = refresh.refresh(spark, zone, raw, processed, RUN, suites=small_suites())
    assert (rows["customers"], rows["transactions"], rows["calendar"]) == (5, 24, 12)
    assert (rows["dim_customer"], rows["dim_product"], rows["fact_transactions"], rows["customer_segments"]) == (5, 24, 24, 3)
    stored = read_table(spark, f"{processed}/analytics_sales_analytics")
    fact = read_table(spark, f"{processed}/fact_transactions")
    assert stored.agg(F.sum("total_orders")).first()[0] == fact.filter("transaction_type = 'SALE'").count() == 18
    assert fact.select("created_date").distinct().first()[0] == RUN
    assert fact.agg(F.min("order_date")).first()[0] == date(2020, 1, 7)
    again = refresh.refresh(spark, zone, raw, processed, RUN, suites=small_suites())
    assert again == rows  # a rerun of the day replaces itself
    file = tmp_path / "customers" / "us.csv"
    whole = file.read_text()
    file.write_text(whole + "Hal,Kay,Kay,8 St,Reno,,NV,00127,1,2,hal@b.co,w,surplus\n")
    assert refresh.ingest(spark, zone, raw, RUN)["rejected_customers"] == 1
    assert read_table(spark, f"{raw}/rejected_customers").first()["line"].startswith("Hal")
    file.write_text(whole)
    assert refresh.ingest(spark, zone, raw, RUN)["rejected_customers"] == 0
    assert spark.read.schema("line string").parquet(f"{raw}/rejected_customers").count() == 0


def test_unreadable_lines_do_not_fail_the_gate(spark, tmp_path, landing):
    zone = _landing_zone(tmp_path, landing)
    file = tmp_path / "transactions" / "t.csv"
    bad = file.read_text().splitlines()[1].replace("100,", "ten,", 1)
    file.write_text(file.read_text() + bad + "\n")
    processed = str(tmp_path / "processed")
    rows = refresh.refresh(spark, zone, str(tmp_path / "raw"), processed, RUN, suites=small_suites())
    assert (rows["transactions"], rows["fact_transactions"], rows["rejected_transactions"]) == (25, 24, 1)
    assert [r["line"] for r in read_table(spark, f"{processed}/rejected_transactions").collect()] == [bad]
    strict = QualityThresholds(rejected_share=0.01)
    with pytest.raises(quality.QualityError, match="readable"):
        refresh.refresh(spark, zone, str(tmp_path / "raw2"), processed, RUN, suites=small_suites(), thresholds=strict)


def test_gate_stops_the_refresh(spark, tmp_path, landing):
    zone = _landing_zone(tmp_path, landing)
    processed = tmp_path / "processed"
    with pytest.raises(quality.QualityError):
        refresh.refresh(spark, zone, str(tmp_path / "raw"), str(processed), RUN)
    assert not processed.exists()


def test_purge_needs_a_fresh_path(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    days = spark.createDataFrame([(1, date(2020, 1, 1)), (2, date(2020, 3, 1)), (3, None)], "n int, d date")
    tables.write_table(days, old)
    with pytest.raises(ValueError, match="purged"):
        tables.purge_table(spark, old, old + "/", "d", date(2020, 3, 2), 10)
    assert tables.purge_table(spark, old, new, "d", date(2020, 3, 2), 10) == 2
    assert {r["n"] for r in read_table(spark, new).collect()} == {2, 3}


def star_tables(spark, d, orders=40):
    """A small star whose orders have three lines each."""
    count = {"region": 1, "nation": 1, "lineitem": 3 * orders}
    columns = {
        "region": ["int(n) r_regionkey", "'R' r_name"], "nation": ["int(n) n_nationkey", "'N' n_name", "0 n_regionkey"],
        "customer": ["n c_custkey", "'Customer#' || lpad(n, 9, '0') c_name", "0 c_nationkey", "0D c_acctbal", "'M' c_mktsegment"],
        "part": ["n p_partkey", "'P' p_name", "'Brand#1' p_brand", "'T' p_type", "1 p_size", "1D p_retailprice"],
        "orders": ["n o_orderkey", "n o_custkey", "'O' o_orderstatus", "1D o_totalprice",
                   "timestamp_ntz'1996-01-01 00:00:00' + make_dt_interval(int(n % 5)) o_orderdate", "'1' o_orderpriority"],
        "lineitem": ["n div 3 l_orderkey", "n % 7 l_partkey", "n l_suppkey", "int(n % 3) l_linenumber", "2D l_quantity", "100D * (n + 1) l_extendedprice",
                     "0D l_discount", "0D l_tax", "if(n % 4 = 0, 'R', 'N') l_returnflag", "'F' l_linestatus", "timestamp_ntz'1996-01-01 00:00:00' l_shipdate"],
    }
    for name, made in columns.items():
        spark.range(count.get(name, orders)).withColumnRenamed("id", "n").selectExpr(*made).write.parquet(f"{d}/{name}.parquet")
    return str(d)


def test_rejected_lines_land_once_and_compressed(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(storage, "scratch_dir", lambda spark, label: made.append(tmp_path / f"{label}-{len(made)}") or str(made[-1]))
    got = {r["PRODUCTCODE"]: tuple(r)[1:] for r in storage.rejected_lines(spark, star_tables(spark, tmp_path / "star")).collect()}
    want = {}
    for n in range(120):
        rejected, good, amount = want.get(f"S01_{n % 7:06d}", (0, 0, 0.0))
        bad = n // 3 % 10 == 3
        want[f"S01_{n % 7:06d}"] = (rejected + bad, good + (not bad), amount + (not bad) * 100.0 * (n + 1) * (-1 if n % 4 == 0 else 1))
    assert got == want
    landed = [p.name for folder in made for p in folder.glob("part-*.csv*")]
    assert landed and all(name.endswith(".csv.gz") for name in landed)
    assert len([folder for folder in made if list(folder.glob("part-*.csv*"))]) == 1


def test_landing_in_so_many_files_shuffles_no_whole_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "scratch_dir", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda *_: pytest.fail("whole lines are shuffled"))
    d = star_tables(spark, tmp_path / "star")
    landed = storage.land_transactions(spark, d, files=9, compression="gzip")
    assert len(list((tmp_path / "landing-transactions").glob("part-*.csv.gz"))) >= 9
    assert files.read_csv(spark, landed, schemas.TRANSACTIONS).count() == 120
