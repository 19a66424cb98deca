"""Readers and writers over real files."""

from __future__ import annotations

import json
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from oreflow import fs
from oreflow.contracts import ORDERS
from oreflow.errors import IngestionError
from oreflow.functions.money import exact_mean, exact_sum
from oreflow.operators.dedup import keep_last
from oreflow.operators.validate import bad_rows, good_rows
from oreflow.sinks.export import write_json, write_orders_csv
from oreflow.sinks.partitions import replace_day, replace_days
from oreflow.sources.days import available_days, read_days, replay, replay_rows, unread_files
from oreflow.sources.landing import ORDINAL, read_customers, read_orders
from oreflow.sources.table import newer_than, next_compound_mark, past_mark, read_products, read_sqlite

HEADER = "order_id,customer_id,product_id,order_date,quantity,unit_price,status\n"


def test_orders_csv_missing_tokens_and_lineage(spark, tmp_path):
    (tmp_path / "orders_2025-01-01.csv").write_text(HEADER + 'O1,C1,"P,""1""",2025-01-01,NA,null,nan\nO2,C1,P1,2025-01-01,1,2,shipped\n')
    df = read_orders(spark, str(tmp_path), "2025-01-01", "now")
    a, b = df.orderBy("order_id").collect()
    assert (a.product_id, a.quantity, a.unit_price, a.status) == ('P,"1"', None, None, None)
    assert (b._source_file, b._ingested_at, b._partition_date, b.quantity) == ("orders_2025-01-01.csv", "now", "2025-01-01", "1")
    with pytest.raises(IngestionError):
        read_orders(spark, str(tmp_path), "2025-01-02", "now")


def test_file_order_survives_splitting(spark, tmp_path):
    """Keep-last follows the file although it is read in many splits."""
    lines = [f"O{n % 50},C,P,2025-01-01,{n + 1},1,shipped" for n in range(5000)]
    (tmp_path / "orders_2025-01-01.csv").write_text(HEADER + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_orders(spark, str(tmp_path), "2025-01-01", "now")
        assert df.rdd.getNumPartitions() > 4
        df.write.parquet(str(tmp_path / "bronze"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    last = keep_last(spark.read.parquet(str(tmp_path / "bronze")), ["order_id"], [ORDINAL])
    assert {int(r.quantity) for r in last.collect()} == set(range(4951, 5001))


def test_customers_json_forms(spark, tmp_path):
    base = {"customer_id": "7", "first_name": "A", "last_name": "B", "email": "a@b", "signup_date": "2024-01-01", "tier": None}
    records = [base | {"address": {"city": "Rome"}}, base | {"customer_id": "8", "address": None, "tier": "gold", "extra": 5}]
    (tmp_path / "customers.json").write_text(json.dumps(records, indent=2))
    got = {r.customer_id: r for r in read_customers(spark, str(tmp_path), "now").collect()}
    assert (got["7"].city, got["7"].country, got["8"].city, got["8"].extra) == ("Rome", "", "", "5")
    folder = tmp_path / "lines"
    (folder / "customers.json").mkdir(parents=True)
    for n, r in enumerate(records):
        (folder / f"customers.json/part-{n}.json").write_text(json.dumps(r) + "\n")
    assert read_customers(spark, str(folder), "now", multi_line=False).count() == 2
    schema = "customer_id string, first_name string, last_name string, email string, signup_date string, tier string, address struct<city:string,country:string>"
    assert {r.city for r in read_customers(spark, str(folder), "now", schema, multi_line=False).collect()} == {"Rome", ""}


def test_part_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "orders_2025-01-01.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "O1,C,P,2025-01-01,1,2,shipped\n")
    (folder / "b.csv").write_text(HEADER + "O2,C,P,2025-01-01,1,2,shipped\n")
    assert read_orders(spark, str(tmp_path), "2025-01-01", "now").count() == 2
    flipped = ",".join(reversed(HEADER.strip().split(",")))
    (folder / "b.csv").write_text(flipped + "\nshipped,2,1,2025-01-01,P,C,O2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_orders(spark, str(tmp_path), "2025-01-01", "now").collect()


def test_text_that_is_not_json_is_an_error(spark, tmp_path):
    (tmp_path / "customers.json").write_text('[{"customer_id": "C1", "first_name": ')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_customers(spark, str(tmp_path), "now").collect()


def test_sqlite_ranges_mark_and_stray_values(spark, tmp_path):
    path = tmp_path / "p.db"
    link = sqlite3.connect(path)
    link.execute("CREATE TABLE t (id TEXT, cost REAL, updated_at TEXT)")
    link.executemany("INSERT INTO t VALUES (?,?,?)", [(f"P{n}", n / 3, f"2025-01-{n:02d}") for n in range(1, 21)])
    link.execute("INSERT INTO t VALUES ('odd', 'free', '2025-02-01')")
    link.execute("INSERT INTO t VALUES ('none', NULL, '2025-02-02')")
    link.execute("CREATE TABLE w (id TEXT PRIMARY KEY, updated_at TEXT) WITHOUT ROWID")
    link.execute("INSERT INTO w VALUES ('a', 'x')")
    link.execute("CREATE TABLE empty (id TEXT)")
    link.commit()
    link.close()
    df = read_sqlite(spark, str(path), "t", "updated_at", "2025-01-10", partitions=4)
    assert df.rdd.getNumPartitions() == 4
    got = {r.id: r.cost for r in df.collect()}
    assert set(got) == {f"P{n}" for n in range(11, 21)} | {"odd", "none"}
    assert (float(got["P20"]), got["odd"], got["none"]) == (20 / 3, "free", None)
    assert read_sqlite(spark, str(path), "t", "updated_at", "2025-01-10", inclusive=True).count() == 13
    assert read_sqlite(spark, str(path), "t").count() == 22
    assert read_sqlite(spark, str(path), "w", partitions=3).count() == 1
    assert read_sqlite(spark, str(path), "empty").count() == 0
    with pytest.raises(IngestionError):
        read_sqlite(spark, str(tmp_path / "no.db"), "t")


def test_later_row_wins_among_equal_times(spark, tmp_path):
    link = sqlite3.connect(tmp_path / "p.db")
    columns = ("product_id", "name", "category", "unit_cost", "supplier_id", "updated_at")
    link.execute(f"CREATE TABLE products ({', '.join(f'{c} TEXT' for c in columns)})")
    link.execute("CREATE INDEX by_time ON products (updated_at)")
    rows = [(f"P{n % 3}", "n", "c", str(n), "S", "2025-01-02" if n < 90 else "2025-01-01") for n in range(100)]
    link.executemany("INSERT INTO products VALUES (?,?,?,?,?,?)", rows)
    link.commit()
    link.close()
    df = read_products(spark, str(tmp_path / "p.db"), None, "now", partitions=5)
    last = keep_last(df, ["product_id"], ["updated_at", ORDINAL])
    assert sorted(int(r.unit_cost) for r in last.collect()) == [87, 88, 89]


def test_mark_is_strict_unless_inclusive(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "u string")
    assert (newer_than(df, "u", "b").count(), newer_than(df, "u", "b", inclusive=True).count()) == (1, 2)


def test_compound_mark_reads_ties_once(spark):
    rows = [("d1", 1), ("d1", 2), ("d2", 1), ("d2", 2), ("d2", 3), (None, 4)]
    df, seen, mark = spark.createDataFrame(rows, "u string, k int"), [], None
    for upto in (("d1", 2), ("d2", 2), ("d2", 3), ("d9", 9)):
        there = df.where(F.col("u").isNull() | (F.struct("u", "k") <= F.struct(F.lit(upto[0]).alias("u"), F.lit(upto[1]).alias("k"))))
        new = past_mark(there, "u", "k", mark)
        seen += [tuple(r) for r in new.collect()]
        found = next_compound_mark(new, "u", "k").first()["mark"]
        mark = tuple(found) if found else mark
    assert sorted(seen) == rows[:5] and mark == ("d2", 3)


def test_replace_day_and_days(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_day(spark.range(5), path, "2025-01-01") == 5
    assert replace_day(spark.range(3), path, "2025-01-02") == 3
    assert replace_day(spark.range(2), path, "2025-01-01") == 2
    assert spark.read.parquet(path).count() == 5
    assert replace_day(spark.range(0), path, "2025-01-01") == 0
    assert {str(r.date) for r in spark.read.parquet(path).collect()} == {"2025-01-02"}
    assert replace_day(spark.range(0), path, "2025-01-03", keep_empty=False) == 0
    assert available_days(spark, path, "date={date}") == ["2025-01-01", "2025-01-02"]
    replace_days(spark.range(10).withColumn("date", F.when(F.col("id") < 4, "2025-01-02").otherwise("2025-01-04")), path)
    counts = {str(r.date): r["count"] for r in spark.read.parquet(path).groupBy("date").count().collect()}
    assert counts == {"2025-01-02": 4, "2025-01-04": 6}


def test_replace_day_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_day(spark.range(3).withColumn("date", F.lit("x")), path, "2025-01-01")
    with pytest.raises(Exception, match="no such row"):
        replace_day(spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no such row"))).alias("id")), path, "2025-01-01")
    assert sorted(map(tuple, spark.read.schema("id long, date string").parquet(path).collect())) == [(n, "2025-01-01") for n in range(3)]
    assert fs.folders(spark, path) == ["date=2025-01-01"]


def test_replace_day_writes_no_partition_column(spark, tmp_path, monkeypatch):
    """Rows go to the writer as they come: no metrics and no column of the day between."""
    seen, write = [], DataFrame.write.fget
    monkeypatch.setattr(DataFrame, "write", property(lambda df: seen.append(df) or write(df)))
    replace_day(spark.range(3), str(tmp_path / "t"), "2025-01-01")
    assert [df.columns for df in seen] == [["id"]]
    assert "CollectMetrics" not in seen[0]._jdf.queryExecution().toString()


def test_orders_csv_written_where_the_rows_are(spark, tmp_path):
    rows = spark.range(0, 30, 1, 3).select(F.concat(F.lit("O"), "id").alias("order_id"), F.lit("2025-01-01").alias("day"))
    write_orders_csv(rows, str(tmp_path / "o"), day="day", keep_day=False, gather=False)
    assert len(list((tmp_path / "o" / "date=2025-01-01").glob("part-*.csv"))) == 3
    assert spark.read.csv(str(tmp_path / "o"), header=True).select("order_id").distinct().count() == 30


@pytest.fixture()
def quarantine(spark, tmp_path):
    base = tmp_path / "q"
    for day, parts in {"2026-08-07": [range(0, 3), range(3, 10)], "2026-08-08": [range(10, 12)], "2026-08-20": [range(20, 22)]}.items():
        for n, ids in enumerate(parts):
            rows = spark.createDataFrame([(f"O{i}", float(i)) for i in ids], "id string, amount double")
            rows = rows.withColumn("note", F.lit("n")) if n else rows
            rows.coalesce(1).write.parquet(str(tmp_path / f"w-{day}-{n}"))
            made = next((tmp_path / f"w-{day}-{n}").glob("part-*.parquet"))
            (base / f"dt={day}").mkdir(parents=True, exist_ok=True)
            (base / f"dt={day}/part-{n:04d}.parquet").write_bytes(made.read_bytes())
    (base / "dt=2026-08-07/part-0002.parquet").write_text("not parquet at all")
    (base / "dt=2026-02-30").mkdir()
    (base / "other").mkdir()
    return str(base)


def test_read_days(spark, quarantine):
    assert available_days(spark, quarantine) == ["2026-08-07", "2026-08-08", "2026-08-20"]
    both = ["2026-08-07", "2026-08-08"]
    with pytest.raises(Exception, match="CANNOT_READ_FILE_FOOTER|not a Parquet file"):
        read_days(spark, quarantine, both).count()
    assert read_days(spark, quarantine, both, skip_unreadable=True).count() == 12
    assert [r.path.split("/")[-1] for r in unread_files(spark, quarantine, both).collect()] == ["part-0002.parquet"]
    first = read_days(spark, quarantine, both, max_rows=5, skip_unreadable=True)
    assert sorted(r.id for r in first.where("_day = '2026-08-07'").collect()) == ["O0", "O1", "O2", "O3", "O4"]
    assert first.where("_day = '2026-08-08'").count() == 2
    assert read_days(spark, quarantine, []) is None
    assert available_days(spark, quarantine + "/absent") == []


def test_replay(spark, quarantine):
    run = ["2026-08-07", "2026-08-08"]
    shape = ["order_id", "order_date", "amount", "currency"]
    every = replay_rows(spark, quarantine, run, shape, names={"id": "order_id"}, skip_unreadable=True)
    assert every.count() == 12
    rows = replay_rows(spark, quarantine, run, shape, names={"id": "order_id"}, max_rows=4, skip_unreadable=True)
    got = sorted(tuple(r) for r in rows.select(*shape).collect())
    assert got[0] == ("O0", "2026-08-07", "0.0", "") and len(got) == 6
    assert {r.order_date for r in rows.collect()} == set(run)
    day = spark.createDataFrame([("A", "2026-08-07", "1", "USD", "SAVE10")], ", ".join(f"{c} string" for c in [*shape, "promotion_code"]))
    both = replay(day, rows, None)
    assert both.count() == 7 and both.columns == [*shape, "promotion_code"]
    assert replay_rows(spark, quarantine, ["2030-01-01"], shape) is None


def test_nested_files_have_their_day(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "q/dt=2026-08-07/run=1/deep"))
    spark.range(2).write.parquet(str(tmp_path / "q/dt=2026-08-08"))
    got = read_days(spark, str(tmp_path / "q"), ["2026-08-07", "2026-08-08"]).groupBy("_day").count().collect()
    assert {tuple(r) for r in got} == {("2026-08-07", 3), ("2026-08-08", 2)}


def test_exports_leave_other_days_alone(spark, tmp_path):
    schema = "order_id string, order_date string, promotion_code string"
    first = spark.createDataFrame([("O1", "2025-01-01", None), ("O2", "2025-01-02", "X")], schema)
    second = spark.createDataFrame([("O3", "2025-01-02", None), ("O4", "2025-01-03", "Y")], schema)
    for rows in (first, second):
        write_orders_csv(rows, str(tmp_path / "csv"))
        write_json(rows, str(tmp_path / "json"), by="order_date")
    csv = {d.name: "".join(f.read_text() for f in d.glob("*.csv")) for d in (tmp_path / "csv").glob("date=*")}
    assert csv == {
        "date=2025-01-01": "order_id,order_date\nO1,2025-01-01\n",
        "date=2025-01-02": "order_id,order_date\nO3,2025-01-02\n",
        "date=2025-01-03": "order_id,order_date,promotion_code\nO4,2025-01-03,Y\n",
    }
    assert {r.order_id for r in spark.read.json(str(tmp_path / "json")).collect()} == {"O1", "O3", "O4"}



def test_rows_that_do_not_fit_the_header_are_refused(spark, tmp_path):
    good = "O1,C,P,2025-01-01,1,2.0,shipped\n"
    (tmp_path / "orders_2025-01-01.csv").write_text(HEADER + good + "O2,C,P,2025-01-01,1,2.0,shipped,extra\nO3,C,P\n")
    rows = read_orders(spark, str(tmp_path), "2025-01-01", "now")
    bad = {r.order_id: r for r in bad_rows(rows, ORDERS).collect()}
    assert set(bad) == {"O2", "O3"} and bad["O2"]._malformed.endswith("extra")
    assert bad["O2"]._quarantine_reasons == ["row: more or fewer fields than the header"]
    assert [r.order_id for r in good_rows(rows, ORDERS).collect()] == ["O1"]


def test_quoted_line_ends(spark, tmp_path):
    (tmp_path / "orders_2025-01-01.csv").write_text(HEADER + 'O1,"C\nD",P,2025-01-01,1,2.0,shipped\nO2,C,P,2025-01-01,1,2.0,shipped\n')
    rows = read_orders(spark, str(tmp_path), "2025-01-01", "now")
    assert {(r.order_id, r.customer_id) for r in good_rows(rows, ORDERS).collect()} == {("O1", "C\nD"), ("O2", "C")}
    split = read_orders(spark, str(tmp_path), "2025-01-01", "now", multi_line=False)
    assert good_rows(split, ORDERS).count() == 1 and bad_rows(split, ORDERS).count() == 2


def test_means_of_odd_amounts(spark):
    def figures(values):
        row = spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first()
        return tuple(row)

    assert figures([10.0, 20.0, float("nan"), float("inf"), None]) == (30.0, 15.0)
    assert figures([1e17, 2.0]) == (1e17 + 2, 5e16 + 1)
    assert figures([0.004, 0.004])[0] == 0.008 and figures([1e300, 1.0])[0] == 1e300
    assert figures([float("nan"), None]) == (None, None)


def test_csv_header_widens_by_day(spark, tmp_path):
    data = [("O1", "2025-01-01", "1", None), ("O2", "2025-01-02", "2", "SAVE10"), ("O3", "2025-01-02", "", None)]
    df = spark.createDataFrame(data, "order_id string, order_date string, quantity string, promotion_code string").coalesce(1)
    write_orders_csv(df, str(tmp_path / "csv"))
    heads = {d.name: {f.read_text().splitlines()[0] for f in d.glob("*.csv")} for d in (tmp_path / "csv").glob("date=*")}
    assert heads == {"date=2025-01-01": {"order_id,order_date,quantity"}, "date=2025-01-02": {"order_id,order_date,quantity,promotion_code"}}
    text = "".join(f.read_text() for f in (tmp_path / "csv/date=2025-01-02").glob("*.csv"))
    assert "O2,2025-01-02,2,SAVE10" in text and "O3,2025-01-02,," in text


def test_exported_csv_is_a_landing_area(spark, tmp_path):
    data = [("O1", "C", "P", "2025-01-01", "1", "2.0", "shipped"), ("O2", "C", "P", "2025-01-02", "1", "2.0", "shipped")]
    schema = ", ".join(f"{c} string" for c in HEADER.strip().split(","))
    write_orders_csv(spark.createDataFrame(data, schema), str(tmp_path / "landing"))
    assert [r.order_id for r in read_orders(spark, str(tmp_path / "landing"), "2025-01-02", "now").collect()] == ["O2"]


def test_json_out(spark, tmp_path):
    df = spark.createDataFrame([("C1", "d1", ("x",))], "id string, day string, address struct<city:string>")
    write_json(df, str(tmp_path / "j"), by="day")
    write_json(df, str(tmp_path / "k"))
    assert spark.read.json(str(tmp_path / "j")).first().address.city == "x"
    assert spark.read.json(str(tmp_path / "k")).first().id == "C1"


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "s/x.json")
    assert fs.read_text(spark, path) is None
    fs.write_text(spark, path, "ä")
    fs.write_text(spark, path, "b")
    assert fs.read_text(spark, path) == "b"
    assert [p.name for p in (tmp_path / "s").iterdir() if not p.name.startswith(".")] == ["x.json"]
