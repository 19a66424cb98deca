"""Operators against small cases and against plain-Python brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from oreflow.contracts import EXPORT_CUSTOMERS
from oreflow.errors import SchemaError
from oreflow.functions.hashing import chosen, draw, row_hash
from oreflow.functions.text import email_domain, folder_date
from oreflow.operators import days, reports
from oreflow.operators.dedup import first_per_group, keep_last
from oreflow.operators.drift import require_columns, widen
from oreflow.operators.gold import fact_orders, scd2_merge, scd2_open
from oreflow.operators.shape import conform, flatten, nested_to_json
from oreflow.operators.upsert import insert_if_absent, upsert
from oreflow.operators.validate import exported_customer_is_bad, exported_order_class, exported_order_is_bad


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_drift(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    assert require_columns(df, ["a"], "t") == ["z"]
    with pytest.raises(SchemaError, match=r"\['b', 'c'\]"):
        require_columns(df, ["a", "c", "b"], "t")


def test_widen_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "p")], "a int, promo string")
    assert sorted(map(str, widen(a, b).collect())) == ["Row(a=1, promo=None)", "Row(a=2, promo='p')"]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_keep_last_with_hot_key_matches_brute_force(spark, partitions):
    """A third of the rows has one key; the result does not depend on the partitions."""
    source = random.Random(7)
    data = [(0 if n % 3 == 0 else source.randrange(1, 40), source.randrange(10**6), n) for n in range(3000)]
    want = {}
    for key, order, value in data:
        if key not in want or (order, value) > want[key]:
            want[key] = (order, value)
    df = spark.createDataFrame(data, "k int, o int, v int").repartition(partitions)
    got = {r.k: (r.o, r.v) for r in keep_last(df, ["k"], ["o", "v"]).collect()}
    assert got == want


def test_keep_last_limits_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    plan = keep_last(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_first_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9)], "d string, n int")
    assert rows(first_per_group(df, ["d"], [F.asc("n")], 2, rank="r"), "d", "n", "r") == [("a", 1, 1), ("a", 2, 2), ("b", 9, 1)]


def test_upsert_and_insert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B", True), (3, "c", True)], "k int, v string, extra boolean")
    for stored in (True, False):
        merged = upsert(target, new, ["k"], stored)
        assert merged.columns == ["k", "v", "extra"]
        assert rows(merged, "k", "v", "extra") == [(1, "a", None), (2, "B", True), (3, "c", True)]
    assert rows(insert_if_absent(target, new, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_row_hash(spark):
    df = spark.createDataFrame([("x", None, 3)], "b string, a string, c int")
    got = df.select(row_hash(["c", "b", "a", "gone"], df.columns)).first()[0]
    assert got == hashlib.md5(b"None|x|3|").hexdigest()
    swapped = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert swapped.select(row_hash(["x", "y", "z"], swapped.columns).alias("h")).distinct().count() == 2


def test_scd2_invariants_against_brute_force(spark):
    """Random snapshots: one open row per key, closed rows never change, intervals join up."""
    source = random.Random(3)
    state, dim = {}, None
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"):
        snapshot = {k: source.choice("xyz") for k in range(30) if source.random() < 0.8}
        for k, city in snapshot.items():
            versions = state.setdefault(k, [])
            if versions and versions[-1][0] == city:
                continue
            if versions:
                versions[-1][2] = day
            versions.append([city, day, "9999-12-31"])
        df = spark.createDataFrame(list(snapshot.items()), "k int, city string")
        if dim is None:
            dim = scd2_open(df, ["city"], day)
        else:
            merged = scd2_merge(dim.where("_current"), df, ["k"], ["city"], day)
            dim = merged.unionByName(dim.where("not _current"))
        dim = spark.createDataFrame(dim.collect(), dim.schema).coalesce(2)
    want = sorted((k, *v) for k, versions in state.items() for v in versions)
    assert rows(dim, "k", "city", "_eff_start", "_eff_end") == want
    assert dim.where("_current").groupBy("k").count().where("count > 1").count() == 0
    assert dim.where("_current <> (_eff_end = '9999-12-31')").count() == 0


def test_scd2_takes_new_columns(spark):
    current = scd2_open(spark.createDataFrame([(1, "x")], "k int, city string"), ["city"], "2024-01-01")
    wider = spark.createDataFrame([(1, "y", "new")], "k int, city string, extra string")
    merged = scd2_merge(current, wider, ["k"], ["city"], "2024-01-02")
    assert rows(merged, "city", "extra") == [("x", None), ("y", "new")]


def test_fact_total_is_null_without_price(spark):
    df = spark.createDataFrame([("2025-01-01", 2, None, "x"), ("2025-01-01", 2, 1.5, "x")], "order_date string, quantity long, unit_price double, _f string")
    got = fact_orders(df).orderBy(F.asc_nulls_first("total_amount")).collect()
    assert [r.total_amount for r in got] == [None, 3.0] and "_f" not in got[0].asDict()


def test_flatten_struct_text_and_absent(spark):
    struct = spark.createDataFrame([(("Rome", None),), (None,)], "address struct<city:string,country:string>").coalesce(1)
    assert rows(flatten(struct, "address", ("city", "country")), "city", "country") == [("", ""), ("Rome", "")]
    text = spark.createDataFrame([('{"city": "Oslo"}',), ("nowhere",)], "address string").coalesce(1)
    assert rows(flatten(text, "address", ("city", "country")), "city", "country") == [("", ""), ("Oslo", "")]
    assert rows(flatten(spark.createDataFrame([(1,)], "a int"), "address", ("city",)), "a", "city") == [(1, "")]


def test_conform(spark):
    df = spark.createDataFrame([(1, float("nan"), None, '{"city": "x"}', "[broken")], "b int, a double, c string, address string, phones string")
    shaped = conform(df, ["a", "b", "c", "gone", "address", "phones"], EXPORT_CUSTOMERS.nested)
    row = shaped.first()
    assert shaped.columns == ["a", "b", "c", "gone", "address", "phones"]
    assert (row.a, row.b, row.c, row.gone, row.address.city) == ("", "1", "", "", "x")


def test_nested_to_json(spark):
    df = spark.createDataFrame([(1, ("x",), ["a"])], "n int, s struct<c:string>, l array<string>")
    assert tuple(nested_to_json(df).first()) == (1, '{"c":"x"}', '["a"]')


def test_export_rules(spark):
    data = [
        ("1.5", "shipped", "1", False, "ok"),
        ("-1.5", "lost", "0", True, "negative_amount"),
        ("x", "shipped", "1", True, "ok"),
        (None, "shipped", "1", True, "ok"),
        ("1", "Shipped", "0", True, "unknown_status"),
        ("1", None, "1", True, "unknown_status"),
        ("1", "pending", "0", True, "zero_quantity"),
        ("1", "pending", "-3", False, "ok"),
        ("1", "returned", "1", True, "unknown_status"),
    ]
    df = spark.createDataFrame(data, "amount string, status string, quantity string, bad boolean, kind string")
    wrong = df.where((exported_order_is_bad() != F.col("bad")) | (exported_order_class() != F.col("kind")))
    assert wrong.collect() == []
    people = [("A", "a@b", False), (None, "a@b", True), ("A", "ab", True), ("A", "@b", True), ("A", "a@", True), ("A", None, True), ("", "a@b", False)]
    df = spark.createDataFrame(people, "name string, email string, bad boolean")
    assert df.where(exported_customer_is_bad() != F.col("bad")).collect() == []


def test_text_helpers(spark):
    df = spark.createDataFrame([("a@b@c.org", "dt=2024-02-29"), ("none", "dt=2023-02-29"), (None, "xdt=2024-01-01")], "e string, f string").coalesce(1)
    got = df.select(email_domain(F.col("e")), folder_date(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [("c.org", "2024-02-29"), ("invalid", None), (None, None)]
    assert df.select(folder_date(F.lit("day_2024-01-05.x"), "day_{date}.x")).first()[0] == "2024-01-05"


def test_selection_does_not_depend_on_partitions(spark):
    few, many = spark.range(0, 5000, 1, 1), spark.range(0, 5000, 1, 13)
    hit = chosen([F.col("id")], 5, 0.1)
    assert rows(few.where(hit), "id") == rows(many.where(hit), "id")
    assert 400 < few.where(hit).count() < 600
    assert few.select(draw([F.col("id")], 5, 0) == draw([F.col("id")], 5, 1)).distinct().count() == 1


def test_select_days(caplog):
    have = ["2024-01-02", "2024-01-01"]
    assert days.select_days(have, "all") == sorted(have)
    assert days.select_days(have, "match", ["2024-01-02", "2024-01-09"]) == ["2024-01-02"]
    assert days.select_days(have, ["2024-01-01", "2024-05-05"]) == ["2024-01-01"]
    assert "2024-05-05" in caplog.text
    with pytest.raises(ValueError):
        days.select_days(have, "some")


def test_backfill_days():
    assert days.backfill_days("2024-03-01", 2) == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_daily_summary_fills_the_missing_side(spark):
    a = reports.daily_counts(spark.createDataFrame([("d1", True), ("d1", False), ("d1", False)], "day string, bad boolean"), "day", F.col("bad"), "orders")
    b = reports.daily_counts(spark.createDataFrame([("d2", False)], "day string, bad boolean"), "day", F.col("bad"), "customers")
    plan = spark.createDataFrame([("d1", 2, "B"), ("d1", 1, "C")], "date string, seq int, template_id string")
    drift = spark.createDataFrame([("d1", True)], "date string, drift boolean")
    got = {r.date: r for r in reports.daily_summary(a, b, ("orders", "customers"), plan, drift).collect()}
    assert (got["d1"].drift, got["d2"].drift) == (True, False)
    assert (got["d1"].orders, got["d1"].bad_orders, got["d1"].orders_quality_pct, got["d1"].customers) == (3, 1, 66.7, 0)
    assert (got["d1"].injections, got["d2"].injections, got["d2"].orders_quality_pct) == ("C, B", "", 100.0)
    total = reports.totals(reports.daily_summary(a, b, ("orders", "customers")), ("orders", "customers")).first()
    assert (total.orders, total.bad_orders_pct, total.customers, total.bad_customers_pct) == (3, 33.3, 1, 0.0)


def test_price_changes(spark):
    catalogue = spark.createDataFrame([(1, "a", 49.99), (2, "b", 10.0), (3, "c", 1.0)], "id int, name string, price double")
    updates = spark.createDataFrame([(1, 44.99), (2, 10.0), (3, 3.5)], "id int, new_price double")
    got = reports.price_changes(catalogue, updates, "id", ["name"])
    assert rows(got, "id", "change") == [(1, "down -5.00"), (2, "down 0.00"), (3, "up +2.50")]


def test_domains(spark):
    df = spark.createDataFrame([("a@x.org",), ("b@x.org",), ("none",), (None,)], "email string")
    assert [tuple(r) for r in reports.domain_counts(df).collect()] == [("x.org", 2), ("invalid", 1)]


def test_a_version_never_ends_before_it_starts(spark):
    first = scd2_open(spark.createDataFrame([("C1", "Oslo")], "customer_id string, city string"), ["city"], "2024-03-01")
    moved = spark.createDataFrame([("C1", "Rome")], "customer_id string, city string")
    rows = scd2_merge(first, moved, ["customer_id"], ["city"], "2024-02-01").orderBy("_current").collect()
    assert [(r.city, r._eff_start, r._eff_end) for r in rows][0] == ("Oslo", "2024-03-01", "2024-03-01")
