"""Fault plans, injection and the log."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from oreflow.operators import days, faults, reports
from oreflow.operators.validate import exported_customer_is_bad, exported_order_is_bad

ORDER_SCHEMA = "order_id string, customer_id string, product_id string, order_date string, amount string, currency string, status string, quantity string"
CUSTOMER_SCHEMA = "customer_id string, name string, email string, signup_date string, address struct<city:string>, phones array<string>"


SCHEDULE = {
    "2026-08-07": ("ORD_NEG_AMOUNT", "CUST_BAD_EMAIL"),
    "2026-08-08": ("ORD_BAD_STATUS",),
    "2026-08-09": ("ORD_ZERO_QTY", "CUST_MISSING_NAME", "ORD_DUPLICATE"),
    "2026-08-10": ("CUST_FUTURE_SIGNUP",),
}


@pytest.fixture(scope="module")
def orders(spark):
    data = [(f"O{n}", "C1", "P1", f"2024-01-0{1 + n % 2}", "5.00", "USD", "shipped", "1") for n in range(40)]
    return spark.createDataFrame(data, ORDER_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([(f"C{n}", "Al", "a@b.c", "2024-01-01", ("x",), ["1"]) for n in range(6)], CUSTOMER_SCHEMA)


def test_plans(spark):
    four = days.day_range(spark, "2026-08-07", 4)
    fixed = faults.fault_plan(four, "fixed").orderBy("date", "seq").collect()
    assert [(r.date, r.seq, r.template_id) for r in fixed] == [
        ("2026-08-07", 1, "ORD_NEG_AMOUNT"),
        ("2026-08-07", 2, "CUST_MISSING_NAME"),
        ("2026-08-08", 1, "ORD_ZERO_QTY"),
        ("2026-08-09", 1, "ORD_BAD_STATUS"),
        ("2026-08-10", 1, "CUST_BAD_EMAIL"),
    ]
    scheduled = faults.fault_plan(four, "per_day", schedule=SCHEDULE).orderBy("date", "seq").collect()
    assert [r.template_id for r in scheduled] == [t for d in SCHEDULE.values() for t in d]
    assert {r.type for r in scheduled if r.template_id.startswith("CUST")} == {"customer"}
    drawn = faults.fault_plan(four, "random", 1, 3).groupBy("date").count().collect()
    assert len(drawn) == 4 and all(1 <= r["count"] <= 3 for r in drawn)
    own = faults.fault_plan(four, "fixed", templates=["ORD_ZERO_QTY"]).collect()
    assert [(r.date, r.template_id) for r in own] == [("2026-08-07", "ORD_ZERO_QTY")]
    for mode in ("sometimes", "per_day"):
        with pytest.raises(ValueError):
            faults.fault_plan(four, mode)


def plan_of(spark, template_ids, day="2024-01-01"):
    kinds = [(day, n + 1, t, faults.TEMPLATES[t].kind) for n, t in enumerate(template_ids)]
    return spark.createDataFrame(kinds, "date string, seq int, template_id string, type string")


def test_inject_orders(spark, orders):
    ids = [t for t in faults.TEMPLATES if t.startswith("ORD")]
    all_rows, log = faults.inject(orders, plan_of(spark, ids), "order", "order_id", "order_date")
    assert all_rows.count() == 47
    added = all_rows.exceptAll(orders)
    assert added.count() == 6 + 1
    entries = {r.template_id: r for r in log.withColumn("p", F.from_json("payload", ORDER_SCHEMA)).select("*", "p.*").collect()}
    assert set(entries) == set(ids)
    assert entries["ORD_NEG_AMOUNT"].amount == "-5.00"
    assert entries["ORD_ZERO_QTY"].quantity == "0"
    assert entries["ORD_BAD_STATUS"].status in faults.UNKNOWN_STATES
    assert (entries["ORD_EMPTY_ID"].order_id, entries["ORD_NO_CURRENCY"].currency, entries["ORD_NULL_PRODUCT"].product_id) == ("", "", "")
    twin = entries["ORD_DUPLICATE"].order_id
    assert all_rows.where(F.col("order_id") == twin).count() == 2
    assert all(r.order_date == "2024-01-01" and r.source == "template" and r.type == "order" for r in entries.values())
    assert entries["ORD_ZERO_QTY"].description == "Zero quantity"
    # The counter of bad rows does not see every kind of fault.
    assert all_rows.where(exported_order_is_bad()).count() == 3


def test_inject_reuses_rows_of_a_short_day(spark, orders):
    two = orders.where("order_id in ('O0', 'O2')")
    all_rows, log = faults.inject(two, plan_of(spark, ["ORD_ZERO_QTY"] * 5), "order", "order_id", "order_date")
    assert (all_rows.count(), log.count()) == (7, 5)
    assert all_rows.select("order_id").distinct().count() == 7


def test_inject_keeps_entries_of_a_day_without_rows(spark, orders):
    plan = plan_of(spark, ["ORD_ZERO_QTY"] * 3, "2024-01-09").unionByName(plan_of(spark, ["ORD_NEG_AMOUNT"]))
    two = orders.where("order_id in ('O0', 'O2')")
    all_rows, log = faults.inject(two, plan, "order", "order_id", "order_date")
    assert (all_rows.count(), log.count()) == (6, 4)
    assert all_rows.where("order_date = '2024-01-09' AND quantity = '0'").count() == 3
    none, unmet = faults.inject(two.limit(0), plan, "order", "order_id", "order_date")
    assert none.count() == 0
    assert [(r.template_id, r.payload) for r in unmet.orderBy("template_id").collect()] == [("ORD_NEG_AMOUNT", None)] + [("ORD_ZERO_QTY", None)] * 3


def test_amounts_that_cannot_be_negated_stay(spark):
    amounts = ["5.00", "-3", "+4.5", "NaN", "n/a", "1e20", None, "inf"]
    orders = spark.createDataFrame([(str(k), a, "shipped", "1") for k, a in enumerate(amounts)], "order_id string, amount string, status string, quantity string")
    got = orders.withColumn("amount", faults._negative_amount()).orderBy("order_id").collect()
    assert [r.amount for r in got] == ["-5.00", "-3", "-4.5", "NaN", "n/a", "-1e20", None, "inf"]


def test_inject_customers(spark, customers):
    ids = [t for t in faults.TEMPLATES if t.startswith("CUST")]
    all_rows, log = faults.inject(customers, plan_of(spark, ids), "customer", "customer_id", "signup_date", settings={"start_date": "2024-01-01"})
    assert all_rows.count() == 11
    payload = F.from_json("payload", CUSTOMER_SCHEMA)
    entries = {r.template_id: r.p for r in log.select("template_id", payload.alias("p")).collect()}
    assert entries["CUST_BAD_EMAIL"].email in faults.INVALID_EMAILS
    assert entries["CUST_MISSING_NAME"].name is None
    assert entries["CUST_EMPTY_ADDR"].address is None
    assert entries["CUST_FUTURE_SIGNUP"].signup_date == "2024-12-31"
    assert all_rows.where(exported_customer_is_bad()).count() == 2


def test_organic_corruption(spark):
    orders = spark.range(4000).selectExpr("cast(id as string) order_id", "'5.00' amount", "'shipped' status", "'1' quantity")
    bad = faults.corrupt_orders(orders, ["order_id"], 0.05).where(exported_order_is_bad())
    kinds = bad.selectExpr("case when amount = '-5.00' then 'a' when status <> 'shipped' then 's' else 'q' end k").groupBy("k").count().collect()
    assert {r.k for r in kinds} == {"a", "s", "q"} and 140 < sum(r["count"] for r in kinds) < 260
    customers = spark.range(4000).selectExpr("cast(id as string) customer_id", "'A' name", "'a@b' email")
    assert 140 < faults.corrupt_customers(customers, ["customer_id"], 0.05).where(exported_customer_is_bad()).count() < 260
    assert faults.corrupt_customers(customers, ["customer_id"], 0.0).where(exported_customer_is_bad()).count() == 0


def test_log_reports(spark, orders):
    plan = plan_of(spark, ["ORD_ZERO_QTY", "ORD_ZERO_QTY", "ORD_BAD_STATUS"])
    log = faults.inject(orders, plan, "order", "order_id", "order_date")[1]
    log = log.unionByName(faults.replay_log(orders.limit(2), "order", "order_date"))
    assert [tuple(r) for r in reports.events_by_template(log).collect()] == [("ORD_ZERO_QTY", 2), ("ORD_BAD_STATUS", 1)]
    assert reports.events_by_source(log).first().asDict() == {"events": 5, "template_events": 3, "parquet_events": 2}
    assert sum(r.events for r in reports.events_by_day(log).collect()) == 5
    listed = reports.logged_templates(log).first()
    assert (listed.injections, listed.events) == ("ORD_BAD_STATUS, ORD_ZERO_QTY", 3)
