"""The data-quality run as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.operators.days import on_day
from oreflow.plans.quality import QualitySettings, quality_run

SCHEMA = "order_id string, customer_id string, product_id string, order_date string, amount string, currency string, status string, quantity string"


SCHEDULE = {
    "2026-08-07": ("ORD_NEG_AMOUNT", "CUST_BAD_EMAIL"),
    "2026-08-08": ("CUST_FUTURE_SIGNUP",),
    "2026-08-09": ("ORD_ZERO_QTY", "CUST_MISSING_NAME", "ORD_DUPLICATE"),
}


def test_quality_run(spark, tmp_path):
    days = ["2026-08-07", "2026-08-08", "2026-08-09"]
    data = [(f"O{n}", f"C{n % 7}", "P1", days[n % 3], "5.00", "USD", "shipped", "1") for n in range(90)]
    orders = spark.createDataFrame(data, SCHEMA)
    people = [(f"C{n}", "Al", f"c{n}@b.org", days[n % 3], ("s", "x", "TX", "1"), ["1"]) for n in range(12)]
    customers = spark.createDataFrame(
        people, "customer_id string, name string, email string, signup_date string, address struct<street:string,city:string,state:string,zip:string>, phones array<string>"
    )
    replayed = orders.limit(2).withColumns({"order_date": F.lit(days[0]), "status": F.lit("??"), "_day": F.lit(days[0])})
    settings = QualitySettings(days[0], 3, mode="per_day", schedule=SCHEDULE, order_fault_rate=0.0, customer_fault_rate=0.0, drift_after=1)
    run = quality_run(orders, customers, settings, str(tmp_path / "run"), replayed_orders=replayed)
    got = {r.date: r for r in run.summary().collect()}
    first, third = got[days[0]], got[days[2]]
    assert (first.orders, first.bad_orders, first.customers, first.bad_customers) == (33, 3, 5, 1)
    assert (first.injections, first.drift, first.day) == ("ORD_NEG_AMOUNT, CUST_BAD_EMAIL", False, 1)
    assert (third.injections, third.drift, third.day) == ("ORD_ZERO_QTY, CUST_MISSING_NAME, ORD_DUPLICATE", True, 3)
    total = run.totals().first()
    assert (total.orders, total.customers) == (90 + 3 + 2, 12 + 3)
    assert run.events_by_source().first().asDict() == {"events": 8, "template_events": 6, "parquet_events": 2}
    assert {r.template_id: r.events for r in run.events_by_template().collect()}["ORD_DUPLICATE"] == 1
    assert sum(r.events for r in run.events_by_day().collect()) == 8
    assert {r.status for r in run.statuses().collect()} == {"shipped", "??"} | {r.status for r in run.orders.where("status not in ('shipped', '??')").collect()}
    assert run.domains().first().domain == "b.org"
    assert run.volumes().count() == 3
    second = got[days[1]]
    assert (second.customers, len(got)) == (4 + 1, 3)
    run.export(str(tmp_path / "out"))
    assert sorted(d.name for d in (tmp_path / "out/customers").glob("date=*")) == [f"date={d}" for d in days]
    assert spark.read.json(str(tmp_path / f"out/customers/date={days[1]}")).where("signup_date = '2027-08-07'").count() == 1
    heads = {d.name: next(d.glob("*.csv")).read_text().splitlines()[0] for d in (tmp_path / "out/orders").glob("date=*")}
    assert not heads[f"date={days[0]}"].endswith("promotion_code") and heads[f"date={days[1]}"].endswith("promotion_code")
    assert spark.read.json(str(tmp_path / "out/quarantine_log")).count() == 8


def test_run_without_faults_changes_nothing(spark, tmp_path):
    orders = spark.createDataFrame([("O1", "C1", "P1", "2026-08-07", "5.00", "USD", "shipped", "1")], SCHEMA)
    customers = spark.createDataFrame([("C1", "Al", "a@b", "2026-08-07")], "customer_id string, name string, email string, signup_date string")
    settings = QualitySettings("2026-08-07", 1, mode=None, order_fault_rate=0.0, customer_fault_rate=0.0)
    run = quality_run(orders, customers, settings, str(tmp_path / "run"))
    assert [tuple(r) for r in run.orders.collect()] == [tuple(r) for r in orders.collect()]
    assert run.log.count() == 0
    assert run.totals().first().bad_orders == 0


def test_on_day(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 23:59:59' t, '2024-01-01' d union all select timestamp_ntz'2024-01-02 00:00:00', '2024-01-02'")
    assert (on_day(df, "t", "2024-01-01").count(), on_day(df, "d", "2024-01-02").count(), on_day(df, "t", None).count()) == (1, 1, 2)
