"""Fault injection, its plan and its log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from oreflow.operators import reports
from oreflow.operators.days import day_range, days_covered
from oreflow.operators.faults import (
    FIXED_TEMPLATES,
    INVALID_EMAILS,
    ORGANIC_STATES,
    PROMOTION_CODES,
    UNKNOWN_STATES,
    corrupt_customers,
    corrupt_orders,
    fault_plan,
    inject,
    widen_from,
)
from oreflow.plans.quality import QualitySettings, quality_run
from oreflow.plans.star.registry import (
    EXPORTED_ORDERS_SQL,
    draw_sql,
    exported_customers,
    exported_orders,
    pick_sql,
    query,
    table,
)
from oreflow.plans.star.reports import PLAN_SQL, random_plan
from oreflow.session import shared_folder

RATE = 0.05
_HIT = f"{draw_sql('k')} < {round(RATE * 2**32)}"


@query(
    f"""SELECT order_id, customer_id, product_id, order_date, currency,
               CASE WHEN {_HIT} AND {draw_sql('k', 1)} % 3 = 0 THEN '-' || amount ELSE amount END AS amount,
               CASE WHEN {_HIT} AND {draw_sql('k', 1)} % 3 = 1 THEN {pick_sql(ORGANIC_STATES, draw_sql('k', 2))} ELSE status END AS status,
               CASE WHEN {_HIT} AND {draw_sql('k', 1)} % 3 = 2 THEN '0' ELSE quantity END AS quantity
        FROM (SELECT *, order_id AS k FROM ({EXPORTED_ORDERS_SQL}))"""
)
def fault_orders(spark, sf_dir):
    return corrupt_orders(exported_orders(spark, sf_dir), ["order_id"], RATE)


@query(
    f"""SELECT k AS customer_id,
               CASE WHEN {_HIT} AND {draw_sql('k', 1)} % 2 = 1 THEN NULL ELSE c_name END AS name,
               CASE WHEN {_HIT} AND {draw_sql('k', 1)} % 2 = 0 THEN {pick_sql(INVALID_EMAILS, draw_sql('k', 2))}
                    ELSE k || '@' || lower(c_mktsegment) || '.example' END AS email
        FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS k FROM customer)"""
)
def fault_customers(spark, sf_dir):
    rows = corrupt_customers(exported_customers(spark, sf_dir), ["customer_id"], RATE)
    return rows.select("customer_id", "name", "email")


@query(
    f"""SELECT order_id, order_date, CASE WHEN order_date >= '1995-01-11' THEN {pick_sql(PROMOTION_CODES, draw_sql('order_id'))} END AS promotion_code
        FROM ({EXPORTED_ORDERS_SQL})"""
)
def promotion_drift(spark, sf_dir):
    """The optional column from the eleventh day on."""
    orders = exported_orders(spark, sf_dir).select("order_id", "order_date")
    return widen_from(orders, ["order_id"], "order_date", "1995-01-01", 10)


_NUMBER = draw_sql("date || '|' || seq", 2)


# A day without orders borrows the first orders of all.
_ADDED_SQL = f"""
WITH plan AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY seq) AS nth FROM ({PLAN_SQL}) WHERE template_id LIKE 'ORD%'),
base AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_date ORDER BY {draw_sql('order_id', 3)}, order_id) AS nth,
                          least(2, count(*) OVER (PARTITION BY order_date)) AS size FROM ({EXPORTED_ORDERS_SQL}))
    WHERE nth <= 2),
spare AS (
    SELECT * EXCLUDE (order_date) FROM (SELECT *, row_number() OVER (ORDER BY {draw_sql('order_id', 3)}, order_id) AS nth FROM ({EXPORTED_ORDERS_SQL}))
    WHERE nth <= (SELECT max(nth) FROM plan)),
given AS (
    SELECT * EXCLUDE (nth, size) FROM (SELECT base.*, template_id, seq, date FROM plan JOIN base ON date = order_date AND base.nth = (plan.nth - 1) % size + 1)
    UNION ALL BY NAME
    SELECT * EXCLUDE (nth) FROM (SELECT spare.*, template_id, seq, date, date AS order_date FROM plan JOIN spare USING (nth)
                                 WHERE date NOT IN (SELECT order_date FROM base)))
SELECT template_id,
       CASE template_id WHEN 'ORD_EMPTY_ID' THEN '' WHEN 'ORD_DUPLICATE' THEN order_id ELSE order_id || '-' || seq END AS order_id,
       CASE template_id WHEN 'ORD_NULL_PRODUCT' THEN '' ELSE product_id END AS product_id, order_date,
       CASE template_id WHEN 'ORD_NEG_AMOUNT' THEN '-' || amount ELSE amount END AS amount,
       CASE template_id WHEN 'ORD_NO_CURRENCY' THEN '' ELSE currency END AS currency,
       CASE template_id WHEN 'ORD_BAD_STATUS' THEN {pick_sql(UNKNOWN_STATES, _NUMBER)} ELSE status END AS status,
       CASE template_id WHEN 'ORD_ZERO_QTY' THEN '0' ELSE quantity END AS quantity
FROM given
"""
_SHOWN = ("order_id", "product_id", "order_date", "amount", "currency", "status", "quantity")


def _injected(spark, sf_dir):
    orders = exported_orders(spark, sf_dir)
    return inject(orders, random_plan(spark, sf_dir), "order", "order_id", "order_date")


@query(f"SELECT {', '.join(_SHOWN)} FROM ({EXPORTED_ORDERS_SQL}) UNION ALL SELECT {', '.join(_SHOWN)} FROM ({_ADDED_SQL})")
def fault_inject(spark, sf_dir):
    return _injected(spark, sf_dir)[0].select(*_SHOWN)


@query(f"SELECT order_date AS date, 'template' AS source, template_id, 'order' AS type, {', '.join(_SHOWN)} FROM ({_ADDED_SQL})")
def fault_log(spark, sf_dir):
    """What was added, read back from the log's payload."""
    log = _injected(spark, sf_dir)[1]
    payload = F.from_json("payload", ", ".join(f"{c} string" for c in _SHOWN))
    return log.withColumn("p", payload).select("date", "source", "template_id", "type", "p.*")


def _plan_log(spark, sf_dir):
    """Planned faults as template events, every order as a replayed one."""
    planned = random_plan(spark, sf_dir).select("date", F.lit("template").alias("source"), "template_id")
    replayed = exported_orders(spark, sf_dir).select(F.col("order_date").alias("date"), F.lit("parquet").alias("source"), F.lit(None).cast("string").alias("template_id"))
    return planned.unionByName(replayed)


_LOG_SQL = f"""SELECT date, 'template' AS source, template_id FROM ({PLAN_SQL})
UNION ALL SELECT order_date, 'parquet', NULL FROM ({EXPORTED_ORDERS_SQL})"""


@query(f"SELECT template_id, count(*) AS events FROM ({_LOG_SQL}) WHERE template_id IS NOT NULL GROUP BY 1")
def fault_plan_counts(spark, sf_dir):
    return reports.events_by_template(_plan_log(spark, sf_dir))


@query(f"SELECT date, count(*) AS events FROM ({_LOG_SQL}) GROUP BY 1")
def fault_events_by_day(spark, sf_dir):
    return reports.events_by_day(_plan_log(spark, sf_dir))


@query(
    f"""SELECT count(*) AS events, count(*) FILTER (WHERE source = 'template') AS template_events,
               count(*) FILTER (WHERE source = 'parquet') AS parquet_events FROM ({_LOG_SQL})"""
)
def fault_events_by_source(spark, sf_dir):
    return reports.events_by_source(_plan_log(spark, sf_dir))


_SCHEDULE = {"1995-01-02": ("ORD_NEG_AMOUNT", "CUST_BAD_EMAIL"), "1995-01-03": ("ORD_BAD_STATUS",)}


@query(
    f"""
WITH days AS (
    SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)),
fixed AS (SELECT unnest(range({len(FIXED_TEMPLATES)})) AS j, unnest([{', '.join(f"'{t}'" for t in FIXED_TEMPLATES)}]) AS template_id)
SELECT mode, date, CAST(seq AS INTEGER) AS seq, template_id, CASE WHEN template_id LIKE 'ORD%' THEN 'order' ELSE 'customer' END AS type FROM (
    SELECT 'fixed' AS mode, CAST(CAST(d AS DATE) AS VARCHAR) AS date, j // n + 1 AS seq, template_id FROM days JOIN fixed ON j % n = i
    UNION ALL SELECT 'random', date, seq, template_id FROM ({PLAN_SQL})
    UNION ALL SELECT 'per_day', date, seq, template_id FROM (VALUES
        ('1995-01-02', 1, 'ORD_NEG_AMOUNT'), ('1995-01-02', 2, 'CUST_BAD_EMAIL'), ('1995-01-03', 1, 'ORD_BAD_STATUS')) s(date, seq, template_id)
        WHERE date IN (SELECT CAST(CAST(d AS DATE) AS VARCHAR) FROM days))
"""
)
def fault_plan_modes(spark, sf_dir):
    days = days_covered(table(spark, sf_dir, "orders"), F.col("o_orderdate").cast("date"))
    plans = {
        "fixed": fault_plan(days, "fixed"),
        "random": fault_plan(days, "random", 0, 2),
        "per_day": fault_plan(days, "per_day", schedule=_SCHEDULE),
    }
    named = [p.select(F.lit(mode).alias("mode"), "*") for mode, p in plans.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


_PEOPLE_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_custkey || '@' || lower(c_mktsegment) || '.example' AS email,
       strftime(DATE '1995-01-01' + CAST(c_custkey % 40 AS INTEGER), '%Y-%m-%d') AS signup_date, c_mktsegment AS city
FROM customer
"""
_CUSTOMER_DAYS = 40
_CUSTOMER_FAULTS = ("CUST_BAD_EMAIL", "CUST_MISSING_NAME", "CUST_EMPTY_ADDR", "CUST_FUTURE_SIGNUP", "CUST_DUPLICATE")
# Template j goes to day j mod 40: of five templates the first five days get one each.
_CUSTOMER_PLAN_SQL = " UNION ALL ".join(f"SELECT '1995-01-0{k + 1}' AS date, 1 AS seq, '{t}' AS template_id" for k, t in enumerate(_CUSTOMER_FAULTS))
_PEOPLE_ADDED_SQL = f"""
WITH base AS (SELECT *, row_number() OVER (PARTITION BY signup_date ORDER BY {draw_sql('customer_id', 3)}, customer_id) AS nth FROM ({_PEOPLE_SQL}))
SELECT date, template_id, CASE template_id WHEN 'CUST_DUPLICATE' THEN customer_id ELSE customer_id || '-' || seq END AS customer_id,
       CASE template_id WHEN 'CUST_MISSING_NAME' THEN NULL ELSE name END AS name,
       CASE template_id WHEN 'CUST_BAD_EMAIL' THEN {pick_sql(INVALID_EMAILS, _NUMBER)} ELSE email END AS email,
       CASE template_id WHEN 'CUST_FUTURE_SIGNUP' THEN '1996-01-01' ELSE signup_date END AS signup_date,
       CASE template_id WHEN 'CUST_EMPTY_ADDR' THEN NULL ELSE city END AS city
FROM ({_CUSTOMER_PLAN_SQL}) JOIN base ON date = signup_date AND nth = 1
"""
_PERSON = ("customer_id", "name", "email", "signup_date", "city")


def _people(spark, sf_dir):
    """Customers with sign-up days over forty days."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("customer_id").cast("long") % _CUSTOMER_DAYS).cast("int"))
    return exported_customers(spark, sf_dir).withColumn("signup_date", day.cast("string"))


def _people_injected(spark, sf_dir):
    plan = fault_plan(day_range(spark, "1995-01-01", _CUSTOMER_DAYS), "fixed", templates=_CUSTOMER_FAULTS)
    return inject(_people(spark, sf_dir), plan, "customer", "customer_id", "signup_date", settings={"start_date": "1995-01-01"})


@query(f"SELECT {', '.join(_PERSON)} FROM ({_PEOPLE_SQL}) UNION ALL SELECT {', '.join(_PERSON)} FROM ({_PEOPLE_ADDED_SQL})")
def customer_fault_inject(spark, sf_dir):
    rows = _people_injected(spark, sf_dir)[0]
    return rows.withColumn("city", F.col("address.city")).select(*_PERSON)


@query(f"SELECT date, 'template' AS source, template_id, 'customer' AS type, {', '.join(_PERSON)} FROM ({_PEOPLE_ADDED_SQL})")
def customer_fault_log(spark, sf_dir):
    log = _people_injected(spark, sf_dir)[1]
    payload = F.from_json("payload", "customer_id string, name string, email string, signup_date string, address struct<city: string>")
    return log.withColumn("p", payload).select("date", "source", "template_id", "type", *[f"p.{c}" for c in _PERSON[:-1]], F.col("p.address.city").alias("city"))


_MIXED_SQL = f"""
SELECT order_date AS date, order_id,
       CASE WHEN {_HIT} AND {draw_sql('k', 1)} % 3 = 0 THEN '-' || amount ELSE amount END AS amount,
       CASE WHEN {_HIT} AND {draw_sql('k', 1)} % 3 = 1 THEN 'warped' ELSE status END AS status,
       CASE WHEN {_HIT} AND {draw_sql('k', 1)} % 3 = 2 THEN '0' ELSE quantity END AS quantity
FROM (SELECT *, order_id AS k FROM ({EXPORTED_ORDERS_SQL}))
"""
_MIXED_PEOPLE_SQL = f"""
SELECT signup_date AS date, {_HIT} AS bad FROM (SELECT *, customer_id AS k FROM ({_PEOPLE_SQL}))
UNION ALL SELECT date, template_id IN ('CUST_BAD_EMAIL', 'CUST_MISSING_NAME') OR {draw_sql('k')} < {round(RATE * 2**32)}
FROM (SELECT *, replace(customer_id, '-1', '') AS k FROM ({_PEOPLE_ADDED_SQL}))
"""


@query(
    f"""WITH o AS (SELECT date, count(*) AS orders, count(*) FILTER (WHERE amount LIKE '-%' OR status = 'warped' OR quantity = '0') AS bad_orders
                   FROM ({_MIXED_SQL}) GROUP BY date),
             c AS (SELECT date, count(*) AS customers, count(*) FILTER (WHERE bad) AS bad_customers FROM ({_MIXED_PEOPLE_SQL}) GROUP BY date)
        SELECT coalesce(o.date, c.date) AS date, coalesce(orders, 0) AS orders, coalesce(bad_orders, 0) AS bad_orders,
               round((1 - coalesce(bad_orders, 0) / greatest(coalesce(orders, 0), 1)) * 100, 1) AS orders_quality_pct,
               coalesce(customers, 0) AS customers, coalesce(bad_customers, 0) AS bad_customers,
               round((1 - coalesce(bad_customers, 0) / greatest(coalesce(customers, 0), 1)) * 100, 1) AS customers_quality_pct,
               coalesce(template_id, '') AS injections
        FROM o FULL JOIN c ON o.date = c.date LEFT JOIN ({_CUSTOMER_PLAN_SQL}) p ON p.date = coalesce(o.date, c.date)"""
)
def quality_by_day(spark, sf_dir):
    """A quality run over all orders and customers, with planned customer faults: its daily report."""
    settings = QualitySettings("1995-01-01", _CUSTOMER_DAYS, mode="fixed", templates=_CUSTOMER_FAULTS, order_fault_rate=RATE, customer_fault_rate=RATE)
    run = quality_run(exported_orders(spark, sf_dir), _people(spark, sf_dir), settings, shared_folder(spark, "quality"))
    names = [c for n in ("orders", "customers") for c in (n, f"bad_{n}", f"{n}_quality_pct")]
    return run.summary().select("date", *names, "injections")
