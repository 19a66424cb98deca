"""Operators that write: the table is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow import fs
from oreflow.contracts import EXPORT_CUSTOMERS, MALFORMED, ORDERS
from oreflow.functions.money import exact_sum
from oreflow.plans.star.registry import exported_customers, exported_orders, query, table
from oreflow.session import shared_folder
from oreflow.sinks.buckets import Buckets
from oreflow.sinks.export import write_json, write_orders_csv
from oreflow.sinks.partitions import replace_days
from oreflow.sinks.snapshots import History
from oreflow.sources.days import DAY, available_days, read_days, replay_rows
from oreflow.sources.landing import read_orders


@query(
    """SELECT month AS date, count(*) AS orders, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM (
           SELECT strftime(o_orderdate, '%Y-%m-01') AS month,
                  CASE WHEN strftime(o_orderdate, '%Y-%m-01') = (SELECT min(strftime(o_orderdate, '%Y-%m-01')) FROM orders)
                       THEN 0 ELSE o_totalprice END AS price
           FROM orders)
       GROUP BY 1"""
)
def partition_replace(spark, sf_dir):
    """Orders by month; the first month is written again with other prices, the rest stays."""
    path = shared_folder(spark, "orders-by-month")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.trunc(F.col("o_orderdate").cast("date"), "month").cast("string").alias("date"))
    replace_days(orders, path)
    first = available_days(spark, path, "date={date}")[0]
    redone = orders.where(F.col("date") == first).withColumn("o_totalprice", F.lit(0.0))
    replace_days(redone, path)
    stored = spark.read.schema("o_orderkey long, o_totalprice double, date string").parquet(path)
    return stored.groupBy("date").agg(F.count("*").alias("orders"), exact_sum(F.col("o_totalprice")).alias("amount"))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS status, '' AS currency,
              CAST(CAST(ts AS DATE) AS VARCHAR) AS order_date
       FROM events"""
)
def replay_files(spark, sf_dir):
    """Events as a quarantine by day, found again by folder name and replayed as a whole."""
    path = shared_folder(spark, "quarantine")
    events = table(spark, sf_dir, "events").withColumn("dt", F.col("ts").cast("date"))
    replace_days(events, path, "dt")
    days = available_days(spark, path)
    rows = replay_rows(
        spark,
        path,
        days,
        ["order_id", "status", "currency", "order_date"],
        names={"event_id": "order_id", "event_type": "status"},
    )
    return rows.drop(DAY)


@query(
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, least(7, count(*)) AS rows FROM events GROUP BY 1"""
)
def replay_limit(spark, sf_dir):
    """First seven rows of each day over its files; which ones depends on the files, how many does not."""
    path = shared_folder(spark, "quarantine")
    replace_days(table(spark, sf_dir, "events").withColumn("dt", F.col("ts").cast("date")), path, "dt")
    first = read_days(spark, path, available_days(spark, path), max_rows=7)
    return first.groupBy(F.col(DAY).alias("date")).agg(F.count("*").alias("rows"))


@query(
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
              count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) >= 1998) AS promoted
       FROM orders GROUP BY 1"""
)
def export_orders_csv(spark, sf_dir):
    """Orders as CSV by month, the optional column from 1998 on, read back by header name."""
    path = shared_folder(spark, "export-csv")
    orders = exported_orders(spark, sf_dir).withColumn("month", F.substring("order_date", 1, 7))
    urgent = (F.col("product_id") == "1") & (F.col("month") >= "1998")
    write_orders_csv(orders.withColumn("promotion_code", F.when(urgent, "SAVE10")), path, day="month")
    narrow, wide = [], []
    for folder in fs.folders(spark, path):
        (wide if folder >= "date=1998" else narrow).append(f"{path}/{folder}")
    read = spark.read.option("header", True).option("escape", '"')
    parts = [read.csv(group) for group in (narrow, wide) if group]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    promoted = F.count("promotion_code") if "promotion_code" in rows.columns else F.lit(0).cast("long")
    return rows.groupBy("month").agg(
        F.count("*").alias("rows"), exact_sum(F.col("amount")).alias("amount"), promoted.alias("promoted")
    )


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_mktsegment AS city, '+1-' || c_nationkey AS phone
       FROM customer"""
)
def export_customers_json(spark, sf_dir):
    """Customers as JSON by signup day, read back with their nested columns."""
    path = shared_folder(spark, "export-json")
    write_json(exported_customers(spark, sf_dir), path, by="signup_date")
    schema = ", ".join(f"{c} {EXPORT_CUSTOMERS.nested.get(c, 'string')}" for c in EXPORT_CUSTOMERS.columns)
    rows = spark.read.schema(schema).json(path)
    return rows.select("customer_id", "name", F.col("address.city").alias("city"), F.col("phones")[0].alias("phone"))


@query(
    """SELECT _current, _eff_start, _eff_end, count(*) AS rows FROM (
           SELECT c_mktsegment = 'BUILDING' AS gone, unnest(CASE WHEN c_mktsegment = 'BUILDING' THEN [1, 2] ELSE [3] END) AS v FROM customer)
       , LATERAL (SELECT v <> 1 AS _current, CASE WHEN v = 2 THEN '2024-02-01' ELSE '2024-01-01' END AS _eff_start,
                         CASE WHEN v = 1 THEN '2024-02-01' ELSE '9999-12-31' END AS _eff_end)
       GROUP BY 1, 2, 3"""
)
def scd2_stored(spark, sf_dir):
    """Two loads of a stored customer history and an unchanged third one."""
    history = History(spark, shared_folder(spark, "dim-customer"), ["c_custkey"])
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    history.merge(customers, ["c_mktsegment"], "2024-01-01")
    moved = customers.withColumn("c_mktsegment", F.regexp_replace("c_mktsegment", "^BUILDING$", "TOOLS"))
    for day in ("2024-02-01", "2024-03-01"):
        history.merge(moved, ["c_mktsegment"], day)
    return history.read().groupBy("_current", "_eff_start", "_eff_end").agg(F.count("*").alias("rows"))


@query(
    """SELECT c_custkey AS key, CASE c_mktsegment WHEN 'BUILDING' THEN 'TOOLS' ELSE c_mktsegment END AS segment, c_name AS name, c_acctbal AS balance,
              CASE c_mktsegment WHEN 'BUILDING' THEN '2024-02-01' ELSE '2024-01-01' END AS eff_start,
              CASE WHEN c_nationkey % 2 = 0 THEN '2024-03-05' ELSE '9999-12-31' END AS eff_end
       FROM customer
       UNION ALL SELECT -c_custkey - 1, 'NEW', c_name, c_acctbal, '2024-02-01', '9999-12-31' FROM customer WHERE c_nationkey < 5"""
)
def scd2_as_of(spark, sf_dir):
    """Three loads of a stored customer history, the last for some keys only, and what held between the last two."""
    history = History(spark, shared_folder(spark, "dim-customer-as-of"), ["key"])
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_nationkey")
    moved = customers.withColumn("segment", F.regexp_replace("segment", "^BUILDING$", "TOOLS"))
    new = customers.where("c_nationkey < 5").withColumns({"key": -F.col("key") - 1, "segment": F.lit("NEW")})
    last = customers.where("c_nationkey % 2 = 0").withColumns({"segment": F.lit("LAST"), "name": F.lit("unseen")})
    for rows, day in ((customers, "2024-01-01"), (moved.unionByName(new), "2024-02-01"), (last, "2024-03-05")):
        history.merge(rows.drop("c_nationkey"), ["segment"], day)
    held = history.read_as_of("2024-02-15")
    return held.select("key", "segment", "name", "balance", F.col("_eff_start").alias("eff_start"), F.col("_eff_end").alias("eff_end"))


@query(
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM orders GROUP BY 1"""
)
def export_two_days(spark, sf_dir):
    """Orders exported half by half, then the first half once more: no month goes missing."""
    path = shared_folder(spark, "export-twice")
    orders = exported_orders(spark, sf_dir).withColumn("month", F.substring("order_date", 1, 7)).withColumn("promotion_code", F.when(F.col("product_id") == "1", "X"))
    early = F.col("month") < "1995-07"
    for half in (early, ~early, early):
        write_orders_csv(orders.where(half), path, day="month")
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.groupBy("month").agg(F.count("*").alias("rows"), exact_sum(F.col("amount")).alias("amount"))


@query(
    """SELECT strftime(DATE '2024-01-01' + CAST(c_nationkey AS INTEGER), '%Y-%m-%d') AS day, count(*) AS rows, min(c_name) AS name
       FROM customer GROUP BY 1"""
)
def export_customer_days(spark, sf_dir):
    """Customers over many sign-up days as JSON, exported in two parts to one folder."""
    path = shared_folder(spark, "export-json-days")
    customers = exported_customers(spark, sf_dir).withColumn("signup_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("address.state").cast("int")).cast("string"))
    late = F.col("signup_date") > "2024-01-10"
    for part in (late, ~late):
        write_json(customers.where(part), path, by="signup_date")
    schema = ", ".join(f"{c} {EXPORT_CUSTOMERS.nested.get(c, 'string')}" for c in EXPORT_CUSTOMERS.columns)
    rows = spark.read.schema(schema).json(path)
    return rows.groupBy(F.col("signup_date").alias("day")).agg(F.count("*").alias("rows"), F.min("name").alias("name"))


@query(
    """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS order_id, l_partkey % 5 = 1 AS bad,
              CASE l_partkey % 5 WHEN 0 THEN 'two' || chr(10) || 'lines "of" ' || l_partkey || ',' WHEN 1 THEN NULL
                   WHEN 2 THEN l_partkey || '" wide' ELSE 'P' || l_partkey END AS product_id
       FROM lineitem"""
)
def landing_quoted_lines(spark, sf_dir):
    """Line items as landing files whose values hold line ends, doubled quotes and, in every fifth, a quote that never closes."""
    part = F.col("l_partkey")
    product = (
        F.when(part % 5 == 0, F.concat(F.lit('"two\nlines ""of"" '), part, F.lit(',"')))
        .when(part % 5 == 1, F.concat(F.lit('"P'), part))
        .when(part % 5 == 2, F.concat(part, F.lit('" wide')))
        .otherwise(F.concat(F.lit("P"), part))
    )
    record = F.concat_ws(",", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"), "l_suppkey", product, F.lit("2024-01-01,1,2.0,shipped"))
    # As text the lines are written as they are; the name of the one column gives each file its header.
    lines = table(spark, sf_dir, "lineitem").select(F.explode(F.split(record, "\n")).alias(",".join(ORDERS.columns)))
    landing = shared_folder(spark, "landing-lines")
    lines.write.options(header=True, sep="\u0001", quote="\u0000", escapeQuotes=False, emptyValue="").csv(f"{landing}/orders_2024-01-01.csv")
    rows = read_orders(spark, landing, "2024-01-01", "2024-01-02T00:00:00")
    bad = F.col(MALFORMED).isNotNull()
    return rows.select("order_id", bad.alias("bad"), F.when(~bad, F.col("product_id")).alias("product_id"))


@query(
    """SELECT c_custkey AS key, CASE WHEN c_custkey % 500 = 0 THEN 'moved' ELSE c_mktsegment END AS segment, c_acctbal AS balance FROM customer
       UNION ALL SELECT -c_custkey - 1, 'new', NULL FROM customer WHERE c_custkey % 700 = 0"""
)
def upsert_buckets(spark, sf_dir):
    """Customers in hash buckets; two small deltas rewrite the buckets of their keys only."""
    stored = Buckets(spark, shared_folder(spark, "buckets"), ["key"])
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    stored.write(customers)
    stored.upsert(customers.where("key % 500 = 0").withColumn("segment", F.lit("moved")))
    stored.upsert(customers.where("key % 700 = 0").select((-F.col("key") - 1).alias("key"), F.lit("new").alias("segment")))
    return stored.read()
