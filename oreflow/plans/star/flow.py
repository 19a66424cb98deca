"""The daily flow from landing text to gold, run over the tables as its landing area.

Line items become daily order files, with values of every good and bad kind and each first line
twice; customers become JSON lines. A backfill of two days takes every row through all stages.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.money import exact_sum
from oreflow.plans.layout import Layout
from oreflow.plans.runner import backfill
from oreflow.plans.state import RunState
from oreflow.plans.star.cleaning import ORDER_REASONS_SQL, TEXT_ORDERS_SQL, text_orders
from oreflow.plans.star.registry import query, table
from oreflow.session import shared_folder
from oreflow.sinks.export import write_json, write_orders_csv

_LAST, _FIRST = "2024-01-02", "2024-01-01"
_COLUMNS = ["order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price", "status"]

# Rows as they land, with the reasons for which they are refused.
_LANDED_SQL = f"""
SELECT t.*, {ORDER_REASONS_SQL} AS reasons, CASE WHEN l_orderkey % 2 = 0 THEN '{_FIRST}' ELSE '{_LAST}' END AS day
FROM ({TEXT_ORDERS_SQL}) t
"""
_SILVER_SQL = f"SELECT DISTINCT * FROM ({_LANDED_SQL}) WHERE reasons = ''"


def _landed(spark, sf_dir) -> tuple[Layout, list[dict]]:
    """The flow's project folder after its runs, and their records."""
    layout = Layout(shared_folder(spark, "flow"), products=False, customer_array=False, customer_schema=_CUSTOMER_SCHEMA)
    times = F.when(F.col("l_linenumber") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows, even = text_orders(spark, sf_dir).select("*", F.explode(times)), F.coalesce(F.col("l_orderkey") % 2 == 0, F.lit(False))
    for day, its in ((_FIRST, even), (_LAST, ~even)):
        write_orders_csv(rows.where(its).select(*_COLUMNS, F.lit(day).alias("day")), layout.landing_orders, day="day", keep_day=False, gather=False)
    _land_customers(spark, sf_dir, layout)
    return layout, backfill(spark, layout, _LAST, 1, effective_date="2024-01-05")


def _land_customers(spark, sf_dir, layout: Layout) -> None:
    customers = table(spark, sf_dir, "customer")
    named = customers.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.lit("Al").alias("first_name"),
        F.when(F.col("c_nationkey") > 2, F.col("c_name")).alias("last_name"),
        F.concat("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", ".").otherwise("@"), F.lit("x.example")).alias("email"),
        F.struct(F.col("c_mktsegment").alias("city"), F.lit("X").alias("country")).alias("address"),
        F.lit("2023-05-17").alias("signup_date"),
        F.lit(None).cast("string").alias("tier"),
    )
    write_json(named, f"{layout.landing_customers}/customers.json")


_CUSTOMER_SCHEMA = (
    "customer_id string, first_name string, last_name string, email string, address struct<city: string, country: string>, signup_date string, tier string"
)


@query(
    f"""SELECT day AS date, status, count(*) AS orders, CAST(sum(CAST(CAST(quantity AS DOUBLE) * CAST(unit_price AS DOUBLE) AS DECIMAL(28,9))) AS DOUBLE) AS total_amount
        FROM ({_SILVER_SQL}) GROUP BY 1, 2"""
)
def pipeline_fact(spark, sf_dir):
    layout, _ = _landed(spark, sf_dir)
    fact = spark.read.parquet(layout.fact_orders)
    sums = fact.groupBy(F.col("date").cast("string").alias("date"), "status")
    return sums.agg(F.count("*").alias("orders"), exact_sum(F.col("total_amount")).alias("total_amount"))


@query(
    f"""SELECT date, reason, count(*) AS rows FROM (
            SELECT day AS date, unnest(string_split(reasons, '; ')) AS reason
            FROM (SELECT day, reasons FROM ({_LANDED_SQL}) UNION ALL SELECT day, reasons FROM ({_LANDED_SQL}) WHERE l_linenumber = 1)
            WHERE reasons <> '') GROUP BY 1, 2"""
)
def pipeline_quarantine(spark, sf_dir):
    layout, _ = _landed(spark, sf_dir)
    bad = spark.read.parquet(f"{layout.quarantine}/orders")
    combined = bad.groupBy(F.col("run_date").cast("string").alias("date"), "_quarantine_reasons").agg(F.count("*").alias("n"))
    return combined.select("date", F.explode("_quarantine_reasons").alias("reason"), "n").groupBy("date", "reason").agg(F.sum("n").alias("rows"))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS city, '2024-01-05' AS start, true AS is_current
       FROM customer WHERE c_nationkey > 2 AND c_mktsegment <> 'BUILDING'"""
)
def pipeline_dim_customer(spark, sf_dir):
    """After the first day opened all customers and the second found them unchanged."""
    layout, _ = _landed(spark, sf_dir)
    versions = layout.dim_customer(spark).read()
    return versions.select("customer_id", "city", F.col("_eff_start").cast("string").alias("start"), F.col("_current").alias("is_current"))


@query(
    f"""WITH landed AS (SELECT day, reasons, order_id, l_linenumber FROM ({_LANDED_SQL})),
             counted AS (SELECT day, reasons, order_id FROM landed UNION ALL SELECT day, reasons, order_id FROM landed WHERE l_linenumber = 1)
        SELECT day AS date, 'SUCCESS' AS status, count(*) AS ingested, count(*) FILTER (WHERE reasons <> '') AS quarantined,
               count(*) FILTER (WHERE reasons = '') - count(DISTINCT CASE WHEN reasons = '' THEN order_id END) AS deduped,
               count(DISTINCT CASE WHEN reasons = '' THEN order_id END) AS written
        FROM counted GROUP BY day"""
)
def pipeline_run_history(spark, sf_dir):
    """What the runs recorded of the orders: status and counts of the stages."""
    _, records = _landed(spark, sf_dir)
    rows = []
    for record in records:
        counts = {s["stage"]: s["counts"] for s in record["stages"]}
        silver = counts.get("silver_orders", {})
        rows.append((record["date"], record["status"], counts.get("ingest_orders", {}).get("ingested"), *(silver.get(k) for k in ("quarantined", "deduped", "written"))))
    return spark.createDataFrame(rows, "date string, status string, ingested long, quarantined long, deduped long, written long")


@query(
    """SELECT date, status, names_column, orders, changed_products, silver_products, products FROM (
           SELECT '2024-01-01' AS date, 'SUCCESS' AS status, false AS names_column, 0 AS third, 1 AS changes, true AS ran
           UNION ALL SELECT '2024-01-02', 'FAIL', true, 1, NULL, false
           UNION ALL SELECT '2024-01-03', 'SUCCESS', false, 2, 0, true) d
       LEFT JOIN (SELECT l_orderkey % 3 AS third, count(*) AS orders FROM lineitem GROUP BY 1) o ON o.third = d.third AND d.ran,
       LATERAL (SELECT changes * count(*) AS changed_products, CASE WHEN ran THEN count(*) END AS silver_products,
                       CASE WHEN ran THEN count(*) END AS products FROM part)"""
)
def pipeline_products_and_drift(spark, sf_dir):
    """Three days with products, of which the second lacks a column and the third has no product changes.

    The second ends as a failure that names the column; the third leaves bronze products as they are, and the later
    stages go over the previous delta once more.
    """
    root = shared_folder(spark, "flow-products")
    layout = Layout(root, product_table=f"{root}/products", customer_array=False, customer_schema=_CUSTOMER_SCHEMA)
    rows = text_orders(spark, sf_dir).withColumn("day", F.concat(F.lit("2024-01-0"), F.col("l_orderkey") % 3 + 1))
    drifted = F.col("day") == "2024-01-02"
    write_orders_csv(rows.where(~drifted).select(*_COLUMNS, "day"), layout.landing_orders, day="day", keep_day=False)
    write_orders_csv(rows.where(drifted).select(*_COLUMNS[:-1], "day"), layout.landing_orders, day="day", keep_day=False)
    _land_customers(spark, sf_dir, layout)
    part, at = table(spark, sf_dir, "part"), F.date_add(F.lit("2023-12-01").cast("date"), (F.col("p_partkey") % 28).cast("int"))
    products = part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_cost"),
        F.lit("S").alias("supplier_id"),
        F.concat(at.cast("string"), F.lit("T00:00:00")).alias("updated_at"),
    )
    products.write.parquet(layout.product_table)
    backfill(spark, layout, "2024-01-03", 2, effective_date="2024-01-05")

    def count(stage: str, name: str):
        return F.expr(f"get(filter(stages, s -> s.stage = '{stage}'), 0).counts['{name}']")

    return RunState(spark, layout.state).history().select(
        "date",
        "status",
        F.coalesce(F.col("error").contains("status"), F.lit(False)).alias("names_column"),
        count("ingest_orders", "ingested").alias("orders"),
        count("ingest_products", "ingested").alias("changed_products"),
        count("silver_products", "written").alias("silver_products"),
        count("dim_product", "written").alias("products"),
    )
