"""Quality and distribution reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.money import exact_mean, exact_sum
from oreflow.functions.parsing import to_double
from oreflow.operators import reports
from oreflow.operators.days import days_covered
from oreflow.operators.dedup import distinct_days, top_rows
from oreflow.operators.faults import TEMPLATES, plan_random
from oreflow.operators.validate import exported_order_class
from oreflow.plans.star.registry import (
    EXPORTED_ORDERS_SQL,
    day_text,
    draw_sql,
    exported_orders,
    money_text,
    pick_sql,
    query,
    table,
)

_NAMES = ("orders", "lines")

_DAILY_SQL = """
SELECT coalesce(o.date, l.date) AS date, coalesce(orders, 0) AS orders, coalesce(bad_orders, 0) AS bad_orders,
       coalesce(round((1 - bad_orders / greatest(orders, 1)) * 100, 1), 100.0) AS orders_quality_pct,
       coalesce(lines, 0) AS lines, coalesce(bad_lines, 0) AS bad_lines,
       coalesce(round((1 - bad_lines / greatest(lines, 1)) * 100, 1), 100.0) AS lines_quality_pct
FROM (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, count(*) AS orders,
             count(*) FILTER (WHERE o_orderstatus = 'P') AS bad_orders FROM orders GROUP BY 1) o
FULL JOIN (SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, count(*) AS lines,
             count(*) FILTER (WHERE l_returnflag = 'R') AS bad_lines FROM lineitem GROUP BY 1) l ON o.date = l.date
"""


FIRST_DAY = "1995-01-01"


def _daily(spark, sf_dir, **more):
    """Day keys stay dates until after the aggregation: grouping by text costs more."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    lines = table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    a = reports.daily_counts(orders, "day", F.col("o_orderstatus") == "P", "orders")
    b = reports.daily_counts(lines, "day", F.col("l_returnflag") == "R", "lines")
    return reports.daily_summary(a, b, _NAMES, **more).withColumn("date", F.col("date").cast("string"))


_DRIFT_SQL = """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, bool_or(o_orderpriority = '1-URGENT') AS drift
FROM orders GROUP BY 1"""


def _drift(spark, sf_dir):
    """Days on which urgent orders carry the optional column."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "BLACKFRI").alias("promotion_code"),
    )
    return reports.drift_flag(orders, "day", "promotion_code")


_DAYS_SQL = """SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date FROM (
    SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)"""
PLAN_SQL = f"""SELECT date, seq, {pick_sql(tuple(TEMPLATES), draw_sql("date || '|' || seq", 1))} AS template_id
FROM (SELECT date, unnest(generate_series(1, {draw_sql("date")} % 3)) AS seq FROM ({_DAYS_SQL}))"""


def random_plan(spark, sf_dir):
    """None to two templates for every day between the first and the last order."""
    days = days_covered(table(spark, sf_dir, "orders"), F.col("o_orderdate").cast("date"))
    return plan_random(days, 0, 2)


@query(
    f"""SELECT d.*, coalesce(injections, '') AS injections, coalesce(drift, FALSE) AS drift,
               CAST(date_diff('day', DATE '{FIRST_DAY}', CAST(d.date AS DATE)) + 1 AS INTEGER) AS day
        FROM ({_DAILY_SQL}) d
        LEFT JOIN (SELECT date, string_agg(template_id, ', ' ORDER BY seq) AS injections FROM ({PLAN_SQL}) GROUP BY date) p
        ON d.date = p.date
        LEFT JOIN ({_DRIFT_SQL}) f ON d.date = f.date"""
)
def daily_quality(spark, sf_dir):
    plan = random_plan(spark, sf_dir).withColumn("date", F.col("date").cast("date"))
    return _daily(spark, sf_dir, plan=plan, drift=_drift(spark, sf_dir), first_day=FIRST_DAY)


@query(
    f"""SELECT CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(bad_orders) AS BIGINT) AS bad_orders,
               round(sum(bad_orders) / greatest(sum(orders), 1) * 100, 1) AS bad_orders_pct,
               CAST(sum(lines) AS BIGINT) AS lines, CAST(sum(bad_lines) AS BIGINT) AS bad_lines,
               round(sum(bad_lines) / greatest(sum(lines), 1) * 100, 1) AS bad_lines_pct
        FROM ({_DAILY_SQL})"""
)
def quality_totals(spark, sf_dir):
    return reports.totals(_daily(spark, sf_dir), _NAMES)


@query(f"SELECT date, orders, bad_orders, lines, bad_lines FROM ({_DAILY_SQL})")
def volume_series(spark, sf_dir):
    return reports.volume_series(_daily(spark, sf_dir), _NAMES)


@query("SELECT o_orderstatus AS status, count(*) AS rows FROM orders GROUP BY 1")
def status_distribution(spark, sf_dir):
    return reports.value_counts(table(spark, sf_dir, "orders"), "o_orderstatus", "status")


@query(
    """SELECT CASE WHEN url LIKE 'https:%' THEN string_split(split_part(url, '/', 3), '@')[-1] ELSE 'invalid' END AS domain,
              count(*) AS rows
       FROM pages GROUP BY 1"""
)
def domain_distribution(spark, sf_dir):
    """Page hosts as addresses; pages without transport security have no address sign."""
    host = F.split_part("url", F.lit("/"), F.lit(3))
    secure = F.col("url").startswith("https:")
    email = F.concat(F.lit("page"), F.when(secure, "@").otherwise("."), host)
    return reports.domain_counts(table(spark, sf_dir, "pages").select(email.alias("email")))


@query(
    """SELECT p_partkey, p_name, p_type, p_retailprice AS price, new_price,
              (CASE WHEN round(new_price - p_retailprice, 2) > 0 THEN 'up +' ELSE 'down ' END)
                  || CAST(CAST(round(new_price - p_retailprice, 2) AS DECIMAL(18,2)) AS VARCHAR) AS change
       FROM part JOIN (SELECT l_partkey, max(l_extendedprice) AS new_price FROM lineitem
                       GROUP BY l_partkey) ON p_partkey = l_partkey"""
)
def price_change(spark, sf_dir):
    """List price against the highest price on a line."""
    updates = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_extendedprice").alias("new_price"))
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_retailprice", "price")
    return reports.price_changes(parts, updates, "p_partkey", ["p_name", "p_type"])


@query(
    """SELECT p_type AS category, round(CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(p_retailprice), 2) AS avg_price
       FROM part GROUP BY p_type"""
)
def avg_price_by_category(spark, sf_dir):
    """Prices come as text in the export."""
    parts = table(spark, sf_dir, "part").select(F.col("p_type").alias("category"), money_text("p_retailprice").alias("price"))
    return reports.mean_price(parts, "category", to_double(F.col("price")))


@query(
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS injections,
              count(*) AS events
       FROM events GROUP BY 1"""
)
def daily_template_list(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("date"), F.col("event_type").alias("template_id"))
    return reports.logged_templates(log).withColumn("date", F.col("date").cast("string"))


@query(_DRIFT_SQL)
def daily_drift(spark, sf_dir):
    return _drift(spark, sf_dir).withColumn("date", F.col("date").cast("string"))


_CLASS_SQL = f"""
SELECT CASE WHEN product_id = '1' THEN 'negative_amount' WHEN status = 'pending' THEN 'unknown_status'
            WHEN product_id = '3' THEN 'zero_quantity' ELSE 'ok' END AS defect
FROM ({EXPORTED_ORDERS_SQL})
"""


@query(f"SELECT defect, count(*) AS rows FROM ({_CLASS_SQL}) GROUP BY defect")
def defect_class(spark, sf_dir):
    kind = F.col("product_id")
    dirty = exported_orders(spark, sf_dir).withColumns(
        {
            "amount": F.when(kind == "1", F.concat(F.lit("-"), "amount")).when(kind == "2", "n/a").otherwise(F.col("amount")),
            "status": F.when(F.col("status") == "pending", "PENDING").otherwise(F.col("status")),
            "quantity": F.when(kind == "3", "0").otherwise(F.col("quantity")),
        }
    )
    return reports.value_counts(dirty, exported_order_class(), "defect")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_name DESC, c_custkey LIMIT 10")
def preview_top_n(spark, sf_dir):
    return top_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), 10, F.desc("c_name"), "c_custkey")


@query("SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date FROM lineitem")
def distinct_ship_days(spark, sf_dir):
    days = distinct_days(table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")))
    return days.withColumn("date", F.col("date").cast("string"))


@query(
    """SELECT count(*) AS runs, count(*) FILTER (WHERE bad > 0) AS failed, CAST(max(CASE WHEN bad > 0 THEN 1 ELSE 0 END) AS INTEGER) AS exit_code
       FROM (SELECT count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS bad
             FROM orders GROUP BY CAST(o_orderdate AS DATE))"""
)
def run_outcome(spark, sf_dir):
    """Order days as runs; a day with an urgent order still pending counts as failed."""
    stuck = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count_if(stuck).alias("bad"))
    return reports.run_outcome(days.select("date", F.when(F.col("bad") > 0, "FAIL").otherwise("SUCCESS").alias("status")))


@query(
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, count(*) AS orders,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM orders GROUP BY 1"""
)
def daily_revenue(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day"))
    sums = orders.agg(F.count("*").alias("orders"), exact_sum(F.col("o_totalprice")).alias("amount"))
    return sums.select(day_text("day").alias("date"), "orders", "amount")


@query(
    """SELECT category, CASE WHEN mean < 1e14 THEN round(mean, 2) ELSE round(mean / 1e9, 2) END AS avg_price, lines
       FROM (SELECT l_returnflag AS category, CAST(sum(CAST(price AS DECIMAL(28,9))) AS DOUBLE) / count(price) AS mean, count(*) AS lines
             FROM (SELECT l_returnflag, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 0.004
                    WHEN l_linenumber = 5 AND l_returnflag = 'R' THEN 1e17 ELSE l_extendedprice END AS price FROM lineitem)
             GROUP BY 1)"""
)
def mean_with_odd_prices(spark, sf_dir):
    """Means over prices among which some are undefined, some tiny and some huge."""
    nth = F.col("l_linenumber")
    price = F.when(nth == 7, float("nan")).when(nth == 6, 0.004).when((nth == 5) & (F.col("l_returnflag") == "R"), 1e17).otherwise(F.col("l_extendedprice"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("category"), price.alias("price"))
    means = lines.groupBy("category").agg(exact_mean(F.col("price")).alias("mean"), F.count("*").alias("lines"))
    # In billions where it is huge: doubles of that size differ in their last digit between engines.
    shown = F.when(F.col("mean") < 1e14, F.col("mean")).otherwise(F.round(F.col("mean") / 1e9, 2))
    return means.select("category", shown.alias("avg_price"), "lines")
