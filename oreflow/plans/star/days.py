"""Day ranges and day selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.operators import days
from oreflow.operators.dedup import first_per_group
from oreflow.operators.shape import conform, rename, stamp_date
from oreflow.plans.star.registry import query, table

_ORDER_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders"
_SHIP_DAYS = "SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem"


def _days(spark, sf_dir):
    """Order days and ship days, each distinct."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    ships = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    return orders, ships


def _text(df):
    return df.withColumn("date", F.col("date").cast("string"))


@query(
    """SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date, count(o_orderkey) AS orders
       FROM (SELECT unnest(generate_series(max(o_orderdate) - INTERVAL 365 DAY, max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
       LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1"""
)
def backfill_range(spark, sf_dir):
    """The last order day and the 365 days before it, with the orders of each."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderdate").cast("date").cast("string")).first()[0]
    wanted = days.day_range(spark, days.backfill_days(last, 365)[0], 366).select(F.col("date").cast("date").alias("date"))
    recent = days.within(orders, "o_orderdate", days.backfill_days(last, 365)[0], last)
    counts = recent.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("orders"))
    joined = wanted.join(counts, "date", "left")
    return _text(joined.withColumn("orders", F.coalesce("orders", F.lit(0).cast("long"))))


@query("SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def filter_by_date(spark, sf_dir):
    day = days.on_day(table(spark, sf_dir, "events"), "ts", "2024-01-10")
    return day.select("event_id", "user_id", "event_type", "value")


@query(f"SELECT CAST(d AS VARCHAR) AS date FROM ({_SHIP_DAYS}) WHERE d IN ({_ORDER_DAYS})")
def date_match(spark, sf_dir):
    orders, ships = _days(spark, sf_dir)
    return _text(days.common_days(ships, orders))


@query(f"SELECT CAST(d AS VARCHAR) AS date FROM ({_SHIP_DAYS}) WHERE d NOT IN ({_ORDER_DAYS})")
def date_absent(spark, sf_dir):
    orders, ships = _days(spark, sf_dir)
    return _text(days.absent_days(ships, orders))


@query(
    f"""SELECT CAST(coalesce(o.d, l.d) AS VARCHAR) AS date, o.d IS NOT NULL AS in_left, l.d IS NOT NULL AS in_right
        FROM ({_ORDER_DAYS}) o FULL JOIN ({_SHIP_DAYS}) l ON o.d = l.d"""
)
def date_selection(spark, sf_dir):
    orders, ships = _days(spark, sf_dir)
    return _text(days.either_days(orders, ships))


@query(f"SELECT CAST(d AS VARCHAR) AS date FROM ({_ORDER_DAYS} UNION {_SHIP_DAYS.replace('DISTINCT ', '')})")
def date_union(spark, sf_dir):
    orders, ships = _days(spark, sf_dir)
    return _text(days.all_days(orders, ships))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS status, '' AS currency, CAST(CAST(ts AS DATE) AS VARCHAR) AS order_date
       FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS nth FROM events) WHERE nth <= 5"""
)
def replay_day(spark, sf_dir):
    """First five events of every day, renamed and put into the export's shape."""
    events = table(spark, sf_dir, "events").withColumn("_day", F.col("ts").cast("date"))
    first = first_per_group(events, ["_day"], [F.asc("event_id")], 5)
    named = rename(first, {"event_id": "order_id", "event_type": "status"})
    shaped = conform(named, ["order_id", "status", "currency", "order_date", "_day"])
    return stamp_date(shaped, "order_date", F.col("_day")).drop("_day")
