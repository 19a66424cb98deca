"""Dimensions, keyed writes and incremental loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.operators.dedup import keep_last
from oreflow.operators.gold import scd1, scd2_merge, scd2_open
from oreflow.operators.upsert import insert_if_absent, upsert
from oreflow.plans.star.registry import query, table
from oreflow.sources.table import newer_than, next_compound_mark, next_mark, past_mark

MARK = "2024-01-15 00:00:00"
_AT = "2024-06-01T00:00:00"


def _micros(column):
    """Timestamp as text with all six digits; a cast alone drops trailing zeros."""
    text = F.col(column).cast("string")
    return F.rpad(F.when(text.contains("."), text).otherwise(F.concat(text, F.lit("."))), 26, "0")


@query(
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value
        FROM events WHERE ts > TIMESTAMP '{MARK}'"""
)
def incremental_since(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    newer = newer_than(events, "ts", F.lit(MARK).cast(events.schema["ts"].dataType))
    return newer.select("event_id", _micros("ts").alias("ts"), "event_type", "value")


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS mark FROM events")
def watermark_next(spark, sf_dir):
    return next_mark(table(spark, sf_dir, "events"), "ts").select(_micros("mark").alias("mark"))


@query(
    f"""WITH e AS (SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events),
             first AS (SELECT * FROM e WHERE day < '{MARK[:10]}' OR (day = '{MARK[:10]}' AND event_id <= (SELECT median(event_id) FROM e WHERE day = '{MARK[:10]}'))),
             mark AS (SELECT day, event_id FROM first ORDER BY day DESC, event_id DESC LIMIT 1)
        SELECT 1 AS load, count(*) AS rows, count(DISTINCT event_id) AS ids FROM first
        UNION ALL
        SELECT 2, count(*), count(DISTINCT e.event_id) FROM e, mark WHERE e.day > mark.day OR (e.day = mark.day AND e.event_id > mark.event_id)"""
)
def increment_ties(spark, sf_dir):
    """Two loads by day and id; the first ends within a day, whose other rows the second one reads."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").cast("string").alias("day"))
    middle = events.where(F.col("day") == MARK[:10]).agg(F.expr("median(event_id)")).first()[0]
    first = events.where((F.col("day") < MARK[:10]) | (F.col("day") == MARK[:10]) & (F.col("event_id") <= middle))
    mark = next_compound_mark(first, "day", "event_id").first()["mark"]
    second = past_mark(events, "day", "event_id", tuple(mark) if mark else None)
    loads = first.select(F.lit(1).alias("load"), "event_id").unionByName(second.select(F.lit(2).alias("load"), "event_id"))
    return loads.groupBy("load").agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("ids"))


def _catalogue(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")


def _delta(spark, sf_dir):
    """Promotional parts ten per cent cheaper, small parts once more under new keys."""
    parts = _catalogue(spark, sf_dir)
    cheaper = parts.where("p_type = 'PROMO'").withColumn("p_retailprice", F.round(F.col("p_retailprice") * 0.9, 2))
    new = parts.where("p_type = 'SMALL'").withColumn("p_partkey", -F.col("p_partkey") - 1)
    return cheaper.unionByName(new).withColumn("_ingested_at", F.lit(_AT))


_DELTA_SQL = f"""
SELECT p_partkey, p_name, p_type, round(p_retailprice * 0.9, 2) AS p_retailprice, '{_AT}' AS _updated_at
FROM part WHERE p_type = 'PROMO'
UNION ALL
SELECT -p_partkey - 1, p_name, p_type, p_retailprice, '{_AT}' FROM part WHERE p_type = 'SMALL'
"""


@query(
    f"""{_DELTA_SQL} UNION ALL
        SELECT p_partkey, p_name, p_type, p_retailprice, '2024-01-01T00:00:00' FROM part WHERE p_type <> 'PROMO'"""
)
def scd1_upsert(spark, sf_dir):
    existing = scd1(None, _catalogue(spark, sf_dir), ["p_partkey"], "2024-01-01T00:00:00")
    return scd1(existing, _delta(spark, sf_dir), ["p_partkey"], _AT)


@query(_DELTA_SQL)
def scd1_replace(spark, sf_dir):
    existing = scd1(None, _catalogue(spark, sf_dir), ["p_partkey"], "2024-01-01T00:00:00")
    return scd1(existing, _delta(spark, sf_dir), ["p_partkey"], _AT, mode="replace")


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name ELSE 'late ' || c_name END AS c_name FROM customer"""
)
def insert_absent(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    known = customers.where("c_acctbal >= 0").select("c_custkey", "c_name")
    rows = customers.select("c_custkey", F.concat(F.lit("late "), F.col("c_name")).alias("c_name"))
    return insert_if_absent(known, rows, ["c_custkey"])


@query(
    """SELECT p_partkey, p_retailprice AS price FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)
       UNION ALL
       SELECT l_partkey, l_extendedprice FROM (
           SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                                        l_extendedprice DESC) AS newest FROM lineitem)
       WHERE newest = 1"""
)
def upsert_latest(spark, sf_dir):
    """Latest line price of every part written over its list price."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    latest = keep_last(lines, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"])
    rows = latest.select(F.col("l_partkey").alias("p_partkey"), F.col("l_extendedprice").alias("price"))
    return upsert(parts, rows, ["p_partkey"], stored=False)


TRACKED = ("c_nationkey", "c_mktsegment")
FIRST_DAY, SECOND_DAY = "2024-01-01", "2024-02-01"


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


@query(
    f"""SELECT c_custkey, c_name, c_mktsegment, c_nationkey, '{FIRST_DAY}' AS _eff_start, '9999-12-31' AS _eff_end,
               TRUE AS _current, md5(c_mktsegment || '|' || c_nationkey) AS _row_hash
        FROM customer"""
)
def scd2_initial(spark, sf_dir):
    return scd2_open(_customers(spark, sf_dir), TRACKED, FIRST_DAY)


@query(
    f"""
WITH old AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey, md5(c_mktsegment || '|' || c_nationkey) AS h FROM customer),
new AS (
    SELECT c_custkey, c_name || '*' AS c_name, c_nationkey,
           CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey < 10 THEN 'MACHINERY' ELSE c_mktsegment END AS c_mktsegment
    FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0),
hashed AS (SELECT *, md5(c_mktsegment || '|' || c_nationkey) AS h FROM new)
SELECT o.c_custkey, o.c_name, o.c_mktsegment, o.c_nationkey, '{FIRST_DAY}' AS _eff_start,
       CASE WHEN n.h <> o.h THEN '{SECOND_DAY}' ELSE '9999-12-31' END AS _eff_end,
       coalesce(n.h = o.h, TRUE) AS _current, o.h AS _row_hash
FROM old o LEFT JOIN hashed n USING (c_custkey)
UNION ALL
SELECT n.c_custkey, n.c_name, n.c_mktsegment, n.c_nationkey, '{SECOND_DAY}', '9999-12-31', TRUE, n.h
FROM hashed n LEFT JOIN old o USING (c_custkey) WHERE o.h IS NULL OR o.h <> n.h
"""
)
def scd2_merge_snapshot(spark, sf_dir):
    """Second load: some segments change, some customers are gone, some are new, all names differ."""
    current = scd2_open(_customers(spark, sf_dir), TRACKED, FIRST_DAY)
    customers = table(spark, sf_dir, "customer")
    moved = F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") < 10), "MACHINERY")
    present = customers.where("c_acctbal >= 0").withColumns(
        {"c_name": F.concat("c_name", F.lit("*")), "c_mktsegment": moved.otherwise(F.col("c_mktsegment"))}
    )
    new = customers.where("c_acctbal < 0").withColumn("c_custkey", -F.col("c_custkey") - 1)
    snapshot = present.unionByName(new).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return scd2_merge(current, snapshot, ["c_custkey"], TRACKED, SECOND_DAY)
