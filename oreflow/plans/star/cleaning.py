"""Drift, validation, normalisation, deduplication and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from oreflow.contracts import CUSTOMERS, EXPORT_CUSTOMERS, EXPORT_ORDERS, ORDERS, Contract, Field, Rule, at_least_zero, one_of
from oreflow.functions.hashing import row_hash
from oreflow.functions.money import exact_sum
from oreflow.functions.text import folder_date
from oreflow.operators.dedup import keep_last
from oreflow.operators.drift import require_columns, widen
from oreflow.operators.gold import fact_orders
from oreflow.operators.shape import conform, drop_technical, flatten, nested_to_json, rename, stamp_date, with_lineage
from oreflow.operators.validate import (
    bad_rows,
    exported_customer_is_bad,
    exported_order_is_bad,
    good_rows,
    judged,
    reason_counts,
    split,
    values_of,
)
from oreflow.plans.star.registry import (
    EXPORTED_ORDERS_SQL,
    ORDER_LINES_SQL,
    day_text,
    exported_customers,
    exported_orders,
    order_lines,
    query,
    table,
)
from oreflow.session import shared_folder

PRICE_LIMIT = 450_000
STAR_ORDERS = Contract(
    "orders",
    ("o_orderkey",),
    (
        Field("o_orderkey", "long"),
        Field("o_custkey", "long"),
        Field("o_orderdate", "date"),
        Field("o_totalprice", "double", rules=(at_least_zero(), Rule("too high", lambda v: v <= PRICE_LIMIT))),
        Field("o_orderstatus", rules=(one_of(("o", "f")),)),
    ),
)
STAR_CUSTOMERS = Contract("customer", ("c_custkey",), (Field("c_custkey", "long"), Field("c_acctbal", "double", rules=(at_least_zero(),))))
STAR_SUPPLIERS = Contract("supplier", ("s_suppkey",), (Field("s_suppkey", "long"), Field("s_acctbal", "double", rules=(at_least_zero(),))))

_REASON_SQL = f"""
concat_ws('; ',
    CASE WHEN o_orderkey IS NULL THEN 'o_orderkey: missing' END,
    CASE WHEN o_custkey IS NULL THEN 'o_custkey: missing' END,
    CASE WHEN o_orderdate IS NULL THEN 'o_orderdate: missing' END,
    CASE WHEN o_totalprice IS NULL THEN 'o_totalprice: missing'
         WHEN o_totalprice < 0 THEN 'o_totalprice: must be >= 0'
         WHEN o_totalprice > {PRICE_LIMIT} THEN 'o_totalprice: too high' END,
    CASE WHEN o_orderstatus IS NULL THEN 'o_orderstatus: missing'
         WHEN lower(o_orderstatus) NOT IN ('o', 'f') THEN 'o_orderstatus: not one of o, f' END)
"""


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day
        FROM orders WHERE {_REASON_SQL} = ''"""
)
def validate_good(spark, sf_dir):
    good = good_rows(table(spark, sf_dir, "orders"), STAR_ORDERS)
    return good.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day_text("o_orderdate").alias("order_day"))


@query(
    f"""SELECT o_orderkey, reason AS _quarantine_reason, '2024-06-01T00:00:00' AS _quarantined_at
        FROM (SELECT o_orderkey, {_REASON_SQL} AS reason FROM orders) WHERE reason <> ''"""
)
def validate_quarantine(spark, sf_dir):
    bad = bad_rows(table(spark, sf_dir, "orders"), STAR_ORDERS, "2024-06-01T00:00:00")
    return bad.select("o_orderkey", "_quarantine_reason", "_quarantined_at")


@query(
    f"""SELECT reason, count(*) AS rows FROM (
            SELECT unnest(string_split(reason, '; ')) AS reason FROM (SELECT {_REASON_SQL} AS reason FROM orders) WHERE reason <> ''
            UNION ALL SELECT 'c_acctbal: must be >= 0' FROM customer WHERE c_acctbal < 0
            UNION ALL SELECT 's_acctbal: must be >= 0' FROM supplier WHERE s_acctbal < 0)
        GROUP BY reason"""
)
def quarantine_reasons(spark, sf_dir):
    contracts = (STAR_ORDERS, STAR_CUSTOMERS, STAR_SUPPLIERS)
    first, *rest = [bad_rows(table(spark, sf_dir, c.name), c).select("_quarantine_reasons") for c in contracts]
    for more in rest:
        first = first.unionByName(more)
    return reason_counts(first)


TEXT_ORDERS_SQL = """
SELECT l_orderkey, l_linenumber, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR), CAST(l_quantity AS INTEGER), l_returnflag) AS order_id,
       CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE 'C' || l_suppkey END AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CASE WHEN l_partkey % 31 = 0 THEN '2024-13-01' WHEN l_partkey % 31 = 1 THEN strftime(l_shipdate, '%d/%m/%Y')
            ELSE strftime(l_shipdate, '%Y-%m-%d') END AS order_date,
       CASE l_linenumber WHEN 1 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) WHEN 2 THEN CAST(l_quantity AS VARCHAR)
            WHEN 3 THEN '2.5' WHEN 4 THEN 'many' WHEN 5 THEN '0' WHEN 6 THEN '-1' END AS quantity,
       CASE l_suppkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '-0.5' WHEN 2 THEN 'free' ELSE '19.90' END AS unit_price,
       CASE l_returnflag WHEN 'A' THEN 'Delivered' WHEN 'N' THEN 'shipped' ELSE 'refunded' END AS status
FROM lineitem
"""
ORDER_REASONS_SQL = """
concat_ws('; ', CASE WHEN customer_id IS NULL THEN 'customer_id: missing' END,
    CASE WHEN order_date = '2024-13-01' OR order_date LIKE '%/%' THEN 'order_date: not an ISO date' END,
    CASE WHEN quantity IS NULL THEN 'quantity: missing' WHEN quantity IN ('2.5', 'many') THEN 'quantity: not an integer'
         WHEN CAST(quantity AS DOUBLE) <= 0 THEN 'quantity: must be > 0' END,
    CASE unit_price WHEN '-0.5' THEN 'unit_price: must be >= 0' WHEN 'free' THEN 'unit_price: not a number' END,
    CASE WHEN status = 'refunded' THEN 'status: not one of pending, shipped, delivered, cancelled, returned' END)
"""


def text_orders(spark, sf_dir):
    """Line items as a landing file would hold them: text, with values of every good and bad kind."""
    lines, part, nth = table(spark, sf_dir, "lineitem"), F.col("l_partkey") % 31, F.col("l_linenumber")
    quantity = (
        F.when(nth == 1, F.col("l_quantity").cast("int").cast("string"))
        .when(nth == 2, F.col("l_quantity").cast("string"))
        .when(nth == 3, "2.5")
        .when(nth == 4, "many")
        .when(nth == 5, "0")
        .when(nth == 6, "-1")
    )
    price = F.when(F.col("l_suppkey") % 9 == 1, "-0.5").when(F.col("l_suppkey") % 9 == 2, "free").when(F.col("l_suppkey") % 9 > 2, "19.90")
    day = F.when(part == 0, "2024-13-01").when(part == 1, F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise(day_text("l_shipdate"))
    status = F.when(F.col("l_returnflag") == "A", "Delivered").when(F.col("l_returnflag") == "N", "shipped").otherwise("refunded")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day_text("l_shipdate"), F.col("l_quantity").cast("int"), "l_returnflag").alias("order_id"),
        F.when(F.col("l_suppkey") % 50 != 0, F.concat(F.lit("C"), "l_suppkey")).alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        day.alias("order_date"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        status.alias("status"),
    )


@query(
    f"""SELECT order_id, CAST(nullif(reasons, '') AS VARCHAR) AS reasons,
               CASE WHEN reasons = '' THEN CAST(CAST(quantity AS DOUBLE) AS BIGINT) END AS quantity,
               CASE WHEN reasons = '' THEN CAST(unit_price AS DOUBLE) END AS unit_price
        FROM (SELECT *, {ORDER_REASONS_SQL} AS reasons FROM ({TEXT_ORDERS_SQL}))"""
)
def validate_text_orders(spark, sf_dir):
    """Orders as text: the good ones typed, the bad ones with every reason."""
    rows = judged(text_orders(spark, sf_dir), ORDERS)
    good, value = F.size("_quarantine_reasons") == 0, values_of(ORDERS)
    reasons = F.nullif(F.array_join("_quarantine_reasons", "; "), F.lit(""))
    return rows.select("order_id", reasons.alias("reasons"), *[F.when(good, value[c]).alias(c) for c in ("quantity", "unit_price")])


@query(
    f"""SELECT good, reason, count(*) AS rows FROM (
            SELECT reasons = '' AS good, unnest(CASE WHEN reasons = '' THEN ['none'] ELSE string_split(reasons, '; ') END) AS reason
            FROM (SELECT *, {ORDER_REASONS_SQL} AS reasons FROM ({TEXT_ORDERS_SQL})))
        GROUP BY 1, 2
        UNION ALL
        SELECT true, 'total amount', CAST(floor(sum(CAST(CAST(quantity AS DOUBLE) * CAST(unit_price AS DOUBLE) AS DECIMAL(18,2)))) AS BIGINT)
        FROM (SELECT *, {ORDER_REASONS_SQL} AS reasons FROM ({TEXT_ORDERS_SQL})) WHERE reasons = ''"""
)
def validate_split(spark, sf_dir):
    """Orders as text, judged in one pass and one write; the counts of the reasons come with that write."""
    found = split(text_orders(spark, sf_dir), ORDERS, shared_folder(spark, "checked"), "2024-06-01T00:00:00")
    counts = [(False, m, n) for m, n in found.reasons.items()] + [(True, "none", found.rows - found.refused)]
    total = found.good.agg(exact_sum(F.col("quantity") * F.col("unit_price")).alias("total"))
    told = spark.createDataFrame(counts, "good boolean, reason string, rows long")
    return told.unionByName(total.select(F.lit(True).alias("good"), F.lit("total amount").alias("reason"), F.floor("total").cast("long").alias("rows")))


_CUSTOMER_REASONS_SQL = """
concat_ws('; ', CASE WHEN c_nationkey % 5 = 0 THEN 'last_name: missing' END,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'email: has no @' WHEN c_mktsegment = 'MACHINERY' THEN 'email: missing' END,
    CASE WHEN c_nationkey % 5 = 1 THEN 'signup_date: not an ISO date' END)
"""


@query(
    f"""SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(nullif({_CUSTOMER_REASONS_SQL}, '') AS VARCHAR) AS reasons FROM customer"""
)
def validate_text_customers(spark, sf_dir):
    """Customers as text: names, e-mails and dates that are missing or cannot be read; a null tier is good."""
    nation, segment = F.col("c_nationkey") % 5, F.col("c_mktsegment")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.lit("Al").alias("first_name"),
        F.when(nation != 0, F.col("c_name")).alias("last_name"),
        F.when(segment == "BUILDING", "nobody").when(segment != "MACHINERY", F.concat("c_custkey", F.lit("@x.example"))).alias("email"),
        F.lit("").alias("city"),
        F.lit("").alias("country"),
        F.when(nation == 1, "soon").otherwise("2024-02-29").alias("signup_date"),
        F.lit(None).cast("string").alias("tier"),
    )
    reasons = F.array_join(F.array_compact(F.array(*CUSTOMERS.errors(rows))), "; ")
    return rows.select("customer_id", F.nullif(reasons, F.lit("")).alias("reasons"))


@query(
    f"""SELECT status, count(*) FILTER (WHERE amount BETWEEN 0 AND 100000) AS within,
               count(*) FILTER (WHERE NOT amount BETWEEN 0 AND 100000) AS outside
        FROM (SELECT status, quantity * unit_price AS amount FROM ({ORDER_LINES_SQL}) WHERE status <> 'refunded')
        GROUP BY status"""
)
def amount_bounds(spark, sf_dir):
    lines = good_rows(order_lines(spark, sf_dir).drop("_ord"), ORDERS)
    bounded = ORDERS.with_amount_bounds(0.0, 100_000.0, lambda v: v["quantity"] * v["unit_price"])
    refused = F.coalesce(*bounded.errors(lines)).isNotNull()
    return lines.groupBy("status").agg(F.count_if(~refused).alias("within"), F.count_if(refused).alias("outside"))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, lower(c_name || '@Example.COM') AS email,
              coalesce(nullif(c_mktsegment, 'BUILDING'), 'standard') AS tier
       FROM customer"""
)
def normalize_values(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat("c_name", F.lit("@Example.COM")).alias("email"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("tier"),
    )
    return CUSTOMERS.normalize(rows)


@query(
    f"""SELECT order_id, amount < 0 OR amount IS NULL OR status NOT IN ('shipped', 'pending', 'delivered', 'cancelled')
               OR quantity = '0' AS bad
        FROM (SELECT order_id, CASE WHEN status = 'pending' THEN 'Pending' ELSE status END AS status,
                     CASE WHEN product_id = '1' THEN NULL WHEN product_id = '2' THEN -CAST(amount AS DOUBLE) ELSE CAST(amount AS DOUBLE) END AS amount,
                     CASE WHEN product_id = '3' THEN '0' ELSE quantity END AS quantity
              FROM ({EXPORTED_ORDERS_SQL}))"""
)
def exported_order_flags(spark, sf_dir):
    orders = exported_orders(spark, sf_dir)
    kind = F.col("product_id")
    dirty = orders.withColumns(
        {
            "amount": F.when(kind == "1", F.concat(F.lit("USD "), F.col("amount")))
            .when(kind == "2", F.concat(F.lit("-"), F.col("amount")))
            .otherwise(F.col("amount")),
            "status": F.when(F.col("status") == "pending", "Pending").otherwise(F.col("status")),
            "quantity": F.when(kind == "3", "0").otherwise(F.col("quantity")),
        }
    )
    return dirty.select("order_id", exported_order_is_bad().alias("bad"))


@query(
    """SELECT c_custkey AS customer_id,
              name IS NULL OR email IS NULL OR email NOT LIKE '%@%' OR email LIKE '@%' OR email LIKE '%@' AS bad,
              CASE WHEN c_nationkey BETWEEN 1 AND 9 THEN '2024-01-0' || c_nationkey END AS folder_day
       FROM (SELECT c_custkey, c_nationkey, nullif(c_mktsegment, 'BUILDING') AS name,
                    CASE c_mktsegment WHEN 'MACHINERY' THEN '@' || c_name WHEN 'FURNITURE' THEN c_name || '@'
                         WHEN 'HOUSEHOLD' THEN c_name ELSE c_name || '@example.com' END AS email
             FROM customer)"""
)
def exported_customer_flags(spark, sf_dir):
    customers, name = table(spark, sf_dir, "customer"), F.col("c_name")
    email = (
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("@"), name))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(name, F.lit("@")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", name)
        .otherwise(F.concat(name, F.lit("@example.com")))
    )
    rows = customers.select(
        F.col("c_custkey").alias("customer_id"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("name"),
        email.alias("email"),
        F.concat(F.lit("dt=2024-01-0"), F.col("c_nationkey")).alias("folder"),
    )
    return rows.select("customer_id", exported_customer_is_bad().alias("bad"), folder_date(F.col("folder")).alias("folder_day"))


@query(
    """SELECT * EXCLUDE (newest, l_shipdate), CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                         l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS newest
             FROM lineitem)
       WHERE newest = 1"""
)
def dedup_keep_last(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    key = ("l_orderkey", "l_linenumber")
    order = ["l_shipdate", *[c for c in lines.columns if c not in (*key, "l_shipdate")]]
    return keep_last(lines, key, order).withColumn("ship_day", day_text("l_shipdate")).drop("l_shipdate")


@query(
    """SELECT c_custkey, c_name, c_mktsegment, CAST(NULL AS VARCHAR) AS promotion_code FROM customer
       UNION ALL
       SELECT c_custkey, c_name, c_mktsegment, 'SAVE' || c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def drift_union(spark, sf_dir):
    narrow = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    later = narrow.where("c_mktsegment = 'BUILDING'").withColumn("promotion_code", F.concat(F.lit("SAVE"), F.col("c_nationkey")))
    base = narrow.drop("c_nationkey")
    require_columns(later, base.columns, "customer")
    return widen(base, later.drop("c_nationkey"))


@query(
    """SELECT event_id, json_extract_string(props, '$.k') AS k, '' AS absent,
              '{"k":' || json_extract_string(props, '$.k') || ',"tags":["' || event_type || '"]}' AS props_json
       FROM events"""
)
def flatten_json(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    nested = events.withColumn("props_json", F.struct("props.k", F.array("event_type").alias("tags")))
    return flatten(nested_to_json(nested, ["props_json"]), "props", ("k", "absent")).drop("event_type")


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, CASE WHEN p_size > 25 THEN '' ELSE p_type END AS category,
              CAST(p_size AS VARCHAR) AS size, '' AS supplier_id, '2024-06-01' AS updated_at
       FROM part"""
)
def rename_conform(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("p_type", F.when(F.col("p_size") <= 25, F.col("p_type")))
    named = rename(parts, {"p_partkey": "product_id", "p_name": "name", "p_type": "category", "p_size": "size"})
    shaped = conform(named, ["product_id", "name", "category", "size", "supplier_id", "updated_at"])
    return stamp_date(shaped, "updated_at", F.lit("2024-06-01"))


@query(
    """SELECT 'orders.parquet' AS _source_file, '2024-06-01T00:00:00' AS _ingested_at, '2024-06-01' AS _partition_date,
              count(*) AS rows
       FROM orders"""
)
def lineage_counts(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.col("_metadata.file_path").alias("_file"))
    # The tables may be one file or a folder of parts; either way the name ends in the table's.
    source = F.regexp_extract("_file", r"([^/]+\.parquet)(/[^/]*)?$", 1)
    rows = with_lineage(raw, "2024-06-01T00:00:00", source, "2024-06-01")
    return rows.groupBy("_source_file", "_ingested_at", "_partition_date").agg(F.count("*").alias("rows"))


@query(
    f"""SELECT order_id, customer_id, product_id, CAST(order_date AS VARCHAR) AS order_date, quantity, unit_price, status,
              quantity * unit_price AS total_amount
        FROM ({ORDER_LINES_SQL}) WHERE status <> 'refunded' AND newest = 1"""
)
def fact_total(spark, sf_dir):
    return _fact(spark, sf_dir).withColumn("order_date", day_text("order_date"))


@query(
    f"""SELECT status, count(*) AS orders, CAST(sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
        FROM ({ORDER_LINES_SQL}) WHERE status <> 'refunded' AND newest = 1 GROUP BY status"""
)
def fact_by_status(spark, sf_dir):
    total = exact_sum(F.col("total_amount")).alias("total_amount")
    return _fact(spark, sf_dir).groupBy("status").agg(F.count("*").alias("orders"), total)


def _fact(spark, sf_dir):
    return fact_orders(keep_last(good_rows(order_lines(spark, sf_dir), ORDERS), ORDERS.key, ["_ord"]))


@query(
    f"""SELECT count(*) AS ingested, count(*) FILTER (WHERE status = 'refunded') AS quarantined,
               count(*) FILTER (WHERE status <> 'refunded' AND newest > 1) AS deduped,
               count(*) FILTER (WHERE status <> 'refunded' AND newest = 1) AS written
        FROM ({ORDER_LINES_SQL})"""
)
def stage_counts(spark, sf_dir):
    """The counters of a silver stage, from the rows that its steps really gave."""
    lines = order_lines(spark, sf_dir)
    good = good_rows(lines, ORDERS)
    counts = {"ingested": lines, "quarantined": bad_rows(lines, ORDERS), "good": good, "written": keep_last(good, ORDERS.key, ["_ord"])}
    parts = [df.select(F.lit(name).alias("stage")) for name, df in counts.items()]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    found = rows.agg(*[F.count_if(F.col("stage") == name).alias(name) for name in counts])
    return found.select("ingested", "quarantined", (F.col("good") - F.col("written")).alias("deduped"), "written")


@query(
    """SELECT p_partkey, md5(concat_ws('|', p_brand, '', p_name, coalesce(CASE WHEN p_size <= 25 THEN CAST(p_size AS VARCHAR) END, 'None'))) AS hash
       FROM part"""
)
def row_hashes(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("p_size", F.when(F.col("p_size") <= 25, F.col("p_size")))
    tracked = ("p_size", "p_name", "p_brand", "p_container")
    return parts.select("p_partkey", row_hash(tracked, parts.columns).alias("hash"))


@query(
    f"""SELECT order_id, customer_id, product_id, order_date, amount, currency, status, quantity, '' AS promotion_code
        FROM ({EXPORTED_ORDERS_SQL})"""
)
def export_shape(spark, sf_dir):
    """Exported orders under the wider column list of a run with the optional column."""
    orders = drop_technical(exported_orders(spark, sf_dir).withColumn("_file", F.lit("x")))
    return conform(orders, [*EXPORT_ORDERS.columns, *EXPORT_ORDERS.optional])


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
              '{"street":"","city":"' || c_mktsegment || '","state":"' || c_nationkey || '","zip":""}' AS address,
              '["+1-' || c_nationkey || '"]' AS phones
       FROM customer"""
)
def nested_customers(spark, sf_dir):
    """Nested customer columns to JSON text and back through the replay conversion."""
    text = nested_to_json(exported_customers(spark, sf_dir))
    shaped = conform(text, EXPORT_CUSTOMERS.columns, EXPORT_CUSTOMERS.nested)
    return nested_to_json(shaped).select("customer_id", "name", "address", "phones")
