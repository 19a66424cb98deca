"""Registry of the queries and the columns they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str


REGISTRY: dict[str, Query] = {}


def query(sql: str) -> Callable[[Run], Run]:
    """Register a function under its own name together with its SQL."""

    def register(run: Run) -> Run:
        REGISTRY[run.__name__] = Query(run.__name__, run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_text(column: str) -> Column:
    """Day of a timestamp as ISO text."""
    return F.col(column).cast("date").cast("string")


def money_text(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").cast("string")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under the column names of the order contract.

    Returned lines get a state the contract does not know. ``_ord`` is the position a landing
    file would give: the table has none, so a total order over its columns stands in.
    """
    lines = table(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "A", "Delivered").when(F.col("l_returnflag") == "N", "shipped")
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("l_suppkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("order_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        status.otherwise("refunded").alias("status"),
        F.struct(*order).alias("_ord"),
    )


# The same columns in SQL, for the queries' counterparts.
ORDER_LINES_SQL = """
SELECT l_orderkey || '-' || l_linenumber AS order_id, CAST(l_suppkey AS VARCHAR) AS customer_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_shipdate AS DATE) AS order_date,
       CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS unit_price,
       CASE l_returnflag WHEN 'A' THEN 'Delivered' WHEN 'N' THEN 'shipped' ELSE 'refunded' END AS status,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag = 'R'
                          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                                   l_extendedprice DESC, l_discount DESC, l_tax DESC, l_linestatus DESC) AS newest
FROM lineitem
"""


def exported_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the text export has them."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "O", "shipped").when(F.col("o_orderstatus") == "F", "delivered")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.substring("o_orderpriority", 1, 1).alias("product_id"),
        day_text("o_orderdate").alias("order_date"),
        money_text("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"),
        status.otherwise("pending").alias("status"),
        F.lit("1").alias("quantity"),
    )


EXPORTED_ORDERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       substr(o_orderpriority, 1, 1) AS product_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, 'USD' AS currency,
       CASE o_orderstatus WHEN 'O' THEN 'shipped' WHEN 'F' THEN 'delivered' ELSE 'pending' END AS status,
       '1' AS quantity
FROM orders
"""


def exported_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the JSON export has them."""
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.col("c_custkey"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")).alias("email"),
        F.lit("2024-01-01").alias("signup_date"),
        F.struct(
            F.lit("").alias("street"),
            F.col("c_mktsegment").alias("city"),
            F.col("c_nationkey").cast("string").alias("state"),
            F.lit("").alias("zip"),
        ).alias("address"),
        F.array(F.concat(F.lit("+1-"), F.col("c_nationkey"))).alias("phones"),
    )


def draw_sql(text: str, slot: int = 0) -> str:
    """SQL of :func:`oreflow.functions.hashing.draw` for seed 42."""
    return f"CAST(('0x' || substr(md5({text} || '|42'), {1 + slot * 8}, 8)) AS BIGINT)"


def pick_sql(values: tuple[str, ...], number: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{listed}], CAST({number} % {len(values)} + 1 AS INTEGER))"
