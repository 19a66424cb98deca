"""Where things are. Every path may be on any file system Spark can reach."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from oreflow.contracts import CUSTOMERS, PRODUCTS
from oreflow.operators.gold import TRACKED
from oreflow.sinks.buckets import Buckets
from oreflow.sinks.snapshots import History, Snapshot


@dataclass(frozen=True)
class Layout:
    """Folders of one project and the settings of its run.

    ``paths`` overrides single folders by name (``landing_orders``, ``bronze``, ...).
    """

    root: str
    paths: dict[str, str] = field(default_factory=dict)
    tracked: tuple[str, ...] = TRACKED
    normalize: bool = False
    product_mode: str = "upsert"
    amount_bounds: tuple[float, float] | None = None
    inclusive_mark: bool = False
    product_partitions: int = 1
    product_table: str | None = None  # a Parquet folder, read instead of the database file
    product_buckets: int = 16  # of the product dimension, when it is first written
    customer_buckets: int = 16  # of the customer history's open rows, when it is first written
    customer_schema: str | None = None
    customer_array: bool = True  # one JSON array per file, or else JSON lines
    keep_versions: int = 2
    products: bool = True  # without a product table its stages are left out
    order_multi_line: bool = True  # quoted line ends in order files

    def at(self, name: str, default: str) -> str:
        return self.paths.get(name, f"{self.root.rstrip('/')}/{default}")

    @property
    def landing_orders(self) -> str:
        return self.at("landing_orders", "data/landing/orders")

    @property
    def landing_customers(self) -> str:
        return self.at("landing_customers", "data/landing/customers")

    @property
    def landing_products_db(self) -> str:
        return self.at("landing_products_db", "data/landing/products.db")

    @property
    def bronze(self) -> str:
        return self.at("bronze", "data/bronze")

    @property
    def silver(self) -> str:
        return self.at("silver", "data/silver")

    @property
    def gold(self) -> str:
        return self.at("gold", "data/gold")

    @property
    def quarantine(self) -> str:
        return self.at("quarantine", "data/quarantine")

    @property
    def state(self) -> str:
        return self.at("state", "state")

    @property
    def fact_orders(self) -> str:
        return f"{self.gold}/fact_orders"

    def snapshot(self, spark: SparkSession, layer: str, name: str) -> Snapshot:
        return Snapshot(spark, f"{layer}/{name}")

    def dim_product(self, spark: SparkSession) -> Buckets:
        return Buckets(spark, f"{self.gold}/dim_product", PRODUCTS.key, self.product_buckets)

    def dim_customer(self, spark: SparkSession) -> History:
        return History(spark, f"{self.gold}/dim_customer", CUSTOMERS.key, self.customer_buckets)
