from __future__ import annotations

import json
import sqlite3
import sys
from contextlib import closing
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oreflow.contracts import ORDERS, PRODUCTS  # noqa: E402
from oreflow.plans.layout import Layout  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("oreflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Project:
    """A project folder and the writers of its landing files."""

    def __init__(self, root: Path):
        self.root, self.layout = root, Layout(str(root))
        self.landing = root / "data" / "landing"
        self.landing.joinpath("orders").mkdir(parents=True)
        self.landing.joinpath("customers").mkdir()

    def orders(self, date: str, rows: list[list], header: list[str] = ORDERS.columns) -> None:
        frame = pd.DataFrame([["" if v is None else str(v) for v in r] for r in rows], columns=header)
        frame.to_csv(self.landing / "orders" / f"orders_{date}.csv", index=False, lineterminator="\n")

    def customers(self, records: list[dict]) -> None:
        with open(self.landing / "customers" / "customers.json", "w") as out:
            json.dump(records, out)

    def products(self, rows: list[tuple]) -> None:
        """The product table as it now is, in a new file."""
        path = self.landing / "products.db"
        path.unlink(missing_ok=True)
        kinds = {f.name: "REAL" if f.kind == "double" else "TEXT" for f in PRODUCTS.fields}
        with closing(sqlite3.connect(path)) as link, link:
            link.execute(f"CREATE TABLE products ({', '.join(f'{n} {k}' for n, k in kinds.items())})")
            link.executemany(f"INSERT INTO products VALUES ({', '.join('?' * len(kinds))})", rows)


CUSTOMER = {
    "customer_id": "C-101",
    "first_name": "Maya",
    "last_name": "Lind",
    "email": "maya@mail.test",
    "address": {"city": "Oslo", "country": "NO"},
    "signup_date": "2023-05-17",
    "tier": "silver",
}
PRODUCT = ("P-1", "Lamp", "Lighting", 10.0, "S-9", "2025-01-01T00:00:00")


@pytest.fixture()
def project(tmp_path):
    made = Project(tmp_path)
    made.customers([CUSTOMER])
    made.products([PRODUCT])
    return made
