"""Row contracts: what passes, what does not, and why."""

from __future__ import annotations

import datetime as dt

import pytest

from oreflow.contracts import CUSTOMERS, ORDERS, PRODUCTS
from oreflow.operators.validate import bad_rows, good_rows, judged, split

ORDER = dict(order_id="O1", customer_id="C1", product_id="P1", order_date="2025-01-01", quantity="2", unit_price="3.25", status="shipped")
CUSTOMER = dict(
    customer_id="C1", first_name="Maya", last_name="Lind", email="maya@mail.test",
    city="Oslo", country="NO", signup_date="2024-01-01", tier="gold",
)
PRODUCT = dict(product_id="P1", name="Lamp", category="Tools", unit_cost="10.0", supplier_id="S", updated_at="2025-01-01T00:00:00")
BASE = {"orders": (ORDERS, ORDER), "customers": (CUSTOMERS, CUSTOMER), "products": (PRODUCTS, PRODUCT)}

# contract, changed column, value, expected reason (None: the row is good)
CASES = [
    ("orders", None, None, None),
    ("orders", "order_id", None, "order_id: missing"),
    ("orders", "order_id", "", None),
    ("orders", "customer_id", None, "customer_id: missing"),
    ("orders", "product_id", None, "product_id: missing"),
    ("orders", "order_date", "2025-1-7", "order_date: not an ISO date"),
    ("orders", "order_date", "2025", "order_date: not an ISO date"),
    ("orders", "order_date", "2025-02-30", "order_date: not an ISO date"),
    ("orders", "order_date", "2025-01-07T00:00:00", None),
    ("orders", "order_date", "2025-01-07T10:00:00", "order_date: not an ISO date"),
    ("orders", "order_date", " 2025-01-07", "order_date: not an ISO date"),
    ("orders", "order_date", None, "order_date: missing"),
    ("orders", "quantity", "0", "quantity: must be > 0"),
    ("orders", "quantity", "-1", "quantity: must be > 0"),
    ("orders", "quantity", "2.0", None),
    ("orders", "quantity", " 2 ", None),
    ("orders", "quantity", "2.5", "quantity: not an integer"),
    ("orders", "quantity", "two", "quantity: not an integer"),
    ("orders", "quantity", "2d", "quantity: not an integer"),
    ("orders", "quantity", "inf", "quantity: not an integer"),
    ("orders", "quantity", None, "quantity: missing"),
    ("orders", "quantity", "9007199254740993", None),
    ("orders", "unit_price", "-0.01", "unit_price: must be >= 0"),
    ("orders", "unit_price", "0", None),
    ("orders", "unit_price", None, None),
    ("orders", "unit_price", "inf", None),
    ("orders", "unit_price", "1e2", None),
    ("orders", "unit_price", "0x10", "unit_price: not a number"),
    ("orders", "unit_price", "2d\t", "unit_price: not a number"),
    ("orders", "unit_price", "0x1p3", "unit_price: not a number"),
    ("orders", "unit_price", "1f", "unit_price: not a number"),
    ("orders", "unit_price", "5.", None),
    ("orders", "unit_price", "", "unit_price: not a number"),
    ("orders", "order_date", "2025-01-7 ", "order_date: not an ISO date"),
    ("orders", "order_date", "2025-01-7T", "order_date: not an ISO date"),
    ("orders", "order_date", "+202-01-07", "order_date: not an ISO date"),
    ("orders", "order_date", "12025-1-07", "order_date: not an ISO date"),
    ("orders", "order_date", " 202-01-07", "order_date: not an ISO date"),
    ("orders", "unit_price", "free", "unit_price: not a number"),
    ("orders", "status", "Shipped", None),
    ("orders", "status", "refunded", "status: not one of pending, shipped, delivered, cancelled, returned"),
    ("orders", "status", None, "status: missing"),
    ("customers", None, None, None),
    ("customers", "email", "Maya@Mail.TEST", None),
    ("customers", "email", "not-an-email", "email: has no @"),
    ("customers", "email", None, "email: missing"),
    ("customers", "city", "", None),
    ("customers", "tier", None, None),
    ("customers", "signup_date", "soon", "signup_date: not an ISO date"),
    ("customers", "first_name", None, "first_name: missing"),
    ("products", None, None, None),
    ("products", "unit_cost", "-1.0", "unit_cost: must be >= 0"),
    ("products", "unit_cost", "0.0", None),
    ("products", "unit_cost", None, None),
    ("products", "updated_at", None, "updated_at: missing"),
]


@pytest.fixture(scope="module")
def outcome(spark):
    """Reasons of all cases of a contract, from one job per contract."""
    found = {}
    for name, (contract, base) in BASE.items():
        cases = [(i, c) for i, c in enumerate(CASES) if c[0] == name]
        rows = [{**base, **({c[1]: c[2]} if c[1] else {}), "case": i} for i, c in cases]
        schema = ", ".join(f"{k} string" for k in base) + ", case int"
        df = spark.createDataFrame(rows, schema).coalesce(1)
        good, bad = good_rows(df, contract).collect(), bad_rows(df, contract, "now").collect()
        assert len(good) + len(bad) == len(rows)
        found |= {r.case: r._quarantine_reason for r in bad} | {r.case: None for r in good}
    return found


@pytest.mark.parametrize("number", range(len(CASES)), ids=lambda i: "-".join(map(str, CASES[i][:3])))
def test_case(outcome, number):
    assert outcome[number] == CASES[number][3]


def test_good_rows_are_typed_but_not_normalised(spark):
    df = spark.createDataFrame([ORDER | {"status": "Shipped", "quantity": "9007199254740993", "extra": "x"}])
    row = good_rows(df, ORDERS).first()
    assert (row.quantity, row.unit_price, row.order_date, row.status, row.extra) == (9007199254740993, 3.25, "2025-01-01", "Shipped", "x")


def test_normalised_values(spark):
    orders = spark.createDataFrame([ORDER | {"status": "Shipped"}])
    assert ORDERS.normalize(orders).first().status == "shipped"
    schema = ", ".join(f"{k} string" for k in CUSTOMER)
    customers = spark.createDataFrame([CUSTOMER | {"email": "Maya@Mail.TEST", "tier": None}], schema)
    row = CUSTOMERS.normalize(customers).first()
    assert (row.email, row.tier) == ("maya@mail.test", "standard")


def test_typed_input_needs_no_text(spark):
    rows = [("O1", "C1", "P1", dt.date(2025, 1, 1), 2, float("nan"), "shipped"), ("O2", "C1", "P1", dt.date(2025, 1, 1), 0, 1.0, "shipped")]
    schema = "order_id string, customer_id string, product_id string, order_date date, quantity int, unit_price double, status string"
    df = spark.createDataFrame(rows, schema)
    assert [r.order_id for r in good_rows(df, ORDERS).collect()] == ["O1"]


def test_every_reason_is_given(spark):
    df = spark.createDataFrame([ORDER | {"quantity": "0", "unit_price": "-1", "status": "lost"}])
    assert bad_rows(df, ORDERS).first()._quarantine_reason.split("; ")[:2] == ["quantity: must be > 0", "unit_price: must be >= 0"]


def test_amount_bounds(spark):
    bounded = ORDERS.with_amount_bounds(0.0, 100.0, lambda v: v["quantity"] * v["unit_price"])
    schema = ", ".join(f"{k} string" for k in ORDER)
    rows = [ORDER | {"quantity": q, "unit_price": p} for q, p in (("10", "10"), ("11", "10"), ("1", None))]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    assert [r.quantity for r in good_rows(df, bounded).collect()] == [10, 1]


def test_split_counts_from_what_it_stored_without_a_sort(spark, tmp_path):
    rows = [ORDER, ORDER | {"quantity": "0"}, ORDER | {"quantity": "0", "unit_price": "x"}, ORDER | {"order_id": None}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in ORDER))
    # A lambda would keep Spark from compiling all the errors are made of.
    assert "lambda" not in judged(df, ORDERS)._jdf.queryExecution().optimizedPlan().toString()
    found = split(df, ORDERS, str(tmp_path / "checked"), "now")
    assert (found.rows, found.refused) == (4, 3)
    assert found.reasons == {"order_id: missing": 1, "quantity: must be > 0": 2, "unit_price: not a number": 1}
    assert (found.good.count(), found.bad.count()) == (1, 3)
    # Folders by outcome would have had each task sort its rows.
    assert not [f for f in (tmp_path / "checked").iterdir() if f.is_dir()]
    none = split(df.limit(0), ORDERS, str(tmp_path / "none"))
    assert (none.rows, none.refused, none.reasons, none.good.count(), none.bad.count()) == (0, 0, {}, 0, 0)


def test_equal_messages_of_two_rules_are_both_told(spark):
    from dataclasses import replace

    from oreflow.contracts import RowRule

    twice = replace(ORDERS, row_rules=tuple(RowRule("same", lambda v, n=n: v["quantity"] > n) for n in (5, 6)))
    df = spark.createDataFrame([tuple(ORDER.values())], ", ".join(f"{c} string" for c in ORDER))
    assert bad_rows(df, twice).first()._quarantine_reason == "same; same"
