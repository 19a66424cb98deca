"""End-to-end runs over small landing areas."""

from __future__ import annotations

import pytest
from conftest import CUSTOMER, PRODUCT

from oreflow.contracts import ORDERS
from oreflow.plans.runner import backfill, run_one_date
from oreflow.plans.state import RunState
from oreflow.sinks.snapshots import Snapshot

DATE = "2025-11-07"
ORDER_HEADER = ORDERS.columns


def order(number: int, date: str = DATE, quantity: str = "2", price: str = "12.40", status: str = "shipped") -> list[str]:
    return [f"N-{number:03d}", "C-101", "P-1", date, quantity, price, status]


def fact(spark, project, date=DATE):
    return spark.read.parquet(f"{project.layout.fact_orders}/date={date}")


def quarantined(spark, project, source="orders", date=DATE):
    return spark.read.parquet(f"{project.layout.quarantine}/{source}/run_date={date}")


def stage(result, name):
    return next(s for s in result["stages"] if s["stage"] == name)


def test_happy_path(spark, project):
    project.orders(DATE, [order(1), order(2, quantity="1", status="delivered"), order(3, status="pending")])
    result = run_one_date(spark, project.layout, DATE)
    assert result["status"] == "SUCCESS", result["error"]
    assert len(result["stages"]) == 9
    assert fact(spark, project).count() == 3


def test_total_amount(spark, project):
    project.orders(DATE, [order(1, quantity="4", price="12.50")])
    run_one_date(spark, project.layout, DATE)
    row = fact(spark, project).first()
    assert row.total_amount == pytest.approx(50.0)
    assert row.order_date.isoformat() == "2025-11-07T00:00:00"
    assert not [c for c in row.asDict() if c.startswith("_")]


def test_duplicates_collapse_and_last_wins(spark, project):
    project.orders(DATE, [order(1, quantity="2"), order(1, quantity="5")])
    result = run_one_date(spark, project.layout, DATE)
    silver = spark.read.parquet(f"{project.layout.silver}/orders/date={DATE}").collect()
    assert [r.quantity for r in silver] == [5]
    assert fact(spark, project).count() == 1
    assert stage(result, "silver_orders")["counts"] == {"quarantined": 0, "deduped": 1, "written": 1}


def test_judged_rows_are_not_stored_besides_silver_and_quarantine(spark, project):
    project.orders(DATE, [order(1), order(1, quantity="0"), order(2, quantity="0", price="x"), order(3), order(3)])
    result = run_one_date(spark, project.layout, DATE)
    assert stage(result, "silver_orders")["counts"] == {"quarantined": 2, "deduped": 1, "written": 2}
    assert stage(result, "silver_orders")["reasons"] == {"quantity: must be > 0": 2, "unit_price: not a number": 1}
    assert quarantined(spark, project).count() == 2
    assert sorted(f.name for f in (project.root / "data").iterdir()) == ["bronze", "gold", "landing", "quarantine", "silver"]


def test_later_bad_duplicate_does_not_replace_good_row(spark, project):
    project.orders(DATE, [order(1, quantity="2"), order(1, quantity="0")])
    run_one_date(spark, project.layout, DATE)
    assert [r.quantity for r in fact(spark, project).collect()] == [2]
    assert quarantined(spark, project).count() == 1


def test_bad_rows_go_to_quarantine_with_reason(spark, project):
    project.orders(DATE, [order(1), order(2, quantity="0"), order(3, quantity="-1", status="refunded")])
    result = run_one_date(spark, project.layout, DATE)
    assert result["status"] == "SUCCESS"
    bad = {r.order_id: r._quarantine_reason for r in quarantined(spark, project).collect()}
    assert bad["N-002"] == "quantity: must be > 0"
    assert bad["N-003"].startswith("quantity: must be > 0; status: not one of")
    assert [r.order_id for r in fact(spark, project).collect()] == ["N-001"]
    assert stage(result, "ingest_orders")["counts"] == {"ingested": 3}


def test_additive_drift_keeps_the_column(spark, project, caplog):
    project.orders(DATE, [[*order(1), "web"]], [*ORDER_HEADER, "channel"])
    result = run_one_date(spark, project.layout, DATE)
    assert result["status"] == "SUCCESS"
    assert [r.channel for r in fact(spark, project).collect()] == ["web"]
    assert "channel" in caplog.text


@pytest.mark.parametrize("gone", [["unit_price"], ["product_id", "unit_price"]])
def test_subtractive_drift_fails_and_names_columns(spark, project, gone):
    keep = [i for i, c in enumerate(ORDER_HEADER) if c not in gone]
    project.orders(DATE, [[order(1)[i] for i in keep]], [ORDER_HEADER[i] for i in keep])
    result = run_one_date(spark, project.layout, DATE)
    assert result["status"] == "FAIL"
    assert "missing" in result["error"] and all(c in result["error"] for c in gone)
    assert len(result["stages"]) == 1


def test_columns_are_taken_by_name_not_position(spark, project):
    flipped = [6, 5, 4, 3, 2, 1, 0]
    project.orders(DATE, [[order(1)[i] for i in flipped]], [ORDER_HEADER[i] for i in flipped])
    run_one_date(spark, project.layout, DATE)
    row = fact(spark, project).first()
    assert (row.order_id, row.quantity, row.status) == ("N-001", 2, "shipped")


def test_rerun_is_a_no_op(spark, project):
    project.orders(DATE, [order(1), order(2, quantity="1"), order(3, quantity="0")])
    run_one_date(spark, project.layout, DATE)
    first = sorted(fact(spark, project).collect())
    history = sorted(map(str, project.layout.dim_customer(spark).read().collect()))
    run_one_date(spark, project.layout, DATE)
    assert sorted(fact(spark, project).collect()) == first
    assert quarantined(spark, project).count() == 1
    assert sorted(map(str, project.layout.dim_customer(spark).read().collect())) == history


def test_rerun_with_only_bad_rows_empties_the_day(spark, project):
    project.orders(DATE, [order(1)])
    project.orders("2025-11-08", [order(9, date="2025-11-08")])
    backfill(spark, project.layout, "2025-11-08", 1)
    project.orders(DATE, [order(1, quantity="0")])
    assert run_one_date(spark, project.layout, DATE)["status"] == "SUCCESS"
    assert fact(spark, project).count() == 0
    assert spark.read.parquet(project.layout.fact_orders).count() == 1


def test_backfill_equals_single_runs(spark, project):
    days = ["2025-11-07", "2025-11-08", "2025-11-09"]
    for d in days:
        project.orders(d, [[f"N-{d[-2:]}", *order(1, date=d)[1:]]])
    results = backfill(spark, project.layout, days[-1], 2)
    assert [r["date"] for r in results] == days
    for d in days:
        assert fact(spark, project, d).count() == 1


def test_failed_day_does_not_stop_backfill_and_is_recorded(spark, project):
    project.orders("2025-11-07", [order(1)])
    project.orders("2025-11-09", [order(2, date="2025-11-09")])
    results = backfill(spark, project.layout, "2025-11-09", 2)
    assert [r["status"] for r in results] == ["SUCCESS", "FAIL", "SUCCESS"]
    assert "not found" in results[1]["error"]
    runs = RunState(spark, project.layout.state).history()
    assert {(r.date, r.status) for r in runs.collect()} == {(r["date"], r["status"]) for r in results}
    from oreflow.operators.reports import run_outcome

    assert run_outcome(runs).first().asDict() == {"runs": 3, "failed": 1, "exit_code": 1}


def test_missing_sources(spark, project):
    project.orders(DATE, [order(1)])
    (project.root / "data/landing/products.db").unlink()
    result = run_one_date(spark, project.layout, DATE)
    assert result["status"] == "FAIL" and "database not found" in result["error"]
    (project.root / "data/landing/customers/customers.json").unlink()
    assert "customers file not found" in run_one_date(spark, project.layout, DATE)["error"]


def test_customer_quarantine_and_missing_address(spark, project):
    bare = {k: v for k, v in CUSTOMER.items() if k not in ("address", "tier")} | {"customer_id": "C-102"}
    bad = CUSTOMER | {"customer_id": "C-103", "email": "nobody"}
    project.customers([CUSTOMER, bare, bad])
    project.orders(DATE, [order(1)])
    assert run_one_date(spark, project.layout, DATE)["status"] == "SUCCESS"
    rows = {r.customer_id: r for r in project.layout.dim_customer(spark).read().collect()}
    assert set(rows) == {"C-101", "C-102"}
    assert (rows["C-102"].city, rows["C-102"].country, rows["C-102"].tier) == ("", "", None)
    assert quarantined(spark, project, "customers").first()._quarantine_reason == "email: has no @"


def test_customer_history(spark, project):
    layout = project.layout
    second = CUSTOMER | {"customer_id": "C-102", "first_name": "Ivo", "email": "ivo@mail.test"}
    third = CUSTOMER | {"customer_id": "C-103"}
    project.orders(DATE, [order(1)])
    project.customers([CUSTOMER, second])
    run_one_date(spark, layout, DATE, "2025-11-07")
    moved = CUSTOMER | {"address": {"city": "Bergen", "country": "NO"}}
    renamed = second | {"first_name": "Ivan", "tier": "silver"}
    project.customers([moved, renamed, third])
    run_one_date(spark, layout, DATE, "2025-11-08")
    project.customers([third])
    run_one_date(spark, layout, DATE, "2025-11-09")

    rows = layout.dim_customer(spark).read()
    found = {(r.customer_id, r.city, r.first_name, r._eff_start, r._eff_end, r._current) for r in rows.collect()}
    assert found == {
        ("C-101", "Oslo", "Maya", "2025-11-07", "2025-11-08", False),
        ("C-101", "Bergen", "Maya", "2025-11-08", "9999-12-31", True),
        ("C-102", "Oslo", "Ivo", "2025-11-07", "9999-12-31", True),
        ("C-103", "Oslo", "Maya", "2025-11-08", "9999-12-31", True),
    }
    assert layout.dim_customer(spark).read_open().where("not _current").count() == 0


@pytest.mark.parametrize(("mode", "left"), [("upsert", {"P1": 4.5, "P2": 2.0, "P3": 3.0}), ("replace", {"P1": 4.5, "P3": 3.0})])
def test_products_load_incrementally(spark, project, mode, left):
    from dataclasses import replace

    layout = replace(project.layout, product_mode=mode)
    project.orders(DATE, [order(1)])
    project.products([("P1", "a", "c", 1.0, "S", "2025-01-01T00:00:00"), ("P2", "b", "c", 2.0, "S", "2025-01-02T00:00:00")])
    first = run_one_date(spark, layout, DATE)
    assert stage(first, "ingest_products")["counts"] == {"ingested": 2}
    state = RunState(spark, layout.state)
    assert state.mark("products_updated_at") == "2025-01-02T00:00:00"
    project.products(
        [
            ("P1", "a", "c", 4.0, "S", "2025-01-03T00:00:00"),
            ("P1", "a", "c", 4.5, "S", "2025-01-04T00:00:00"),
            ("P2", "b", "c", 2.0, "S", "2025-01-02T00:00:00"),
            ("P3", "d", "c", 3.0, "S", "2025-01-03T12:00:00"),
        ]
    )
    second = run_one_date(spark, layout, DATE)
    assert stage(second, "ingest_products")["counts"] == {"ingested": 3}
    assert state.mark("products_updated_at") == "2025-01-04T00:00:00"
    gold = {r.product_id: r.unit_cost for r in layout.dim_product(spark).read().collect()}
    assert gold == left
    third = run_one_date(spark, layout, DATE)
    assert stage(third, "ingest_products")["counts"] == {"ingested": 0}
    assert {r.product_id: r.unit_cost for r in layout.dim_product(spark).read().collect()} == left


def test_mark_stays_when_a_later_stage_fails(spark, project, monkeypatch):
    from oreflow.plans.runner import DailyRun

    project.orders(DATE, [order(1)])

    def broken(self):
        raise RuntimeError("gold is down")

    with monkeypatch.context() as patch:
        patch.setattr(DailyRun, "fact_orders", broken)
        assert run_one_date(spark, project.layout, DATE)["status"] == "FAIL"
    state = RunState(spark, project.layout.state)
    assert state.mark("products_updated_at") is None
    assert run_one_date(spark, project.layout, DATE)["status"] == "SUCCESS"
    assert state.mark("products_updated_at") == PRODUCT[-1]


def test_normalize_and_amount_bounds_are_optional(spark, project):
    from dataclasses import replace

    project.customers([CUSTOMER | {"email": "Maya@Mail.TEST", "tier": None}])
    project.orders(DATE, [order(1, status="Shipped"), order(2, quantity="1000", price="1000")])
    run_one_date(spark, project.layout, DATE)
    assert {r.status for r in fact(spark, project).collect()} == {"Shipped", "shipped"}
    layout = replace(project.layout, normalize=True, amount_bounds=(0.0, 100000.0), paths={"gold": f"{project.root}/gold2"})
    run_one_date(spark, layout, DATE)
    kept = spark.read.parquet(f"{layout.fact_orders}/date={DATE}").collect()
    assert [(r.order_id, r.status) for r in kept] == [("N-001", "shipped")]
    assert "amount: not in" in quarantined(spark, project).first()._quarantine_reason
    customer = layout.dim_customer(spark).read().first()
    assert (customer.email, customer.tier) == ("maya@mail.test", "standard")


def test_old_snapshot_folders_are_dropped(spark, tmp_path):
    table = Snapshot(spark, str(tmp_path / "t"))
    assert not table.exists()
    for n in range(5):
        assert table.write(spark.range(n + 1)) == n + 1
    table.discard_old(keep=2)
    assert table.read().count() == 5
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["v4", "v5"]


def test_command_line(spark, project, capsys):
    from oreflow.plans.runner import main

    project.orders(DATE, [order(1)])
    assert main(["--date", DATE, "--root", str(project.root)]) == 0
    assert main(["--date", "2025-11-08", "--backfill", "1", "--root", str(project.root)]) == 1
    assert "2025-11-07 SUCCESS" in capsys.readouterr().out
