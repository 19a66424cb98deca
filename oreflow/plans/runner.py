"""The daily run: nine stages from landing to gold, and the backfill over days.

The driver only decides the order of the stages and moves pointers. Days run one after the
other because the customer history and the product mark depend on the day before; within a
stage the work is one distributed job.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from oreflow import fs
from oreflow.contracts import CUSTOMERS, ORDERS, PRODUCTS, Contract
from oreflow.operators.days import backfill_days
from oreflow.operators.dedup import keep_last
from oreflow.operators.gold import fact_orders, scd1
from oreflow.operators.validate import split
from oreflow.plans.layout import Layout
from oreflow.plans.state import RunState
from oreflow.session import get_session
from oreflow.sinks.partitions import replace_day
from oreflow.sources.landing import ORDINAL, read_customers, read_orders
from oreflow.sources.table import next_mark, read_products

log = logging.getLogger(__name__)

PRODUCT_MARK = "products_updated_at"
Counts = dict[str, int]


class DailyRun:
    """The stages of one processing date. Each returns its row counts."""

    def __init__(self, spark: SparkSession, layout: Layout, date: str, effective_date: str | None = None):
        now = dt.datetime.now(dt.UTC)
        self.spark, self.layout, self.date = spark, layout, date
        self.at = now.isoformat()
        self.effective_date = effective_date or now.date().isoformat()
        self.state = RunState(spark, layout.state)
        self.seen_mark: str | None = None
        self.new_mark: str | None = None
        #: For each silver stage, how often each reason to refuse a row occurred.
        self.reasons: dict[str, Counts] = {}

    # bronze

    def ingest_orders(self) -> Counts:
        rows = read_orders(self.spark, self.layout.landing_orders, self.date, self.at, self.layout.order_multi_line)
        return {"ingested": replace_day(rows, f"{self.layout.bronze}/orders", self.date)}

    def ingest_customers(self) -> Counts:
        layout = self.layout
        rows = read_customers(self.spark, layout.landing_customers, self.at, layout.customer_schema, layout.customer_array)
        return {"ingested": self._bronze("customers").write(rows)}

    def ingest_products(self) -> Counts:
        """Changed products. Without any, bronze keeps the previous delta."""
        since = self.seen_mark = self.state.mark(PRODUCT_MARK)
        rows = read_products(
            self.spark,
            self.layout.product_table or self.layout.landing_products_db,
            since,
            self.at,
            self.layout.inclusive_mark,
            self.layout.product_partitions,
            parquet=self.layout.product_table is not None,
        )
        if rows.isEmpty():
            return {"ingested": 0}
        written = self._bronze("products").write(rows)
        # From what was stored, so that the mark cannot pass a row that came in between.
        self.new_mark = next_mark(self._bronze("products").read(), "updated_at").first()["mark"]
        return {"ingested": written}

    # silver

    def silver_orders(self) -> Counts:
        path = f"{self.layout.bronze}/orders/date={self.date}"
        if not fs.exists(self.spark, path):
            return {}
        contract = ORDERS
        if self.layout.amount_bounds:
            contract = ORDERS.with_amount_bounds(*self.layout.amount_bounds, lambda v: v["quantity"] * v["unit_price"])
        bronze = self.spark.read.parquet(path)
        return self._clean(
            bronze, contract, [ORDINAL], lambda good: replace_day(good, f"{self.layout.silver}/orders", self.date)
        )

    def silver_customers(self) -> Counts:
        return self._silver_snapshot("customers", CUSTOMERS, [ORDINAL])

    def silver_products(self) -> Counts:
        return self._silver_snapshot("products", PRODUCTS, ["updated_at", ORDINAL])

    def _silver_snapshot(self, name: str, contract: Contract, order: list[str]) -> Counts:
        bronze = self._bronze(name)
        if not bronze.exists():
            return {}
        return self._clean(bronze.read(), contract, order, self._silver(name).write)

    def _clean(self, bronze: DataFrame, contract: Contract, order: list[str], sink: Callable[[DataFrame], int]) -> Counts:
        """Bad rows to quarantine; of the good ones the last per key to silver.

        Bronze is stored, so both sides are judged from it; the reasons are counted from the quarantine.
        """
        path = f"{self.layout.quarantine}/{contract.name}"

        def quarantine(bad: DataFrame) -> DataFrame | None:
            some = replace_day(bad, path, self.date, "run_date", keep_empty=False)
            return self.spark.read.schema(bad.schema).parquet(f"{path}/run_date={self.date}") if some else None

        found = split(bronze, contract, quarantined_at=self.at, store=quarantine)
        self.reasons[f"silver_{contract.name}"] = found.reasons
        good = contract.normalize(found.good) if self.layout.normalize else found.good
        written = sink(keep_last(good, contract.key, order))
        return {"quarantined": found.refused, "deduped": found.rows - found.refused - written, "written": written}

    # gold

    def dim_product(self) -> Counts:
        silver, gold = self._silver("products"), self.layout.dim_product(self.spark)
        if not silver.exists() or silver.read().isEmpty():
            return {}
        rows = scd1(None, silver.read(), PRODUCTS.key, self.at, self.layout.product_mode)
        return {"written": gold.upsert(rows) if self.layout.product_mode == "upsert" else gold.write(rows)}

    def dim_customer(self) -> Counts:
        silver, gold = self._silver("customers"), self.layout.dim_customer(self.spark)
        if not silver.exists():
            return {}
        return {"written": gold.merge(silver.read(), self.layout.tracked, self.effective_date)}

    def fact_orders(self) -> Counts:
        path = f"{self.layout.silver}/orders/date={self.date}"
        if not fs.exists(self.spark, path):
            return {}
        rows = fact_orders(self.spark.read.parquet(path))
        return {"written": replace_day(rows, self.layout.fact_orders, self.date)}

    def finish(self) -> None:
        """After all stages: move the mark, drop folders nothing points to any more."""
        if self.new_mark is not None:
            self.state.set_mark(PRODUCT_MARK, self.new_mark, self.seen_mark)
        for table in (
            *[t for n in ("customers", "products") for t in (self._bronze(n), self._silver(n))],
            self.layout.dim_product(self.spark),
            self.layout.dim_customer(self.spark),
        ):
            table.discard_old(self.layout.keep_versions)

    def _bronze(self, name: str):
        return self.layout.snapshot(self.spark, self.layout.bronze, name)

    def _silver(self, name: str):
        return self.layout.snapshot(self.spark, self.layout.silver, name)


# Names of the stages, and below the keys of a run's record.
STAGES = (
    "ingest_orders",
    "ingest_customers",
    "ingest_products",
    "silver_orders",
    "silver_customers",
    "silver_products",
    "dim_product",
    "dim_customer",
    "fact_orders",
)


def run_one_date(spark: SparkSession, layout: Layout, date: str, effective_date: str | None = None) -> dict:
    """All stages of one date. The first failure ends the date; either way it is recorded."""
    run = DailyRun(spark, layout, date, effective_date)
    started, stages, status, error = dt.datetime.now(dt.UTC), [], "SUCCESS", None
    try:
        for name in STAGES if layout.products else [s for s in STAGES if "product" not in s]:
            stages.append(_timed(name, getattr(run, name)))
            if name in run.reasons:
                stages[-1]["reasons"] = run.reasons[name]
            if stages[-1]["status"] == "FAIL":
                status, error = "FAIL", stages[-1]["error"]
                break
        else:
            run.finish()
    except Exception as problem:
        status, error = "FAIL", str(problem)
    finished = dt.datetime.now(dt.UTC)
    result = {
        "date": date,
        "status": status,
        "error": error,
        "started_at": started.isoformat(),
        "finished_at": finished.isoformat(),
        "duration_sec": (finished - started).total_seconds(),
        "stages": stages,
    }
    run.state.record(result)
    log.info("run of %s ended: %s", date, status)
    return result


def _timed(name: str, stage: Callable[[], Counts]) -> dict:
    started, error, counts = dt.datetime.now(dt.UTC), None, {}
    try:
        counts = stage()
    except Exception as problem:
        log.exception("stage %s failed", name)
        error = str(problem)
    took = (dt.datetime.now(dt.UTC) - started).total_seconds()
    return {"stage": name, "status": "FAIL" if error is not None else "OK", "error": error, "duration_sec": took, "counts": counts}


def backfill(spark: SparkSession, layout: Layout, date: str, days_before: int = 0, effective_date: str | None = None) -> list[dict]:
    """The date and the days before it, oldest first. A failed day does not stop the others."""
    return [run_one_date(spark, layout, day, effective_date) for day in backfill_days(date, days_before)]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="oreflow", description="Run the daily medallion flow")
    parser.add_argument("--date", required=True, help="processing date, YYYY-MM-DD")
    parser.add_argument("--backfill", type=int, default=0, help="also process this many days before the date")
    parser.add_argument("--root", default=".", help="project folder with data/ and state/")
    parser.add_argument("--effective-date", default=None, help="date that opens and closes customer versions, today by default")
    args = parser.parse_args(argv)

    results = backfill(get_session(), Layout(args.root), args.date, args.backfill, args.effective_date)
    failed = [r for r in results if r["status"] != "SUCCESS"]
    for r in results:
        line = f"{r['date']} {r['status']} {r['duration_sec']:.2f} s"
        print(line if r not in failed else f"{line}: {r['error']}", file=sys.stderr if r in failed else sys.stdout)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
