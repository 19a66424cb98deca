"""The data-quality run: put faults into exported data, then report on the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.operators import reports
from oreflow.operators.days import day_range
from oreflow.operators.faults import corrupt_customers, corrupt_orders, fault_plan, inject, replay_log, widen_from
from oreflow.operators.validate import exported_customer_is_bad, exported_order_is_bad
from oreflow.sinks.export import write_json, write_orders_csv
from oreflow.sources.days import DAY, replay

NAMES = ("orders", "customers")
#: Day of the run that a customer belongs to. The sign-up date is a value, and faults change it.
RUN_DAY = "_run_day"


@dataclass(frozen=True)
class QualitySettings:
    """``mode`` None injects no templates; ``drift_after`` None adds no optional column.

    ``templates`` are those of the modes ``fixed`` and ``random``, ``schedule`` the days of ``per_day``.
    """

    start: str
    days: int
    mode: str | None = "random"
    low: int = 1
    high: int = 2
    order_fault_rate: float = 0.05
    customer_fault_rate: float = 0.05
    drift_after: int | None = None
    seed: int = 42
    templates: tuple[str, ...] | None = None
    schedule: Mapping[str, Sequence[str]] | None = None


@dataclass(frozen=True)
class QualityRun:
    """Tables of a run and the reports over them. Reports are lazy."""

    orders: DataFrame
    customers: DataFrame
    log: DataFrame
    plan: DataFrame
    settings: QualitySettings = field(repr=False)

    def summary(self) -> DataFrame:
        """Per day: rows, bad rows and quality of both sources, faults put in, drift, day number."""
        orders = reports.daily_counts(self.orders, "order_date", exported_order_is_bad(), "orders")
        customers = reports.daily_counts(self.customers, RUN_DAY, exported_customer_is_bad(), "customers")
        drift = None
        if "promotion_code" in self.orders.columns:
            drift = reports.drift_flag(self.orders, "order_date", "promotion_code")
        return reports.daily_summary(orders, customers, NAMES, self.plan, drift, self.settings.start).orderBy("date")

    def totals(self) -> DataFrame:
        return reports.totals(self.summary(), NAMES)

    def volumes(self) -> DataFrame:
        return reports.volume_series(self.summary(), NAMES)

    def statuses(self) -> DataFrame:
        return reports.value_counts(self.orders, "status", "status")

    def domains(self) -> DataFrame:
        return reports.domain_counts(self.customers)

    def events_by_template(self) -> DataFrame:
        return reports.events_by_template(self.log)

    def events_by_day(self) -> DataFrame:
        return reports.events_by_day(self.log)

    def events_by_source(self) -> DataFrame:
        return reports.events_by_source(self.log)

    def export(self, path: str) -> None:
        """Daily order CSVs, daily customer JSON and the fault log."""
        write_orders_csv(self.orders, f"{path}/orders")
        write_json(self.customers.withColumnRenamed(RUN_DAY, "date"), f"{path}/customers", by="date")
        write_json(self.log, f"{path}/quarantine_log")


def quality_run(
    orders: DataFrame,
    customers: DataFrame,
    settings: QualitySettings,
    folder: str,
    replayed_orders: DataFrame | None = None,
    replayed_customers: DataFrame | None = None,
    customer_day: str = "signup_date",
) -> QualityRun:
    """Corrupt a share of the rows, add planned faults, replay quarantined rows, keep a log.

    The three tables are written once to ``folder``, on storage all machines share, and the
    reports read them from there: none of them repeats the injection. ``orders`` and
    ``customers`` have the export's columns; replayed rows come from
    :func:`oreflow.sources.days.replay_rows`. Customers are counted, and get faults, on the day that
    ``customer_day`` holds before any fault; it may be a column of its own, ``_run_day`` for one.
    """
    spark, s = orders.sparkSession, settings
    days = day_range(spark, s.start, s.days)
    if s.drift_after is not None:
        orders = widen_from(orders, ["order_id"], "order_date", s.start, s.drift_after, seed=s.seed)
    orders = corrupt_orders(orders, ["order_id"], s.order_fault_rate, s.seed)
    customers = customers.withColumn(RUN_DAY, F.col(customer_day).cast("string"))
    customers = corrupt_customers(customers, ["customer_id"], s.customer_fault_rate, s.seed)
    plan = fault_plan(days, s.mode or "random", s.low, s.high, s.seed, s.templates, s.schedule)
    if s.mode is None:
        plan = plan.limit(0)
    orders, order_log = inject(orders, plan, "order", "order_id", "order_date", s.seed)
    customers, customer_log = inject(customers, plan, "customer", "customer_id", RUN_DAY, s.seed, {"start_date": s.start})
    log = order_log.unionByName(customer_log)
    for rows, kind, day in ((replayed_orders, "order", "order_date"), (replayed_customers, "customer", DAY)):
        if rows is not None:
            log = log.unionByName(replay_log(rows.drop(DAY) if day != DAY else rows, kind, day))
    if replayed_customers is not None:
        replayed_customers = replayed_customers.withColumn(RUN_DAY, F.col(DAY).cast("string"))
    tables = {"orders": replay(orders, replayed_orders), "customers": replay(customers, replayed_customers), "log": log}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
    stored = {name: spark.read.parquet(f"{folder}/{name}") for name in tables}
    return QualityRun(**stored, plan=plan, settings=settings)
