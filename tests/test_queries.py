"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as spark_entry
from compare import compare, connect

from oreflow.plans.star import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def link():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, link, name):
    run, sql = spark_entry.queries()[name], spark_entry.oracle_sql()[name]
    problem, _, rows = compare(spark, link, name, run, sql, SF_DIR)
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["status", "orders", "total_amount"]


WRITING = {"pipeline_fact", "pipeline_quarantine", "pipeline_dim_customer", "pipeline_run_history", "pipeline_products_and_drift", "export_two_days", "export_customer_days", "partition_replace", "replay_files", "replay_limit", "export_orders_csv", "export_customers_json", "scd2_stored", "scd2_as_of", "quality_by_day"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITING))
def test_plan_has_no_pairing_and_no_python(spark, name):
    """No cross or nested-loop join and no Python node."""
    plan = spark_entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas", "BatchEvalPython"):
        assert unwanted not in plan


def test_backfill_prunes_by_day(spark):
    plan = spark_entry.queries()["backfill_range"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and plan.count("FileScan") == 1
