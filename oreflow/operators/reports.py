"""Data-quality and distribution reports.

All of them aggregate before they shuffle anything wide, so a value or day that holds a third
of the rows reaches its reducer as one partial row per map task. Ordering applies to the
aggregated result only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.money import bad_pct, exact_mean, quality_pct
from oreflow.functions.text import email_domain



def value_counts(df: DataFrame, value: str | Column, name: str, count: str = "rows") -> DataFrame:
    """Rows per value, most frequent first."""
    column = F.col(value) if isinstance(value, str) else value
    return df.groupBy(column.alias(name)).agg(F.count("*").alias(count)).orderBy(F.desc(count), name)


def domain_counts(df: DataFrame, email: str = "email") -> DataFrame:
    """Rows per e-mail domain; null addresses are left out."""
    return value_counts(df.where(F.col(email).isNotNull()), email_domain(F.col(email)), "domain")


def mean_price(df: DataFrame, category: str, price: Column) -> DataFrame:
    return df.groupBy(category).agg(exact_mean(price).alias("avg_price")).orderBy(category)


def price_changes(catalogue: DataFrame, updates: DataFrame, key: str, keep: Sequence[str], price: str = "price", new_price: str = "new_price") -> DataFrame:
    """Catalogue rows with an update: the rounded difference and its direction.

    No broadcast hint: the adaptive planner broadcasts the updates when they measure small.
    """
    delta = F.round(F.col(new_price) - F.col(price), 2)
    shown = delta.try_cast("decimal(18,2)").cast("string")
    label = F.concat(F.when(delta > 0, "up +").otherwise("down "), shown)
    joined = catalogue.select(key, *keep, price).join(updates.select(key, new_price), key, "inner")
    return joined.select(key, *keep, price, new_price, label.alias("change"))


def daily_counts(df: DataFrame, day: str, bad: Column, prefix: str) -> DataFrame:
    """Rows, bad rows and quality per day of one source."""
    rows, bad_rows = F.count("*"), F.count_if(bad)
    return df.groupBy(F.col(day).alias("date")).agg(
        rows.alias(prefix),
        bad_rows.alias(f"bad_{prefix}"),
        quality_pct(bad_rows, rows).alias(f"{prefix}_quality_pct"),
    )


def daily_summary(
    left: DataFrame,
    right: DataFrame,
    names: Sequence[str],
    plan: DataFrame | None = None,
    drift: DataFrame | None = None,
    first_day: str | None = None,
) -> DataFrame:
    """Two sources' :func:`daily_counts` side by side.

    Optionally with the day's planned faults, its :func:`drift_flag` and its number counted
    from ``first_day``. A day only one source has counts as zero rows of full quality in the
    other. The fault list is bounded by the plan, which is configuration, not data.
    """
    a, b = names
    joined = left.join(right, "date", "full_outer")
    for n in (a, b):
        joined = joined.withColumns(
            {
                n: F.coalesce(n, F.lit(0).cast("long")),
                f"bad_{n}": F.coalesce(f"bad_{n}", F.lit(0).cast("long")),
                f"{n}_quality_pct": F.coalesce(f"{n}_quality_pct", F.lit(100.0)),
            }
        )
    if plan is not None:
        joined = joined.join(planned_templates(plan), "date", "left").withColumn(
            "injections", F.coalesce("injections", F.lit(""))
        )
    if drift is not None:
        joined = joined.join(drift, "date", "left").withColumn("drift", F.coalesce("drift", F.lit(False)))
    if first_day is not None:
        joined = joined.withColumn("day", F.datediff(F.col("date").cast("date"), F.lit(first_day).cast("date")) + 1)
    return joined


def drift_flag(df: DataFrame, day: str, optional: str) -> DataFrame:
    """Per day, whether any row carries the optional column."""
    return df.groupBy(F.col(day).alias("date")).agg((F.count(optional) > 0).alias("drift"))


def planned_templates(plan: DataFrame) -> DataFrame:
    """Comma-separated template ids per day in plan order."""
    listed = F.array_sort(F.collect_list(F.struct("seq", "template_id")))
    return plan.groupBy("date").agg(
        F.array_join(F.transform(listed, lambda p: p["template_id"]), ", ").alias("injections")
    )


def logged_templates(log: DataFrame) -> DataFrame:
    """Distinct template ids per day from the fault log.

    Events are counted per day and template first, so the list of a day is as long as the
    template catalogue however many events the day has.
    """
    per_template = log.where(F.col("template_id").isNotNull()).groupBy("date", "template_id").agg(F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list("template_id"))
    return per_template.groupBy("date").agg(
        F.array_join(listed, ", ").alias("injections"), F.sum("n").alias("events")
    )


def totals(daily: DataFrame, names: Sequence[str]) -> DataFrame:
    """Overall counts and bad percentages from the daily summary."""
    sums = [F.sum(c).alias(c) for n in names for c in (n, f"bad_{n}")]
    return daily.agg(*sums).select(
        *[c for n in names for c in (F.col(n), F.col(f"bad_{n}"), bad_pct(F.col(f"bad_{n}"), F.col(n)).alias(f"bad_{n}_pct"))]
    )


def volume_series(daily: DataFrame, names: Sequence[str]) -> DataFrame:
    """Volumes and bad counts as series over the days."""
    return daily.select("date", *[c for n in names for c in (n, f"bad_{n}")]).orderBy("date")


def events_by_template(log: DataFrame) -> DataFrame:
    return value_counts(log.where(F.col("template_id").isNotNull()), "template_id", "template_id", "events")


def events_by_day(log: DataFrame) -> DataFrame:
    return log.groupBy("date").agg(F.count("*").alias("events")).orderBy("date")


def events_by_source(log: DataFrame) -> DataFrame:
    """One row: all fault events, those from templates and those replayed from Parquet."""
    return log.agg(
        F.count("*").alias("events"),
        F.count_if(F.col("source") == "template").alias("template_events"),
        F.count_if(F.col("source") == "parquet").alias("parquet_events"),
    )


def run_outcome(runs: DataFrame) -> DataFrame:
    """Runs, failed runs and the exit code of a backfill."""
    failed = F.count_if(F.col("status") != "SUCCESS")
    return runs.agg(F.count("*").alias("runs"), failed.alias("failed"), F.when(failed > 0, 1).otherwise(0).alias("exit_code"))
