"""Day sets: ranges, selection, what two sources have in common."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def backfill_days(target: str, days_before: int) -> list[str]:
    """The target day and the days before it, oldest first."""
    first = dt.date.fromisoformat(target) - dt.timedelta(days=days_before)
    return [(first + dt.timedelta(days=n)).isoformat() for n in range(days_before + 1)]


def day_range(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days`` consecutive days from ``start``: ``date``, ``day_index`` (from 0) and ``n_days``."""
    return spark.range(days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).cast("string").alias("date"),
        F.col("id").cast("int").alias("day_index"),
        F.lit(days).alias("n_days"),
    )


def days_covered(df: DataFrame, day: Column) -> DataFrame:
    """Every day between the first and the last one in ``df``, as :func:`day_range`."""
    bounds = df.select(day.alias("d")).agg(F.min("d").alias("first"), F.max("d").alias("last"))
    months = F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), F.expr("INTERVAL 1 MONTH"))
    # One row a month is dealt out before it becomes days, as one stray date can make the range long.
    dealt = bounds.select("first", "last", F.explode(months).alias("month")).repartition("month")
    within_month = F.sequence(F.greatest("month", "first"), F.least(F.last_day("month"), "last"))
    return dealt.select("first", "last", F.explode(within_month).alias("date")).select(
        F.col("date").cast("string").alias("date"),
        F.datediff("date", "first").alias("day_index"),
        (F.datediff("last", "first") + 1).alias("n_days"),
    )


def days_before(df: DataFrame, day: Column, count: int) -> DataFrame:
    """The last day in ``df`` and the ``count`` days before it, ascending."""
    last = df.agg(F.max(day).alias("last"))
    return last.select(F.explode(F.sequence(F.date_sub("last", count), F.col("last"))).alias("date"))


def common_days(available: DataFrame, wanted: DataFrame, column: str = "date") -> DataFrame:
    """Available days that lie in the wanted set."""
    return available.select(column).distinct().join(wanted.select(column), column, "left_semi")


def absent_days(wanted: DataFrame, available: DataFrame, column: str = "date") -> DataFrame:
    """Wanted days that are not available."""
    return wanted.select(column).distinct().join(available.select(column), column, "left_anti")


def either_days(left: DataFrame, right: DataFrame, column: str = "date") -> DataFrame:
    """Days in either source and which of the two has them."""
    a = left.select(column).distinct().withColumn("in_left", F.lit(True))
    b = right.select(column).distinct().withColumn("in_right", F.lit(True))
    return a.join(b, column, "full_outer").select(
        column,
        F.coalesce("in_left", F.lit(False)).alias("in_left"),
        F.coalesce("in_right", F.lit(False)).alias("in_right"),
    )


def all_days(left: DataFrame, right: DataFrame, column: str = "date") -> DataFrame:
    """Union of two day sets."""
    return left.select(column).union(right.select(column)).distinct()


def on_day(df: DataFrame, column: str, day: str | None) -> DataFrame:
    """Rows of one day, all rows for None.

    A timestamp is compared with the bounds of the day, not cast to a date, so that the filter
    reaches the file statistics.
    """
    return df if day is None else within(df, column, day, day)


def within(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows from the first to the last day, both included, by bounds that reach the file statistics."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
        return df.where((F.col(column) >= start.cast(kind)) & (F.col(column) < F.date_add(end, 1).cast(kind)))
    return df.where(F.col(column).between(F.lit(first).cast(kind), F.lit(last).cast(kind)))


def select_days(available: Sequence[str], selection: str | Sequence[str], run_days: Sequence[str] = ()) -> list[str]:
    """Partition days to use: ``all``, ``match`` (inside the run) or an explicit list.

    Works on partition names, one per day, that the caller has listed; no data is read.
    """
    if selection == "all":
        return sorted(available)
    if selection == "match":
        return sorted(set(available) & set(run_days))
    if isinstance(selection, str):
        raise ValueError(f"selection must be 'all', 'match' or a list of days, got {selection!r}")
    missing = sorted(set(selection) - set(available))
    if missing:
        log.warning("requested days are not available: %s", missing)
    return sorted(set(selection) & set(available))
