"""Parquet laid out by day, as a quarantine is, and its replay into a run."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oreflow import fs
from oreflow.functions.text import folder_regex
from oreflow.operators.days import select_days
from oreflow.operators.shape import conform, rename, stamp_date

DAY = "_day"


def available_days(spark: SparkSession, base: str, pattern: str = "dt={date}") -> list[str]:
    """Days that have a folder; only folder names are listed."""
    import datetime as dt

    found = []
    for name in fs.folders(spark, base):
        match = re.match(folder_regex(pattern), name)
        try:
            if match and dt.date.fromisoformat(match[1]):
                found.append(match[1])
        except ValueError:
            continue
    return sorted(found)


def _folders(base: str, days: Sequence[str], pattern: str) -> list[str]:
    return [f"{base}/{pattern.replace('{date}', d)}" for d in days]


def unread_files(spark: SparkSession, base: str, days: Sequence[str], pattern: str = "dt={date}") -> DataFrame:
    """Files of the given days that ``skip_unreadable`` leaves out, wholly: ``path``. Files without rows are in it too."""
    folders = _folders(base, days, pattern)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders).select("path")
    rows = read_days(spark, base, days, pattern, skip_unreadable=True, keep_file=True)
    return listed.join(rows.select(F.col("_file").alias("path")).distinct(), "path", "left_anti")


def read_days(
    spark: SparkSession, base: str, days: Sequence[str], pattern: str = "dt={date}", max_rows: int | None = None, skip_unreadable: bool = False, keep_file: bool = False
) -> DataFrame | None:
    """All Parquet files of the given days in one scan, in sub-folders as well; None for no days.

    A file that cannot be read is an error, unless ``skip_unreadable`` is asked for;
    :func:`unread_files` names what that leaves out. Files may differ in columns. ``max_rows`` keeps the
    first rows of each day over its files in name order. A row's place in its day is the number
    of rows in the files before its own plus its index in the file, so the cut needs no sort and
    no shuffle of the rows: only the row count of each file is gathered, from the file footers.
    """
    if not days:
        return None
    reader = spark.read.option("ignoreCorruptFiles", skip_unreadable).option("mergeSchema", True)
    reader = reader.option("recursiveFileLookup", True)
    rows = reader.parquet(*_folders(base, days, pattern))
    # The first folder of the path, below the base, that holds a day: a file may lie deeper.
    level = F.filter(F.split(F.col("_metadata.file_path"), "/"), lambda part: part.rlike(folder_regex(pattern)))
    rows = rows.select(
        "*",
        F.regexp_extract(F.element_at(level, 1), folder_regex(pattern), 1).alias(DAY),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    if max_rows:
        before = Window.partitionBy(DAY).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        sizes = rows.groupBy(DAY, "_file").agg(F.count("*").alias("_n"))
        starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
        starts = starts.where(F.col("_start") < max_rows)
        # No file gives more than max_rows, which leaves little for the join to move.
        rows = rows.where(F.col("_index") < max_rows).join(starts, "_file")
        rows = rows.where(F.col("_start") + F.col("_index") < max_rows).drop("_start")
    return rows.drop("_index") if keep_file else rows.drop("_file", "_index")


def replay_rows(
    spark: SparkSession,
    base: str,
    run_days: Sequence[str],
    expected: Sequence[str],
    selection: str | Sequence[str] = "all",
    pattern: str = "dt={date}",
    max_rows: int | None = None,
    names: Mapping[str, str] | None = None,
    date_column: str | None = "order_date",
    nested: Mapping[str, str] | None = None,
    skip_unreadable: bool = False,
) -> DataFrame | None:
    """Quarantined rows to put into the days of a run, in the shape the run expects.

    Only days of the run are replayed, all their rows unless ``max_rows`` is set. Rows take the
    folder's day as their date.
    """
    chosen = select_days(available_days(spark, base, pattern), selection, run_days)
    days = sorted(set(chosen) & set(run_days))
    rows = read_days(spark, base, days, pattern, max_rows, skip_unreadable)
    if rows is None:
        return None
    renamed = rename(rows, names or {})
    shaped = conform(renamed, [*expected, DAY], nested)
    return stamp_date(shaped, date_column, F.col(DAY)) if date_column else shaped


def replay(rows: DataFrame, *replayed: DataFrame | None) -> DataFrame:
    """A run's rows together with what is replayed into it."""
    return reduce(lambda a, b: a.unionByName(b.drop(DAY), allowMissingColumns=True), [r for r in replayed if r is not None], rows)
