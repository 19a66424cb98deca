"""Replace day partitions of a Parquet table.

One day is written to a folder beside the days that no reader sees, and put in the day's place when it is whole. Several
days go through dynamic partition overwrite, which does the same. Either way a failed job leaves the old rows.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from oreflow import fs


def replace_day(df: DataFrame, path: str, date: str, column: str = "date", keep_empty: bool = True) -> int:
    """Make ``df`` the whole content of one day; returns the rows written.

    A day without rows gets a file with no rows, or none with ``keep_empty=False``. Rows are written as they come and
    counted from the footers: a partition column or an observed count would copy each row once more.
    """
    spark, day, draft = df.sparkSession, f"{path}/{column}={date}", f"{path}/_draft-{uuid4().hex}"
    try:
        df.drop(column).write.parquet(draft)
        written = spark.read.parquet(draft).count()
        there = fs.exists(spark, day)
        if written or keep_empty or there:
            if there:
                fs.delete(spark, day)
            fs.move(spark, draft, day)
    finally:
        fs.delete(spark, draft)
    return written


def replace_days(df: DataFrame, path: str, column: str = "date") -> None:
    """Make ``df`` the whole content of every day it has rows for; other days stay.

    Rows are brought together by day so that a day is not spread over a file per task. The
    hint is a request to the adaptive planner, which splits a day that is too large for one
    task and merges small ones.
    """
    _overwrite(df.hint("rebalance", column), path, column)


def _overwrite(df: DataFrame, path: str, column: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)
