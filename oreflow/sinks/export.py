"""Text exports: orders as daily CSV, customers and the fault log as JSON.

An export by day replaces the days it has rows for and leaves all others as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow import fs
from oreflow.session import shared_folder


def write_orders_csv(df: DataFrame, path: str, day: str = "order_date", optional: str = "promotion_code", keep_day: bool = True, gather: bool = True) -> None:
    """CSV with header, one ``date=<day>/`` folder per day, readable as a landing area.

    The optional column is written for the days that use it and for no others, so the header
    widens from day to day as it would file by file. With it, rows are staged by day first: the
    frame is evaluated once, and each of the two writes then reads its own days only. The two
    have no day in common, so a job lost between them leaves whole days, old or new.
    ``keep_day`` says whether the files hold the day column too. ``gather=False`` leaves rows in the tasks that have them, so
    nothing is shuffled and each task may write a file for each day: for frames of a day, whose tasks are large.
    """
    rows = df.withColumn("date", F.col(day).cast("string"))
    rows = rows if keep_day else rows.drop(day)
    if optional not in df.columns:
        _by_day(rows, path, gather)
        return
    spark, staged = df.sparkSession, shared_folder(df.sparkSession, "export-stage")
    rows.hint("rebalance", "date").write.partitionBy("date").parquet(staged)
    stored = spark.read.schema(rows.schema).parquet(staged)
    wide = [r["date"] for r in stored.where(F.col(optional).isNotNull()).select("date").distinct().collect()]  # folder names
    used = F.coalesce(F.col("date").isin(wide), F.lit(False))
    for part in (stored.where(~used).drop(optional), stored.where(used)):
        _by_day(part, path, gather)
    fs.delete(spark, staged)


def _by_day(rows: DataFrame, path: str, gather: bool) -> None:
    rows = rows.select(*[c for c in rows.columns if c != "date"], "date")
    writer = (rows.hint("rebalance", "date") if gather else rows).write.mode("overwrite").partitionBy("date")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines; by day when a day column is given, else the whole folder is replaced."""
    if by is None:
        df.write.mode("overwrite").json(path)
    else:
        writer = df.withColumn("date", F.col(by)).hint("rebalance", "date").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("date").json(path)
