"""Session and the shared work folder."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def get_session(name: str = "oreflow") -> SparkSession:
    """The running session, or a new one from the submit-time settings.

    Settings that depend on the cluster (executors, memory, shuffle partitions) are left to
    ``spark-submit``. Adaptive execution is on by default in Spark and everything here relies
    on it: it sizes shuffle partitions, picks broadcasts by measured size and splits skew.
    """
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the one the cluster shares between its machines.

    That is ``spark.checkpoint.dir``. A machine-local folder stands in only in local mode.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all machines share")
        base = tempfile.mkdtemp(prefix="oreflow-")
    return f"{base.rstrip('/')}/{purpose}-{uuid4().hex}"


def stored_once(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in a new shared folder: computed once, however often it is read and whatever is lost."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
