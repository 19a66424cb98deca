"""Incremental scan of a database table: rows whose cursor column lies past a mark.

``jdbc`` serves server databases. For a SQLite file there is no driver among Spark's own jars,
hence the Python data source in :mod:`oreflow.sources.sqlite`. Either way the mark is part of
the source's own query, so rows before it never leave the database.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow import fs
from oreflow.contracts import PRODUCTS
from oreflow.errors import IngestionError
from oreflow.operators.drift import require_columns
from oreflow.operators.shape import with_lineage
from oreflow.sources.landing import ORDINAL
from oreflow.sources.sqlite import SqliteTable

FIRST_MARK = "1970-01-01T00:00:00"

def read_sqlite(
    spark: SparkSession, path: str, table: str, cursor: str | None = None, since: str | None = None, inclusive: bool = False, partitions: int = 1
) -> DataFrame:
    """Rows of a SQLite table, past ``since`` when given."""
    # A mounted file, whatever Spark's default file system is.
    if not os.path.exists(path.removeprefix("file:")):
        raise IngestionError(f"database not found: {path}")
    spark.dataSource.register(SqliteTable)
    reader = spark.read.format("sqlite_table").options(path=path, table=table, partitions=str(partitions))
    if since is not None:
        reader = reader.options(cursor=cursor, since=since, inclusive=str(inclusive).lower())
    return reader.load()


def read_jdbc(
    spark: SparkSession, url: str, table: str, cursor: str, since: str, inclusive: bool = False, **options: str
) -> DataFrame:
    """Rows of a server table past ``since``; Spark pushes the comparison into the query.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read a
    large delta in parallel; without them one task reads it all.
    """
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return newer_than(rows, cursor, since, inclusive)


def newer_than(df: DataFrame, cursor: str, since: object, inclusive: bool = False) -> DataFrame:
    """Rows past the mark. Strict by default, so a late row equal to the mark is not seen;
    ``inclusive`` reads the mark's own rows again, which an upsert absorbs."""
    return df.where(F.col(cursor) >= since if inclusive else F.col(cursor) > since)


def past_mark(df: DataFrame, cursor: str, key: str, mark: tuple | None) -> DataFrame:
    """Rows past a compound mark, the (cursor, key) of the last row read; all that have a cursor without a mark.

    Rows of the mark's own time are neither missed nor read twice. The plain bound on the cursor stands first, so
    that the scan can leave out files by it.
    """
    if mark is None:
        return df.where(F.col(cursor).isNotNull())
    time, last = mark
    return df.where(F.col(cursor) >= time).where((F.col(cursor) > time) | (F.col(key) > last))


def next_compound_mark(df: DataFrame, cursor: str, key: str) -> DataFrame:
    """Highest (cursor, key) as one row ``mark`` (a struct), the compound mark of the next run; null without rows."""
    seen = df.where(F.col(cursor).isNotNull())
    return seen.agg(F.max(F.struct(F.col(cursor).alias("cursor"), F.col(key).alias("key"))).alias("mark"))


def next_mark(df: DataFrame, cursor: str) -> DataFrame:
    """Highest cursor value, the mark of the next run; one row."""
    return df.agg(F.max(cursor).alias("mark"))


def read_products(
    spark: SparkSession, path: str, since: str | None, ingested_at: str, inclusive: bool = False, partitions: int = 1, parquet: bool = False
) -> DataFrame:
    """Products changed since the mark, with lineage and their place in the table.

    The place decides between two changes of a product at the same time. ``path`` is a SQLite file or, with
    ``parquet``, a Parquet folder, of which the mark leaves out row groups by their bounds.
    """
    since = since or FIRST_MARK
    if parquet:
        if not fs.exists(spark, path):
            raise IngestionError(f"table not found: {path}")
        rows = spark.read.parquet(path)
        require_columns(rows, PRODUCTS.columns, "products")
        rows = newer_than(rows, "updated_at", since, inclusive)
    else:
        rows = read_sqlite(spark, path, "products", "updated_at", since, inclusive, partitions)
        require_columns(rows, PRODUCTS.columns, "products")
    return with_lineage(rows.withColumn(ORDINAL, F.monotonically_increasing_id()), ingested_at)
