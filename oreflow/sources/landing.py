"""Landing files: daily order CSVs and the customer JSON export.

Everything is read as text; the contract decides later what a value means. Each reader adds
``_ord``, the position of the row in its file, because keep-last needs the file order and a
shuffle would lose it. Files are split as usual: (file, block, running id) rises with the
file order inside every split and across splits. Bronze stores the column, so from there on
it is plain data and a recomputed task cannot change it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow import fs
from oreflow.contracts import CUSTOMERS, MALFORMED, ORDERS
from oreflow.errors import IngestionError
from oreflow.functions.parsing import blank_missing
from oreflow.operators.drift import require_columns
from oreflow.operators.shape import flatten, with_lineage
from oreflow.session import stored_once
from oreflow.sources.records import any_leaves_open, records, text_lines

ORDINAL = "_ord"


def _with_ordinal(df: DataFrame) -> DataFrame:
    """Text columns plus the row's place in its file and the file's name."""
    place = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias(ORDINAL), F.col("_metadata.file_name").alias("_source_file"))


def _first_existing(spark: SparkSession, paths: list[str], what: str) -> str:
    for path in paths:
        if fs.exists(spark, path):
            return path
    raise IngestionError(f"{what} not found: {paths[0]}")


def read_orders(spark: SparkSession, landing: str, date: str, ingested_at: str, multi_line: bool = True) -> DataFrame:
    """One day's orders: ``orders_<date>.csv`` (file or folder of parts) or ``date=<date>/``.

    Columns are taken by the header's names. A part file whose header differs is an error, so that no values
    are shifted. A row with more or fewer fields than the header keeps its text in ``_malformed``, by which the
    contract refuses it.

    Files are split among tasks as usual. Where some line leaves a quote open, for which one pass over the text
    looks, records are made of lines by ``sources.records``: values may hold line ends, and a quote that
    never closes spoils its own record only. ``multi_line=False`` takes each line as a record.
    """
    path = _first_existing(spark, [f"{landing}/orders_{date}.csv", f"{landing}/date={date}"], "orders file")
    reader = spark.read.options(header=True, escape='"')
    header = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, MALFORMED)])
    require_columns(spark.createDataFrame([], schema).drop(MALFORMED), ORDERS.columns, "orders")
    lines = text_lines(spark, path)
    if multi_line and any_leaves_open(lines):
        stored = stored_once(lines, "landing-lines")
        parsed = F.from_csv("value", schema.toDDL(), {"escape": '"', "columnNameOfCorruptRecord": MALFORMED})
        place = F.struct(F.col("name").alias("file"), "block", F.col("at").alias("row"))
        rows = records(stored, len(header)).select(parsed.alias("row"), place.alias(ORDINAL), F.col("name").alias("_source_file")).select("row.*", ORDINAL, "_source_file")
    else:
        reader = reader.options(enforceSchema=False, columnPruning=False, columnNameOfCorruptRecord=MALFORMED)
        rows = _with_ordinal(reader.schema(schema).csv(path))
    rows = rows.withColumns({c: blank_missing(F.col(f"`{c}`")) for c in header})
    return with_lineage(rows, ingested_at, F.col("_source_file"), date)


def read_customers(
    spark: SparkSession, landing: str, ingested_at: str, schema: T.StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """The customer export: ``customers.json``, one file or a folder of part files.

    Columns are the union of the record keys, which takes one extra pass over the files to
    find; give ``schema`` to save it. A JSON array cannot be split, so a big export should come
    as many files, or as JSON lines with ``multi_line=False``. Text that is not JSON is an error.
    """
    path = _first_existing(spark, [f"{landing}/customers.json"], "customers file")
    reader = spark.read.options(multiLine=multi_line, primitivesAsString=True, mode="FAILFAST")
    raw = (reader.schema(schema) if schema is not None else reader).json(path)
    rows = flatten(_with_ordinal(raw), "address", ("city", "country"))
    rows = rows.select(*[c for c in rows.columns if not c.startswith("_")], ORDINAL, "_source_file")
    require_columns(rows.drop(ORDINAL, "_source_file"), CUSTOMERS.columns, "customers")
    return with_lineage(rows, ingested_at, F.col("_source_file"))
