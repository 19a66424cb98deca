"""Exact duplicates: local, salted and global combining, full contents compared each time.

Built-in functions only. Every grouping key holds the content itself beside its digest, so two
texts with one digest stay apart:

1. Each task combines the equal texts it reads (the partial aggregation below the shuffle).
2. Groups of (digest, content, salt) merge. The salt, a hash of the document's id, spreads a
   text that a third of all rows share over many tasks.
3. The salts' winners, one row for each salt at most, combine to one row for each content.

The last join takes each document to its class by the digest alone. It may, as step 3 has shown
how many contents a digest has; the documents of a digest with several go by content too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import Store, ascii_lower

SALTS = 64


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_duplicates(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """A row for each document with the one of its equals that stays.

    Texts are equal when identical after lower-casing A-Z. The largest ``doc_id`` stays; a null id
    is below every id and stays only where a group has no other. A null text is empty. Rows that
    repeat both id and text are one document and are marked alike. Other columns of ``docs`` are
    ignored; an empty table gives no rows.

    Returns doc_id, keep_id, group_size (rows), kept, text_sha256 (of the lower-cased text).
    """
    content = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", content.alias("content")).withColumn("digest", digest(F.col("content")))
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "content", "salt")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    winners = salted.groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))

    store = Store(docs.sparkSession, "exact")
    classes = store.put(
        "classes",
        winners.groupBy("digest").agg(
            F.count("*").alias("contents"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        ),
    )
    alone = classes.where("contents = 1").drop("contents")
    found = rows.select("doc_id", "digest", _name(digest, "content", "digest")).join(alone, "digest")
    shared = classes.where("contents > 1").select("digest")
    if not shared.isEmpty():
        apart = winners.join(shared, "digest", "left_semi")
        met = rows.join(apart, ["digest", "content"]).select("doc_id", "digest", _name(digest, "content", "digest"), "keep_id", "group_size")
        found = found.unionByName(met)
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _name(digest: Callable[[Column], Column], content: str, name: str) -> Column:
    """The SHA-256 of the content: the digest itself unless another one was asked for."""
    return (F.col(name) if digest is sha256 else sha256(F.col(content))).alias("text_sha256")
