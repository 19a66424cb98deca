"""Training-data pipeline over ``documents``: each stage is written as Parquet and read by the next.

    toxicity -> exact dedup -> near-dedup -> benchmark decontamination -> best-fit packing

Every stage but the last returns documents with their columns as they are. Stages keep what they
don't reject: nothing is sampled or capped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.common import Store, ascii_lower, broadcast_if_small, held_out, join_counted, row_key
from oreflow.llm.decontam import contamination
from oreflow.llm.exact import exact_duplicates, sha256
from oreflow.llm.nearcopies import near_copies
from oreflow.llm.packing import pack
from oreflow.llm.toxicity import learn, score

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Bytes in which a worker of the packing stage remembers encoded text: the JVM beside it holds what four stages left it.
REMEMBERED = 64 << 20
#: SQL can express neither the learned stage nor the tokenizer.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _free(docs: DataFrame, name: str) -> str:
    """A column name the documents don't have (names are the same whatever their case)."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _without(docs: DataFrame, key: Column, out: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """The documents but for those that ``out`` names, and one row for each that ``again`` names.

    Both have doc_id and ``key``, the value of the expression ``key`` of a document. ``out`` is stored, and sent to the
    executors only when it is small.
    """
    columns, own = docs.columns, _free(docs, "key")
    docs = docs.withColumn(own, key)

    def same(names: DataFrame):
        return docs["doc_id"].eqNullSafe(names["doc_id"]) & (docs[own] == names["key"])

    out = broadcast_if_small(out, 128)
    kept = docs.join(out, same(out), "left_anti")
    if again is None or again.isEmpty():
        return kept.select(*[F.col(f"`{c}`") for c in columns])
    repeated = kept["doc_id"].eqNullSafe(again["doc_id"]) & (kept[own] == again["key"])
    once, rest = kept.join(again, repeated, "left_semi").dropDuplicates(["doc_id", own]), kept.join(again, repeated, "left_anti")
    return rest.unionByName(once).select(*[F.col(f"`{c}`") for c in columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; learned on the labels of the training split.

    A null or empty text stays. Rows that repeat a document get one score, so all stay or none; a null id is
    scored like any other. Other columns are kept, whatever their names.
    """
    model, name = learn(docs, _table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 5, 0)), _free(docs, "score")
    return score(docs, model, docs.columns, name).where(F.col(name) < 0.5).drop(name)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased, null as empty) the row with the largest doc_id, a null id last.

    Where that row is repeated, one of its rows stays. Other columns are kept, whatever their names.
    """
    store, content = Store(spark, "pipeline-exact"), ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    found = store.put("found", exact_duplicates(docs).select("doc_id", "kept", F.col("text_sha256").alias("key")))
    out = store.put("out", found.where("NOT kept").select("doc_id", "key").distinct())
    again = found.where("kept").groupBy("doc_id", "key").count().where("count > 1").drop("count")
    return _without(docs, sha256(content), out, again)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8 or more in common) the document with the smallest doc_id.

    An id comes before none, and of rows with that id the one with the smallest hash of id and text. Null and empty texts are one
    group. Where the row that stays is repeated, one of its rows stays. Other columns are kept, whatever their names.
    """
    store = Store(spark, "pipeline-near")
    found = store.put("found", near_copies(docs).select("doc_id", F.col("row_key").alias("key"), "root"))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = store.put("first", found.groupBy("root").agg(F.min(own).alias("first"), F.count("*").alias("members")))
    several = join_counted(found, first, ["root"], "members").where(~own.eqNullSafe(F.col("first")))
    out = store.put("out", several.select("doc_id", "key").distinct())
    again = found.groupBy("doc_id", "key").count().where("count > 1").drop("count")
    return _without(docs, row_key(F.col("doc_id"), F.col("text")), out, again)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    A null or empty text stays, and so does everything if the benchmark is empty. Rows that repeat a document all stay or
    none. Other columns are kept, whatever their names.
    """
    found = contamination(docs, _table(spark, sf_dir, "benchmark")).where("contaminated")
    out = Store(spark, "pipeline-leaks").put("out", found.select("doc_id", F.col("row_key").alias("key")).distinct())
    return _without(docs, row_key(F.col("doc_id"), F.col("text")), out)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequence and place there.

    A null or empty text is the end id alone; repeated rows are packed each for itself; other columns go.
    """
    return pack(docs, TOKENIZER, remembered=REMEMBERED)


# The third stage finds near copies by the trie join of SimHash marks and, as marks of five-word shingles differ in up to 14 bits
# at a similarity of 0.8, beyond what a trie can tell from chance, by min-hash bands too; an exact check decides.
STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, store = _table(spark, sf_dir, "documents"), Store(spark, "pipeline")
    for name, stage in STAGES:
        docs = store.put(name, stage(spark, docs, sf_dir))
    return docs
