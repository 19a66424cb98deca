"""Benchmark decontamination by a positional inverted index. Built-in functions only.

The index is a stored table of postings (term, document, position). A query is a sequence of
terms. Its occurrences come from intersecting posting lists, the rarest term first, each shifted
by the term's offset in the query, so that lists agree on where the query would start. The two
rarest terms are intersected over the index; what is left, few places, is compared with the
whole query. Common words are never intersected on their own, and their long lists never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import Store, ascii_lower, broadcast_if_small, row_key, same_row

WINDOW = 10
#: Terms of a query that are intersected, the rarest ones.
RAREST = 2
#: What lies between words: ASCII other than digits and letters.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text: runs of digits, letters and everything beyond ASCII. None for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), words(F.col("text")).alias("words"))


def build_index(docs: DataFrame, store: Store, terms: DataFrame | None = None) -> DataFrame:
    """Postings term, row_key, doc_id, pos of all documents, stored.

    With ``terms``, distinct in its column ``term``, only their postings are kept: no query over
    these terms reads any other.
    """
    postings = _keyed(docs).select("doc_id", "row_key", F.posexplode("words").alias("pos", "term"))
    if terms is not None:
        postings = postings.join(broadcast_if_small(terms, 64), "term")
    return store.put("postings", postings.select("term", "row_key", "doc_id", "pos"))


def windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: query (its words), query_id, items (the ids, as text, that have it).

    An item of fewer words is one window; an item of none has no window. A null item id is in no
    list, though its windows count.
    """
    split = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - length))
    spread = split.select("item", F.explode(F.transform(starts, lambda s: F.slice("words", s + 1, length))).alias("query"))
    return spread.groupBy("query").agg(F.collect_set("item").alias("items")).withColumn("query_id", F.xxhash64("query"))


def _ranked(postings: DataFrame, queries: DataFrame, rarest: int, store: Store) -> DataFrame:
    """The rarest terms of each query: term, query_id, offset, rank from 0, lists (how many the query has)."""
    spread = queries.select("query_id", F.posexplode("query").alias("offset", "term"))
    frequency = broadcast_if_small(store.put("frequency", postings.groupBy("term").agg(F.count("*").alias("postings"))), 64)
    order = Window.partitionBy("query_id").orderBy("postings", "offset")
    counted = spread.join(frequency, "term", "left").fillna(0, ["postings"]).withColumn("rank", F.row_number().over(order) - 1)
    size = F.max("rank").over(Window.partitionBy("query_id")) + 1
    return counted.withColumn("lists", F.least(F.lit(rarest), size)).where(F.col("rank") < rarest)


def intersect(postings: DataFrame, queries: DataFrame, store: Store, rarest: int = RAREST) -> DataFrame:
    """Places doc_id, row_key, query_id, start where the offset-adjusted lists of the rarest terms all meet."""
    ranked = _ranked(postings, queries, rarest, store).select("term", "query_id", "offset", "rank", "lists")
    ranked = broadcast_if_small(store.put("ranked", ranked), 96)
    shifted = postings.join(ranked, "term").withColumn("start", F.col("pos") - F.col("offset")).where("start >= 0")
    met = shifted.groupBy("row_key", "doc_id", "query_id", "start").agg(
        F.bit_or(F.expr("shiftleft(1, rank)")).alias("met"), F.first("lists").alias("lists")
    )
    return met.where("met = shiftleft(1, lists) - 1").select("doc_id", "row_key", "query_id", "start")


def phrase_matches(docs: DataFrame, items: DataFrame, length: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """A row for each document: words, and hits, structs of start, query and items of each exact occurrence."""
    store = Store(docs.sparkSession, "decontam")
    queries = store.put("queries", windows(items, length))
    terms = store.put("terms", queries.select(F.explode("query").alias("term")).distinct())
    postings = build_index(docs, store, terms)
    places = intersect(postings, queries, store, rarest)
    hits = places.join(broadcast_if_small(queries, 512), "query_id")
    hits = hits.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "query", "items")).alias("places"))
    hits = store.put("hits", hits)
    store.drop("postings")
    text = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("row_key"))
    met = text.join(hits, same_row(text, hits), "left").select(text["doc_id"], text["row_key"], words(text["text"]).alias("words"), hits["places"])
    exact = F.filter("places", lambda p: F.slice("words", p["start"] + 1, F.size(p["query"])) == p["query"])
    return met.select("doc_id", "row_key", "words", F.when(F.col("places").isNotNull(), exact).alias("hits"))


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """A row for each document: how many of its words lie in an occurrence of a window of an item.

    Null and empty texts have no words; a table without items contaminates nothing. Rows that
    repeat a document get the same answer, and a null id is an id like others. Other columns are
    ignored.

    Returns doc_id, n_words, n_hit, n_items (with occurring windows), items_sha256 (of those ids,
    sorted as text, comma-joined), contaminated, row_key.
    """
    found = phrase_matches(docs, items, length, rarest)
    hit = F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + F.size(h["query"]) - 1)))
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    counted = found.select(
        "doc_id",
        "row_key",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(F.size(F.array_distinct(hit)), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(ids, F.array().cast("array<string>")).alias("ids"),
    )
    return counted.select(
        "doc_id",
        "n_words",
        F.greatest("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "row_key",
    )


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int = 30, rarest: int = 3) -> DataFrame:
    """Documents that hold the rarest ``rarest`` distinct terms of an item within ``slop`` words of the rarest one.

    Returns doc_id, row_key, item_id, pos (of the rarest term), width (words from the first to the last
    of the nearest occurrences). An item of fewer distinct terms needs all it has. Positions meet
    by cells of ``slop`` words, so only neighbours are compared.
    """
    store = Store(docs.sparkSession, "proximity")
    terms = items.select("item_id", F.array_distinct(words(F.col("text"))).alias("query")).where(F.size("query") > 0)
    terms = terms.withColumn("query_id", F.xxhash64("item_id", "query"))
    wanted = store.put("terms", terms.select(F.explode("query").alias("term")).distinct())
    postings = build_index(docs, store, wanted)
    ranked = broadcast_if_small(store.put("ranked", _ranked(postings, terms, rarest, store).select("term", "query_id", "rank", "lists")), 96)
    listed = postings.join(ranked, "term").distinct()
    cells = F.array(*[(F.floor(F.col("pos") / slop) + d) for d in (-1, 0, 1)])
    pivots = listed.where("rank = 0").select("row_key", "doc_id", "query_id", "lists", F.col("pos").alias("at"), F.explode(cells).alias("cell"))
    others = listed.where("rank > 0").select("row_key", "query_id", "rank", "pos", F.floor(F.col("pos") / slop).alias("cell"))
    near = pivots.join(others, ["row_key", "query_id", "cell"]).where(F.abs(F.col("pos") - F.col("at")) <= slop)
    keys = ["doc_id", "row_key", "query_id", "at"]
    closest = near.groupBy(*keys, "rank").agg(F.min_by(F.col("pos"), F.struct(F.abs(F.col("pos") - F.col("at")), "pos")).alias("pos"), F.first("lists").alias("lists"))
    full = closest.groupBy(*keys).agg(F.count("*").alias("met"), F.min("pos").alias("low"), F.max("pos").alias("high"), F.first("lists").alias("lists"))
    full = full.where("met = lists - 1").select(*keys, (F.greatest("high", "at") - F.least("low", "at") + 1).alias("width"))
    alone = listed.where("rank = 0 AND lists = 1").select("doc_id", "row_key", "query_id", F.col("pos").alias("at"), F.lit(1).alias("width"))
    ids = terms.select("query_id", "item_id")
    return full.unionByName(alone).join(ids, "query_id").select("doc_id", "row_key", "item_id", F.col("at").alias("pos"), "width")
