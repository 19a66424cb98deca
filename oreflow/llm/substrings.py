"""Repeated word passages over documents, by prefix-partitioned suffix trees.

A window of ``length`` consecutive words has one anchor: of the ``GRAM``-word sequences in it, the one
with the least hash, the first of several. Equal windows have equal anchors at equal places, so
only suffixes that begin at an anchor, about one in 22, need a tree. They are split by prefix:

* The prefix of a suffix is its anchor, ``GRAM`` words. Anchors in one document only hold no repeat and
  go first. Equal surroundings of an anchor, its contexts, are one entry with its least document, so
  a passage that a third of all documents share is a single entry. Anchors with one context are
  settled by that.
* Anchors with several contexts get a tree each: suffixes sorted by their words with the length of
  the prefix that neighbours share, which is the suffix tree read from left to right; the same
  for the words before the anchor, read backwards. Two contexts share the window that has l words before
  the anchor when they lie below one node of depth ``length - l`` in one tree and of depth l in the other.
* An anchor with more contexts than fit a task gets longer prefixes, whole windows of ``length`` words,
  that is leaves; these Spark groups without holding them together.

Contexts are told apart by 128-bit hashes, and by their words in trees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import Remembered, Store, broadcast_if_small, row_key

LENGTH = 50
GRAM = 8
#: Contexts of one anchor that a task holds at most, and how many contexts it works on at once.
GROUP_CONTEXTS, STEP_CONTEXTS = 50_000, 4_000
#: Bytes in which a Python task remembers words.
REMEMBERED = 64 << 20
#: Stands for a null id: larger than all others, so its repeats go and it takes none away.
LAST = 2**63 - 1


class _Hashes(Remembered):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        self.keep(word, found)
        return found


def anchors(hashes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, its position, first window, number of windows) for the windows of a text in order."""
    windows = len(hashes) - length + 1
    if windows < 1:
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none, none, none
    span = min(GRAM, length)
    gram = np.zeros(len(hashes) - span + 1, dtype=np.uint64)
    for k in range(span):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(gram)]
    gram = (gram ^ gram >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    # Position in the low half: the first of equal hashes is the least.
    least = gram & np.uint64(0xFFFFFFFF00000000) | np.arange(len(gram), dtype=np.uint64)
    width, wanted = 1, length - span + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return gram[place[first]], place[first], first, np.diff(np.append(first, windows))


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes(REMEMBERED)
        for batch in batches:
            at, columns, contexts = [], [], []
            for k, text in enumerate(batch.column("content")):
                words = text.as_py().split()
                if len(words) < length:
                    continue
                key, place, first, count = anchors(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)), length)
                joined = b" ".join(words)
                starts = np.cumsum([0, *(len(w) + 1 for w in words)])
                begins, ends = starts[first].tolist(), (starts[first + count + length - 1] - 1).tolist()
                left = place - first
                contexts += [xxhash.xxh3_128_digest(joined[a:b], seed=s) for a, b, s in zip(begins, ends, left.tolist(), strict=True)]
                at.append(np.full(len(key), k))
                columns.append((key.view(np.int64), first, left, count))
            if at:
                at = pa.array(np.concatenate(at))
                parts = [pa.array(np.concatenate(c)) for c in zip(*columns, strict=True)]
                rows = [batch.column("order_id").take(at), batch.column("row_key").take(at), *parts, pa.array(contexts, pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, names=["order_id", "row_key", "key", "start", "before", "windows", "context"])

    inputs = docs.select("order_id", "row_key", F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    return inputs.mapInArrow(run, "order_id long, row_key long, key long, start long, before long, windows long, context binary")


def tree(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and how many leading entries each shares with the one before: the tree's leaves and depths."""
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    differ = ordered[1:] != ordered[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return order, np.concatenate(([0], shared))


def _nodes(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix the node at this depth that it lies below."""
    found = np.empty(len(order), dtype=np.int64)
    found[order] = np.cumsum(shared < depth)
    return found


def window_owners(keys: np.ndarray, before: np.ndarray, windows: np.ndarray, least: np.ndarray, texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context the least document of each of its windows, over all contexts with the same anchor."""
    ids: dict[bytes, int] = {}
    runs = [np.array([ids.setdefault(w, len(ids)) for w in t.split(b" ")], dtype=np.int64) for t in texts]
    reach = length - min(GRAM, length)
    after, back = np.full((len(runs), 1 + length), -1), np.full((len(runs), 1 + reach), -1)
    after[:, 0] = back[:, 0] = np.unique(keys, return_inverse=True)[1]
    for k, run in enumerate(runs):
        a = before[k]
        right, left = run[a : a + length], run[max(0, a - reach) : a][::-1]
        after[k, 1 : 1 + len(right)] = right
        back[k, 1 : 1 + len(left)] = left
    forward, backward = tree(after), tree(back)
    owners = [np.full(n, LAST, dtype=np.int64) for n in windows]
    for left in range(reach + 1):
        has = np.flatnonzero((left <= before) & (left > before - windows))
        if not len(has):
            continue
        node = _nodes(*forward, 1 + length - left)[has] * (len(runs) + 1) + _nodes(*backward, 1 + left)[has]
        order = np.argsort(node, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], node[order][1:] != node[order][:-1])))
        lowest = np.repeat(np.minimum.reduceat(least[has][order], first), np.diff(np.append(first, len(has))))
        for k, low in zip(has[order].tolist(), lowest.tolist(), strict=True):
            owners[k][before[k] - left] = low
    return owners


def _trees(texts: DataFrame, length: int) -> DataFrame:
    """key, context, owners: the trees of anchors whose contexts fit a task, several at once."""

    def solved(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        numbers = {c: table.column(c).to_numpy() for c in ("key", "before", "windows", "least")}
        owners = window_owners(numbers["key"], numbers["before"], numbers["windows"], numbers["least"], table.column("words").to_pylist(), length)
        columns = [table.column("key").combine_chunks(), table.column("context").combine_chunks(), pa.array(owners, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["key", "context", "owners"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # whole anchors, but for the last one
        size = 0
        for batch in batches:
            while batch.num_rows:
                part, batch = batch.slice(0, STEP_CONTEXTS), batch.slice(STEP_CONTEXTS)
                held.append(part)
                size += part.num_rows
                if size >= STEP_CONTEXTS:
                    table = pa.Table.from_batches(held).combine_chunks()
                    keys = table.column("key").to_numpy()
                    cut = int(np.argmax(keys == keys[-1]))
                    if cut:
                        yield solved(table.slice(0, cut).to_batches())
                        held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if held:
            yield solved(held)

    dealt = texts.select("key", "context", "least", "before", "windows", "words").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "key long, context binary, owners array<long>")


def _leaves(texts: DataFrame, length: int) -> DataFrame:
    """key, context, owners for anchors with too many contexts: grouped by whole windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, nth, marks = [], [], []
            for k, text in enumerate(batch.column("words")):
                words = text.as_py().split(b" ")
                n = batch.column("windows")[k].as_py()
                marks += [xxhash.xxh3_128_digest(b" ".join(words[j : j + length])) for j in range(n)]
                at += [k] * n
                nth += range(n)
            at = pa.array(at, pa.int32())
            columns = [batch.column("key").take(at), batch.column("context").take(at), batch.column("least").take(at), pa.array(nth, pa.int32()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "context", "least", "nth", "leaf"])

    inputs = texts.select("key", "context", "least", "windows", "words")
    spread = inputs.mapInArrow(run, "key long, context binary, least long, nth int, leaf binary")
    lowest = spread.groupBy("leaf").agg(F.min("least").alias("owner"))
    placed = spread.join(lowest, "leaf").groupBy("key", "context").agg(F.sort_array(F.collect_set(F.struct("nth", "owner"))).alias("owners"))
    return placed.select("key", "context", F.col("owners.owner").alias("owners"))


def _texts(docs: DataFrame, wanted: DataFrame, length: int, store: Store) -> DataFrame:
    """Each context with its words, cut from the document that stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("content"), batch.column("spans").to_pylist(), strict=True):
                words = text.as_py().split()
                for s in spans:
                    end = s["start"] + s["windows"] + length - 1
                    rows.append((s["key"], s["context"], s["least"], s["before"], s["windows"], s["contexts"], b" ".join(words[s["start"] : end])))
            types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "context", "least", "before", "windows", "contexts", "words"])

    span = F.struct("key", "context", F.col("order_id").alias("least"), "start", "before", "windows", "contexts")
    by_doc = wanted.groupBy("order_id", "row_key").agg(F.collect_list(span).alias("spans"))
    named = store.put("named", by_doc.select("order_id", "row_key"))
    keys = ["order_id", "row_key"]
    needed = docs.join(broadcast_if_small(named, 24), keys, "left_semi").distinct()
    met = needed.join(by_doc, keys).select(F.coalesce("text", F.lit("")).cast("binary").alias("content"), "spans")
    schema = "key long, context binary, least long, before long, windows long, contexts long, words binary"
    return met.mapInArrow(run, schema)


def repeated_windows(docs: DataFrame, length: int = LENGTH, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """order_id, row_key and starts: where a document's windows begin that also begin in a document with a smaller id.

    ``docs`` has order_id (never null), row_key and text. Only documents with such windows have a row.
    """
    store = Store(docs.sparkSession, "substrings")
    every = store.put("anchors", _anchor_rows(docs, length))
    ranges = every.groupBy("key").agg(F.min("order_id").alias("low"), F.max("order_id").alias("high"))
    shared = store.put("shared", ranges.where("low < high").select("key"))
    rows = store.put("rows", every.join(broadcast_if_small(shared, 16), "key", "left_semi"))
    store.drop("anchors")
    stands = F.min(F.struct("order_id", "row_key", "start", "before", "windows")).alias("s")
    contexts = store.put("contexts", rows.groupBy("key", "context").agg(stands).select("key", "context", "s.*"))
    sizes = contexts.groupBy("key").agg(F.count("*").alias("contexts"))
    alone = contexts.join(sizes.where("contexts = 1"), "key").select("key", "context", F.col("order_id").alias("owner"))
    several = contexts.join(sizes.where("contexts > 1"), "key")
    texts = store.put("texts", _texts(docs, several, length, store))
    owners = _trees(texts.where(F.col("contexts") <= group_contexts), length)
    large = texts.where(F.col("contexts") > group_contexts)
    if not large.isEmpty():
        owners = owners.unionByName(_leaves(large, length))
    owners = store.put("owners", owners)
    same = rows.join(alone, ["key", "context"]).where("owner < order_id").select("order_id", "row_key", F.sequence(F.col("start"), F.col("start") + F.col("windows") - 1).alias("starts"))
    other = rows.join(owners, ["key", "context"]).withColumn("nth", F.sequence(F.lit(0).cast("long"), F.col("windows") - 1))
    taken = F.filter("nth", lambda j: F.get("owners", j.cast("int")) < F.col("order_id"))
    other = other.select("order_id", "row_key", F.transform(taken, lambda j: F.col("start") + j).alias("starts")).where(F.size("starts") > 0)
    return same.unionByName(other).groupBy("order_id", "row_key").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """A row for each document with the words that no earlier document's window covers.

    Words end at spaces and \\t\\n\\v\\f\\r. A word goes if a window of ``length`` words covers it whose
    words also begin in a document with a smaller id; repeats within a document stay. Null and empty
    texts have no words. A null id is larger than all others; equal ids take nothing from each
    other. Other columns are ignored; an empty table gives no rows.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by a space), kept, spans (the
    removed ranges of words, end excluded).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digests, texts, spans = [], [], [], [], []
            for text, starts in zip(batch.column("content"), batch.column("starts"), strict=True):
                words = text.as_py().split()
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                if starts.is_valid:
                    begins = np.unique(starts.values.to_numpy())
                    cover[begins] += 1
                    np.subtract.at(cover, begins + length, 1)
                gone = np.cumsum(cover[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2)
                kept = b" ".join(words) if not len(edges) else b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                total.append(len(words))
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode())
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"])

    ids = F.col("doc_id").cast("long")
    rows = docs.select(ids.alias("doc_id"), F.coalesce(ids, F.lit(LAST)).alias("order_id"), row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    found = repeated_windows(rows.drop("doc_id"), length, group_contexts)
    match = (rows["row_key"] == found["row_key"]) & (rows["order_id"] == found["order_id"])
    met = rows.join(found, match, "left").select(rows["doc_id"], F.coalesce(rows["text"], F.lit("")).cast("binary").alias("content"), "starts")
    return met.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, spans array<struct<start: bigint, end: bigint>>")
