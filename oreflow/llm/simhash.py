"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are 64 bits; two link when at most ``budget`` differ. Equal fingerprints collapse
to one node first, so copies of one document, however many, are one entry.

A trie over all fingerprints has its top levels dealt out by Spark. The bits are cut into
``budget + 1`` blocks, and there is a trie for each block with that block's bits at the top: two
linking fingerprints agree on a whole block, so in that block's trie they lie below one node at
the block's depth. Each such subtree goes to one task. A subtree with more than ``subtree_rows``
fingerprints is dealt out once more in the same way by the bits that are left. In a task, pairs of
nodes are walked downwards together from (root, root): a pair whose paths differ in one more bit
has one more error, and is left as soon as its errors exceed the budget. A node is a range of the
sorted fingerprints and all pairs of a level advance at once in numpy. A task hands on links that
connect what it found connected, a spanning forest, never all pairs.

Components are joined by alternating star operations on stored links. A hub's links meet its least
neighbour in one join, row by row, which the adaptive planner can split; they are never held together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import LOWER_BYTES, Store, alone, row_key, small_batches

SEED = 42
SHINGLE_WORDS = 3
BUDGET = 2
SUBTREE_ROWS = 200_000
#: Node pairs walked at once, and the number of element pairs below which a node pair is compared directly.
FRONTIER, LEAF_PAIRS = 8192, 256
#: Shingles hashed at once, which bounds the memory a very long text takes.
CHUNK = 1 << 15


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits, each the majority among the hashes of the word shingles, repeats included; 0 without words."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    n = max(1, len(words) - shingle_words + 1)
    ends = (starts[min(shingle_words, len(words)) :] - 1).tolist()
    begins, digest, ones = starts[:n].tolist(), xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(begins[at : at + CHUNK], ends[at : at + CHUNK], strict=False)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set if most of the hashes have it; 0 for none."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row_key and fingerprint (as a signed number) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py(), shingle_words) for t in batch.column("content")]
            marks = pa.array(np.array(marks, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), marks], names=["doc_id", "row_key", "fingerprint"])

    small_batches(docs.sparkSession)
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("content")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("row_key"), content)
    return rows.mapInArrow(alone(run), "doc_id long, row_key long, fingerprint long")


def linked_pairs(values: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs within the budget among sorted distinct values that share their top ``depth`` bits."""
    if len(values) < 2:
        return
    top = values >> np.uint64(64 - depth) if depth else np.zeros(len(values), dtype=np.uint64)
    cuts = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1], [True])))
    lo, hi = cuts[:-1], cuts[1:]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    stack = [(lo[k : k + FRONTIER], hi[k : k + FRONTIER], lo[k : k + FRONTIER], hi[k : k + FRONTIER], np.zeros(len(lo[k : k + FRONTIER]), dtype=np.int64), depth) for k in range(0, len(lo), FRONTIER)]
    while stack:
        a_lo, a_hi, b_lo, b_hi, errors, level = stack.pop()
        pairs = (a_hi - a_lo) * (b_hi - b_lo)
        leaf = pairs <= LEAF_PAIRS
        if leaf.any():
            of = np.repeat(np.flatnonzero(leaf), pairs[leaf])
            nth = np.arange(len(of)) - np.repeat(np.cumsum(pairs[leaf]) - pairs[leaf], pairs[leaf])
            width = (b_hi - b_lo)[of]
            i, j = a_lo[of] + nth // width, b_lo[of] + nth % width
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            if near.any():
                yield i[near], j[near]
        deep = ~leaf
        if not deep.any():
            continue
        a_lo, a_hi, b_lo, b_hi, errors = a_lo[deep], a_hi[deep], b_lo[deep], b_hi[deep], errors[deep]
        bit = np.uint64(63 - level)
        half = np.uint64(1) << bit
        clear = ~(half | (half - np.uint64(1)))
        a_mid = np.searchsorted(values, (values[a_lo] & clear) | half)
        b_mid = np.searchsorted(values, (values[b_lo] & clear) | half)
        same = a_lo == b_lo
        children = (
            (a_lo, a_mid, b_lo, b_mid, errors, None),
            (a_mid, a_hi, b_mid, b_hi, errors, None),
            (a_lo, a_mid, b_mid, b_hi, errors + 1, None),
            (a_mid, a_hi, b_lo, b_mid, errors + 1, ~same),
        )
        parts = []
        for w, x, y, z, e, only in children:
            live = (x > w) & (z > y) & (e <= budget)
            if only is not None:
                live &= only
            parts.append([c[live] for c in (w, x, y, z, e)])
        joined = [np.concatenate(c) for c in zip(*parts, strict=True)]
        for k in range(0, len(joined[0]), FRONTIER):
            stack.append((*(c[k : k + FRONTIER] for c in joined), level + 1))


def forest(values: np.ndarray, depth: int, budget: int) -> tuple[list[int], list[int]]:
    """Links that connect whatever the linked pairs connect: at most one less than there are values."""
    parent, left, right = list(range(len(values))), [], []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, j in linked_pairs(values, depth, budget):
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                left.append(x)
                right.append(y)
    return left, right


def _blocks(bits: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each of the nearly equal blocks."""
    at = [bits * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:], strict=False)]


def _turned(value: Column, bits: int, by: int) -> Column:
    """The low ``bits`` of the value turned left."""
    mask = F.lit(-1 if bits == 64 else (1 << bits) - 1)
    if by == 0:
        return value.bitwiseAND(mask)
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value.bitwiseAND(mask), bits - by)).bitwiseAND(mask)


def _subtrees(nodes: DataFrame, budget: int, subtree_rows: int, store: Store) -> DataFrame:
    """Each fingerprint in the trie of each block: trie, depth, prefix (the subtree), value (bits in the trie's order)."""
    tries = []
    for trie, (first, width) in enumerate(_blocks(64, budget + 1)):
        value = _turned(F.col("fingerprint"), 64, first)
        tries.append(F.struct(F.lit(trie).alias("trie"), F.lit(width).alias("depth"), F.shiftrightunsigned(value, 64 - width).alias("prefix"), value.alias("value")))
    rows = nodes.select("fingerprint", F.inline(F.array(*tries)))
    full = store.put("full", rows.groupBy("trie", "prefix").count().where(F.col("count") > subtree_rows).select("trie", "prefix"))
    if full.isEmpty():
        return rows
    split = []
    for trie, (_, width) in enumerate(_blocks(64, budget + 1)):
        rest = 64 - width
        for nth, (first, more) in enumerate(_blocks(rest, budget + 1)):
            value = F.shiftleft(F.col("prefix"), rest).bitwiseOR(_turned(F.col("value"), rest, first))
            depth = width + more
            split.append(
                F.when(
                    F.col("trie") == trie,
                    F.struct(F.lit((budget + 1) * (trie + 1) + nth).alias("trie"), F.lit(depth).alias("depth"), F.shiftrightunsigned(value, 64 - depth).alias("prefix"), value.alias("value")),
                )
            )
    large = rows.join(full, ["trie", "prefix"], "left_semi")
    dealt = large.select("fingerprint", F.explode(F.filter(F.array(*split), lambda s: s.isNotNull())).alias("s")).select("fingerprint", "s.*")
    return rows.join(full, ["trie", "prefix"], "left_anti").select(dealt.columns).unionByName(dealt)


def links(nodes: DataFrame, budget: int, subtree_rows: int, store: Store) -> DataFrame:
    """Links a, b between distinct fingerprints that connect all that are within the budget of each other."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the subtree that the next batch may go on with

        def found(rows: np.ndarray) -> pa.RecordBatch:
            left, right = [], []
            for trie in np.unique(rows["trie"]):
                own = rows[rows["trie"] == trie]
                own = own[np.argsort(own["value"], kind="stable")]
                i, j = forest(own["value"], int(own["depth"][0]), budget)
                left.append(own["fingerprint"][i])
                right.append(own["fingerprint"][j])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

        for batch in batches:
            rows = np.empty(batch.num_rows, dtype=[("fingerprint", "i8"), ("trie", "i4"), ("depth", "i4"), ("prefix", "i8"), ("value", "u8")])
            for name in ("fingerprint", "trie", "depth", "prefix"):
                rows[name] = batch.column(name).to_numpy()
            rows["value"] = batch.column("value").to_numpy().view(np.uint64)
            if not len(rows):
                continue
            last = (rows["trie"] == rows["trie"][-1]) & (rows["prefix"] == rows["prefix"][-1])
            cut = len(rows) - int(np.argmin(last[::-1])) if not last.all() else 0
            before = held[-1][-1] if held else None
            if cut or before is not None and (before["trie"], before["prefix"]) != (rows["trie"][0], rows["prefix"][0]):
                yield found(np.concatenate([*held, rows[:cut]]))
                held = []
            held.append(rows[cut:])
        if held:
            yield found(np.concatenate(held))

    dealt = _subtrees(nodes, budget, subtree_rows, store).repartition("trie", "prefix").sortWithinPartitions("trie", "prefix")
    return dealt.mapInArrow(alone(walk), "a long, b long").distinct()


def components(pairs: DataFrame, store: Store) -> DataFrame:
    """a -> b, the least member of a's component, for every a that is not itself the least.

    Large and small stars in turn until nothing changes; each round is a stored table, so a lost
    executor costs no more than the round at hand.
    """
    current, before, turn = store.put("links-0", pairs.where("a <> b")), None, 0
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return current
        before, turn = state, turn + 1
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        stars = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.withColumnRenamed("least", "b"))
        current = store.put(f"links-{turn}", stars.where("a <> b").distinct())
        store.drop(f"links-{turn - 1}")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, budget: int = BUDGET, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """A row for each document with its fingerprint and the smallest doc_id reachable over links.

    A-Z are lower-cased, words end at spaces and \\t\\n\\v\\f\\r. A text with fewer words than a shingle
    is one shingle; null and empty texts have fingerprint zero and link like any other. A null id
    counts only where no other is reachable. Rows that repeat a document get the same answer.
    Other columns are ignored; an empty table gives no rows.

    Returns doc_id, fingerprint (16 hexadecimal digits), component_id, row_key, root (the component's own number).
    """
    store = Store(docs.sparkSession, "simhash")
    marked = store.put("marked", fingerprints(docs, shingle_words))
    nodes = store.put("nodes", marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(nodes.select("fingerprint"), budget, subtree_rows, store), store)
    placed = nodes.join(roots.select(F.col("a").alias("fingerprint"), F.col("b").alias("root")), "fingerprint", "left")
    placed = placed.withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = placed.join(smallest, "root").select("fingerprint", "component_id", "root")
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return marked.join(classes, "fingerprint").select("doc_id", digits, "component_id", "row_key", "root")
