"""Near copies by the Jaccard similarity of their word shingles: SimHash and min-hash bands, then an exact check.

Documents with the same set of shingles are one node, and a node has a SimHash mark: 64 bits, each the majority among the
hashes of its shingles. Nodes whose marks differ in at most ``MARK_BUDGET`` bits are candidates; the trie join of
``simhash`` finds them. Marks of nodes at a similarity of 0.8 differ in more bits than any trie can tell from chance, so
bands of minima find further candidates.

A node's sketch is one minimum for each of
``BANDS * ROWS`` hash functions; nodes with all minima of a band in common share a bucket. At a
similarity of 0.8 two nodes share none with a probability of 5 in 100,000, and the chance that so few
bytes of their sketches agree that they don't look alike is 2 in 100,000.

Only what connects is wanted, so no step makes pairs. Within a bucket, as in a trie, a task links nodes that look alike, leaving out
what is connected already: one link less than there are nodes at most. What these links connect over all tries and buckets is
a family; each node's set of shingles goes to its family once, where pairs not yet connected are
compared exactly. Links of similarity 0.8 or more, again a forest, give the groups.

A bucket or family of more rows than a task holds is cut into parts at random. Each part is linked by itself, together
with one node, the pivot, that goes to all parts. If that leaves more than one component, the rows outside the largest
one meet all others, part by part. So a large group of near copies costs what its rows cost, and what lies apart from
it is still compared with every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import LOWER_BYTES, Store, alone, broadcast_if_small, join_counted, row_key, same_row, small_batches
from oreflow.llm.simhash import SEED, SUBTREE_ROWS, components, links as mark_links, majority

SHINGLE_WORDS = 5
#: Least similarity, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 25, 5
#: Bits in which the SimHash marks of candidates may differ.
MARK_BUDGET = 4
#: Bytes of two sketches that agree in a candidate, of BANDS * ROWS; 100 are expected at 0.8.
AGREEING = 82
#: Shingles taken at once, and pairs of sketches compared at once.
CHUNK, COMPARED = 1 << 10, 1 << 16
#: Rows of a bucket, and of a family, in one task.
BUCKET_ROWS, FAMILY_ROWS = 8192, 512
_DRAW = np.random.default_rng(SEED)
_XOR = _DRAW.integers(0, 2**64, (BANDS * ROWS, 1), dtype=np.uint64)
_ODD = _DRAW.integers(0, 2**64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words, or of all words where there are fewer."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    starts = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    begins = starts[: max(1, len(words) - SHINGLE_WORDS + 1)].tolist()
    ends = (starts[min(SHINGLE_WORDS, len(words)) :] - 1).tolist()
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends, strict=True)], dtype=np.uint64))


def node(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), SEED)


def minima(own: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(own), CHUNK):
        np.minimum(least, ((own[None, at : at + CHUNK] ^ _XOR) * _ODD).min(axis=1), out=least)
    return least


def _sketches(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, marks, sketches, bands = [], [], [], []
            for text in batch.column("content"):
                own = shingles(text.as_py())
                least = minima(own)
                nodes.append(node(own))
                marks.append(majority(own))
                sketches.append((least >> np.uint64(16)).astype(np.uint8).tobytes())
                bands.append(np.array([xxhash.xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)], dtype=np.uint64).view(np.int64))
            columns = [batch.column("doc_id"), batch.column("row_key"), *[pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (nodes, marks)], pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "node", "mark", "sketch", "bands"])

    return _contents(docs).mapInArrow(alone(run), "doc_id long, row_key long, node long, mark long, sketch binary, bands array<long>")


def _contents(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("content")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("row_key"), content)


def _joined(find: Callable[[int, np.ndarray], np.ndarray], labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links between places that connect all that ``find`` (place, later places -> those it links to) and the labels connect."""
    root = np.unique(labels, return_inverse=True)[1]
    for one in range(len(root)):
        others = one + 1 + np.flatnonzero(root[one + 1 :] != root[one])
        if len(others):
            near = find(one, others)
            met, first = np.unique(root[near], return_index=True)
            yield from ((one, int(x)) for x in near[first])
            root[np.isin(root, met)] = root[one]
        elif (root == root[one]).all():
            return


def alike_links(sketches: list[bytes], labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links of sketches that look alike."""
    rows = np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(len(sketches), -1)

    def find(one: int, others: np.ndarray) -> np.ndarray:
        parts = [others[k : k + COMPARED] for k in range(0, len(others), COMPARED)]
        return np.concatenate([p[(rows[p] == rows[one]).sum(axis=1) >= AGREEING] for p in parts])

    return _joined(find, labels)


def exact_links(sets: list[bytes], labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links of sets (sorted 64-bit numbers) with the least similarity or more."""
    sizes = np.array([len(s) // 8 for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, number = np.unique(np.frombuffer(b"".join(sets), dtype=np.uint64), return_inverse=True)
    holders = owner[np.argsort(number, kind="stable")]  # the sets that hold each shingle, one list behind the other
    begins = np.concatenate(([0], np.cumsum(np.bincount(number)))) if len(number) else np.zeros(1, dtype=np.int64)
    first = np.cumsum(sizes) - sizes

    def find(one: int, others: np.ndarray) -> np.ndarray:
        own = number[first[one] : first[one] + sizes[one]]
        n = begins[own + 1] - begins[own]
        at = np.repeat(begins[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        shared = np.bincount(holders[at], minlength=len(sets))[others]
        return others[shared * LEAST[1] >= (sizes[one] + sizes[others] - shared) * LEAST[0]]

    return _joined(find, labels)


def _walked(rows: DataFrame, keys: list[str], links: Callable) -> DataFrame:
    """Links a, b that ``links`` finds among the rows (node, label, payload) of each key."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the key that the next batch may go on with

        def found() -> Iterator[pa.RecordBatch]:
            own = pa.Table.from_batches(held)
            if len(own) > 1:
                nodes = own["node"].to_numpy()
                ends = np.array(list(links(own["payload"].to_pylist(), own["label"].to_numpy())), dtype=np.int64).reshape(-1, 2)
                if len(ends):
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[ends[:, 0]]), pa.array(nodes[ends[:, 1]])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy() for k in keys]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if held and any(held[-1].column(k)[0].as_py() != c[x] for k, c in zip(keys, columns, strict=True)):
                    yield from found()
                    held = []
                held.append(batch.slice(x, y - x))
        if held:
            yield from found()

    return rows.select(*keys, "node", "label", "payload").repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(alone(walk), "a long, b long").distinct()


def connected(rows: DataFrame, links: Callable, most: int, store: Store, name: str) -> DataFrame:
    """Links a, b of nodes that connect all that ``links`` connects within each group (group, node, payload; stored).

    ``most`` rows of a group, about, are in one task.
    """
    sizes = rows.groupBy("group").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where(F.col("n") > most)
    large = store.put(f"{name}-large", sizes.select("group", "pivot", F.ceil(F.col("n") / most).cast("int").alias("parts")))
    few = broadcast_if_small(large, 48)
    own = F.pmod(F.xxhash64("node", "group"), F.col("parts")).cast("int")
    part = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("node") == F.col("pivot"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    dealt = rows.join(few, "group", "left").withColumn("part", F.explode(part)).withColumn("label", F.col("node"))
    inside = store.put(f"{name}-inside", _walked(dealt, ["group", "part"], links))
    if large.isEmpty():
        return inside

    # Of large groups, rows outside the most frequent component meet all rows.
    roots = components(inside, Store(store.spark, f"near-copies-{name}")).withColumnsRenamed({"a": "node", "b": "label"})
    labelled = rows.join(few, "group").drop("pivot", "parts").join(roots, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = store.put(f"{name}-labelled", labelled)
    counts = labelled.groupBy("group", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("n_main"))
    sized = main.where(F.col("n_main") < F.col("all")).select(
        "group", "main", F.ceil((F.col("all") - F.col("n_main")) / most).cast("int").alias("outer"), F.ceil(F.col("n_main") / most).cast("int").alias("inner")
    )
    sized = broadcast_if_small(store.put(f"{name}-sized", sized), 48)
    met = labelled.join(sized, "group").withColumn("is_main", F.col("label") == F.col("main"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.pmod(F.xxhash64("node", "group"), F.when(F.col("is_main"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
    # Tiles (outer part, -1 - inner part) and (outer part, outer part).
    with_main = F.when(F.col("is_main"), F.transform(upto("outer"), lambda k: F.struct(k.alias("x"), (-1 - own).alias("y"))))
    with_inner = F.transform(upto("inner"), lambda k: F.struct(own.alias("x"), (-1 - k).alias("y")))
    with_outer = F.transform(upto("outer"), lambda k: F.struct(F.least(own, k).alias("x"), F.greatest(own, k).alias("y")))
    met = met.select("group", "node", "label", "payload", F.inline(with_main.otherwise(F.concat(with_inner, with_outer))))
    return inside.unionByName(store.put(f"{name}-across", _walked(met, ["group", "x", "y"], links)))


def _sets(nodes: DataFrame, docs: DataFrame, families: DataFrame, store: Store) -> DataFrame:
    """group, node, payload (sorted shingles) of the nodes of families, from one document of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingles(t.as_py()) for t in batch.column("content")]
            yield pa.RecordBatch.from_arrays([pa.array(np.array([node(s) for s in own], dtype=np.uint64).view(np.int64)), pa.array([s.tobytes() for s in own], pa.binary())], names=["node", "payload"])

    wanted = store.put("wanted", nodes.join(families, "node", "left_semi").select("doc_id", "row_key"))
    texts, few = _contents(docs), broadcast_if_small(wanted, 32)
    sets = texts.join(few, same_row(texts, few), "left_semi").mapInArrow(alone(run), "node long, payload binary").dropDuplicates(["node"])
    return store.put("sets", sets.join(families, "node"))


def marked_links(nodes: DataFrame, budget: int, store: Store, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """Links a, b of nodes (node, mark; stored) that connect all whose marks differ in at most ``budget`` bits."""
    one = store.put("marks", nodes.groupBy("mark").agg(F.min("node").alias("first")))
    found = mark_links(one.select(F.col("mark").alias("fingerprint")), budget, subtree_rows, store)
    ends = one.select(F.col("mark").alias("a"), F.col("first").alias("x")), one.select(F.col("mark").alias("b"), F.col("first").alias("y"))
    other = found.join(ends[0], "a").join(ends[1], "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    same = nodes.join(one, "mark").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    return store.put("mark-links", other.unionByName(same))


def near_copies(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, family_rows: int = FAMILY_ROWS, budget: int = MARK_BUDGET) -> DataFrame:
    """A row for each document with the number of its group: what links of similarity 0.8 or more connect.

    A-Z are lower-cased, words end at spaces and \\t\\n\\v\\f\\r. A text of fewer than five words is one
    shingle; null and empty texts have none and are one group. Other columns are ignored; an empty
    table gives no rows. Nodes are known by 64-bit hashes.

    Returns doc_id, row_key, root.
    """
    store = Store(docs.sparkSession, "near-copies")
    marked = store.put("marked", _sketches(docs))
    own = F.struct("row_key", "doc_id", "mark", "sketch", "bands")
    nodes = store.put("nodes", marked.groupBy("node").agg(F.min_by(own, "row_key").alias("one"), F.count("*").alias("copies")).select("node", "copies", "one.*"))
    spread = store.put("spread", nodes.select("node", F.explode("bands").alias("group")))
    shared = spread.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    members = spread.join(shared, "group", "left_semi").join(nodes.select("node", F.col("sketch").alias("payload")), "node")
    members = store.put("members", members)
    store.drop("spread")
    alike = connected(members, alike_links, bucket_rows, store, "alike").unionByName(marked_links(nodes.select("node", "mark"), budget, store))
    ends = components(alike, Store(docs.sparkSession, "near-copies-families"))
    families = ends.select(F.col("a").alias("node"), F.col("b").alias("group")).union(ends.select("b", "b").distinct())
    links = connected(_sets(nodes, docs, store.put("families", families), store), exact_links, family_rows, store, "exact")
    roots = components(links, Store(docs.sparkSession, "near-copies-groups")).withColumnsRenamed({"a": "node", "b": "root"})
    store.drop("members")
    placed = nodes.select("node", "copies").join(roots, "node", "left").select("node", "copies", F.coalesce("root", "node").alias("root"))
    return join_counted(marked.select("doc_id", "row_key", "node"), store.put("placed", placed), ["node"], "copies").select("doc_id", "row_key", "root")
