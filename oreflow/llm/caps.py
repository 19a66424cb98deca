"""Embedding near-duplicates by spherical-cap filters: list-decoded random product codes, a join on filters, verification.

A filter is a direction, and holds the vectors whose cosine with it reaches a bound. The directions are
not drawn one by one: after a random rotation a vector is cut into blocks, each block has its own
random codewords, and a filter is a choice of one codeword a block. So ``codewords ** blocks`` directions
take ``codewords * blocks`` products. A vector is decoded block by block to the list of all filters that
it exceeds; a choice is left as soon as the best codewords of the blocks to come can't lift it to the bound.
``codes`` such codes with rotations of their own stand beside each other.

Vectors that share a filter (and a label) meet in one task, where each pair's cosine is taken in double
precision. A pair counts in the first filter both exceed, which each row knows from the filters before, so
no pair is handed on: a task gives numbers of links and a spanning forest. Filters with more than ``tile``
vectors are cut into parts, and each two parts meet in a task of their own. Equal vectors are one node.

With 64 dimensions a vector exceeds 20 filters on average, and of pairs with a cosine of exactly 0.93
99 in 100 share one; above 0.95 hardly any is missed. A coordinate of a random direction has standard deviation
1 / sqrt(d), and the bound is ``deviations`` of it. Below ``LEAST_DIMENSIONS`` caps so far out hardly exist,
and all vectors of a label share one filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from oreflow.llm.common import Store, broadcast_if_small, join_counted
from oreflow.llm.simhash import components

LEAST = 0.93
CODES, BLOCKS, CODEWORDS, DEVIATIONS = 20, 2, 64, 3.36
LEAST_DIMENSIONS = 32
#: Vectors of a filter compared in one task.
TILE = 2048
SEED = 42
#: Vectors decoded at once.
DECODED = 1024


@cache
def product_codes(dimensions: int, n: int, blocks: int, codewords: int, seed: int = SEED) -> list[tuple[np.ndarray, list[tuple[slice, np.ndarray]]]]:
    """For each code its rotation and, for each block, where it stands and its codewords, which have length 1 / sqrt(blocks)."""
    cuts, out = [dimensions * k // blocks for k in range(blocks + 1)], []
    for k in range(n):
        draw = np.random.default_rng([seed, dimensions, k])
        rotation, parts = np.linalg.qr(draw.normal(size=(dimensions, dimensions)))[0], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            words = draw.normal(size=(codewords, b - a))
            parts.append((slice(a, b), words / (np.linalg.norm(words, axis=1, keepdims=True) * np.sqrt(blocks))))
        out.append((rotation, parts))
    return out


def decoded(units: np.ndarray, bound: float, codes: list) -> tuple[np.ndarray, np.ndarray]:
    """(vector, filter) for every filter whose direction has a cosine of ``bound`` or more with the unit vector."""
    owners, filters = [], []
    for nth, (rotation, parts) in enumerate(codes):
        turned = units @ rotation
        products = [turned[:, at] @ words.T for at, words in parts]
        rest = np.zeros((len(parts) + 1, len(units)))  # the most that the blocks from k on can add
        rest[:-1] = np.cumsum([p.max(axis=1) for p in products[::-1]], axis=0)[::-1]
        owner, total, chosen = np.arange(len(units)), np.zeros(len(units)), np.full(len(units), nth, dtype=np.int64)
        for k, p in enumerate(products):
            more = total[:, None] + p[owner]
            row, word = np.nonzero(more + rest[k + 1][owner][:, None] >= bound)
            owner, total, chosen = owner[row], more[row, word], chosen[row] * p.shape[1] + word
        owners.append(owner)
        filters.append(chosen)
    return np.concatenate(owners), np.concatenate(filters)


def units_of(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists, and where each list begins and the last ends."""
    return column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()


def with_filters(nodes: DataFrame, codes: int, blocks: int, codewords: int, deviations: float) -> DataFrame:
    """The nodes with the rising list of the filters each exceeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = _lists(batch.column("embedding"))
            sizes, found = np.diff(at), [np.empty(0, dtype=np.int64)] * batch.num_rows
            for d in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == d)
                if d < LEAST_DIMENSIONS:
                    for k in rows.tolist():
                        found[k] = np.zeros(1, dtype=np.int64)
                    continue
                for k in range(0, len(rows), DECODED):
                    own = rows[k : k + DECODED]
                    units = units_of(values[at[own][:, None] + np.arange(d)].astype(np.float64))
                    owner, filters = decoded(units, deviations / np.sqrt(d), product_codes(d, codes, blocks, codewords))
                    order = np.lexsort((filters, owner))
                    for i, part in zip(own.tolist(), np.split(filters[order], np.searchsorted(owner[order], np.arange(1, len(own)))), strict=True):
                        found[i] = part
            ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "filters"])

    return nodes.mapInArrow(run, StructType([*nodes.schema.fields]).add("filters", ArrayType(LongType())))


def near_pairs(one: np.ndarray, other: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs with a cosine of ``least`` or more."""
    i, j = np.nonzero(units_of(one) @ units_of(other).T >= least)
    return i, j


class _Tile:
    """The rows of one tile; ``links`` gives (a, b, n): n links of a = b, or a link that connects a and b."""

    def __init__(self, least: float):
        self.least = least

    def links(self, vectors: np.ndarray, tile: tuple[int, int], part: np.ndarray, nodes: list[int], copies: list[int], before: list[np.ndarray]) -> tuple[list[int], list[int], list[int]]:
        left, right = (np.flatnonzero(part == p) for p in tile)
        if not len(left) or not len(right):
            return [], [], []
        i, j = near_pairs(vectors[left], vectors[right], self.least)
        i, j = left[i], right[j]
        if tile[0] == tile[1]:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return [], [], []
        seen = {k: frozenset(before[k].tolist()) for k in {*i.tolist(), *j.tolist()}}
        count, parent, a, b, n = dict.fromkeys(seen, 0), {k: k for k in seen}, [], [], []

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            if seen[x].isdisjoint(seen[y]):  # else an earlier filter has the pair
                count[x] += copies[y]
                count[y] += copies[x]
                rx, ry = root(x), root(y)
                if rx != ry:
                    parent[ry] = rx
                    a.append(nodes[x])
                    b.append(nodes[y])
                    n.append(0)
        some = [k for k, m in count.items() if m]
        own = [nodes[k] for k in some]
        return a + own, b + own, n + [count[k] for k in some]


def filter_links(nodes: DataFrame, least: float, tile: int, store: Store) -> DataFrame:
    """a, b, n: for a = b the number of links of the node found in one task, else a link of a forest that connects what links."""
    key = ["label", "filter", "tile_a", "tile_b"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = _Tile(least), None

        def found(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            ends = np.append(starts[1:], len(rows))
            if not (ends - starts > 1).any():
                return
            column = {c: rows[c].combine_chunks() for c in rows.column_names}
            (values, at), (earlier, first) = _lists(column["embedding"]), _lists(column["before"])
            part, nodes, copies, tile_a, tile_b = (column[c].to_numpy() for c in ("part", "node", "copies", "tile_a", "tile_b"))
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if e - s > 1:
                    vectors = values[at[s] : at[e]].astype(np.float64).reshape(e - s, -1)
                    made = own.links(vectors, (tile_a[s], tile_b[s]), part[s:e], nodes[s:e].tolist(), copies[s:e].tolist(), [earlier[first[k] : first[k + 1]] for k in range(s, e)])
                    if made[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], names=["a", "b", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            change = np.zeros(len(rows), dtype=bool)
            change[0] = True
            for c in key:
                values = rows[c].combine_chunks()
                values = values.dictionary_encode().indices.to_numpy() if c == "label" else values.to_numpy()
                change[1:] |= values[1:] != values[:-1]
            starts = np.flatnonzero(change)
            yield from found(rows.slice(0, starts[-1]), starts[:-1])
            held = rows.slice(starts[-1])
        if held is not None:
            yield from found(held, np.zeros(1, dtype=np.int64))

    hits = nodes.select("label", F.posexplode("filters").alias("at", "filter"), "node", "copies", "embedding", "filters")
    full = hits.groupBy("label", "filter").count().where(F.col("count") > tile)
    full = broadcast_if_small(store.put("full", full.select("label", "filter", F.ceil(F.col("count") / tile).cast("int").alias("parts"))), 64)
    rows = hits.join(full, ["label", "filter"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("label", "filter", F.least("part", "with").alias("tile_a"), F.greatest("part", "with").alias("tile_b"), "part", "node", "copies", "embedding", F.slice("filters", F.lit(1), F.col("at")).alias("before"))
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(walk, "a long, b long, n long")


def near_vectors(
    vectors: DataFrame, least: float = LEAST, codes: int = CODES, blocks: int = BLOCKS, codewords: int = CODEWORDS, deviations: float = DEVIATIONS, tile: int = TILE
) -> DataFrame:
    """A row for each vector (vec_id, embedding, label): its links within its label, and the smallest id reachable over links.

    Links are pairs with a cosine of ``least`` or more that share a filter; equal vectors always link.
    A vector that is null, empty or zero, or that holds a null or a number that is not finite, links with nothing, nor do
    vectors of different length or of no label. Rows that repeat a vector are vectors of their own. A null id counts only
    where no other is reachable. Other columns are ignored; an empty table gives no rows.

    Returns vec_id, n_links, component_id, kept (vec_id = component_id).
    """
    store = Store(vectors.sparkSession, "caps")
    limit = float("inf")
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x > -limit)) & F.exists("embedding", lambda x: x != 0)
    able = F.coalesce(F.col("label").isNotNull() & whole, F.lit(False)).alias("able")
    group = F.concat_ws(":", F.size("embedding").cast("string"), F.col("label").cast("string")).alias("label")
    rows = store.put("rows", vectors.select(F.col("vec_id").cast("long").alias("vec_id"), able, group, "embedding", F.xxhash64(group, "embedding").alias("digest")))
    same = ["digest", "label", "embedding"]
    nodes = rows.where("able").groupBy(*same).agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
    nodes = store.put("nodes", with_filters(nodes.withColumn("node", F.monotonically_increasing_id()), codes, blocks, codewords, deviations))
    found = store.put("links", filter_links(nodes, least, tile, store))
    counts = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("a <> b").select("a", "b"), store).withColumnsRenamed({"a": "node", "b": "root"})
    placed = nodes.drop("filters").join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # One row for each node, so a component's hub is no hot key: its rows are combined before they are sent.
    smallest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("members"))
    placed = join_counted(placed, smallest, ["root"], "members")
    placed = store.put("placed", placed.select(*same, "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    alone = rows.where("NOT able").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = join_counted(rows.where("able").select("vec_id", *same), placed, same, "copies").select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
