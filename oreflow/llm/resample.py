"""Resampling documents by importance towards a target: hashed word n-grams, counted by joined batches.

A batch's texts are joined with a sentinel that no word holds, one regular expression finds the
words of all of them in one pass, and the places of the words are looked up among the documents'
offsets. N-grams whose words lie in different documents are masked; what is left is counted by
``bincount``. Words come in runs of fixed length that hand the last ``n - 1`` on, so a text of any
length takes bounded memory.

Counts of a task are one row a bucket, so the shuffle holds ``buckets`` rows a task at most. The
gains are a table of ``buckets`` numbers whatever the corpus. Documents are ranked by one range
partitioning of their scores: a row's rank is its place in its part and the sizes of the parts before.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import LOWER_BYTES, Store

BUCKETS = 10_000
LONGEST = 3
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
#: Bytes of text joined at once (a longer text is joined alone), and words held at once.
JOINED, RUN = 1 << 20, 1 << 16
#: Digits, letters a-z and everything beyond ASCII, in UTF-8.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Stands between texts; it belongs to no word.
_SENTINEL = b"\x00"


def joined(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts in lower case with sentinels between, and where each begins."""
    offsets = np.zeros(len(texts), dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=offsets[1:])
    return _SENTINEL.join(texts).translate(LOWER_BYTES), offsets


def features(texts: list[bytes], buckets: int = BUCKETS, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every run of 1 to ``longest`` consecutive words of a document."""
    if not texts:
        return
    whole, offsets = joined(texts)
    found = _WORD.finditer(whole)
    words: list[bytes] = []
    owner = np.empty(0, dtype=np.int64)
    while more := list(islice(found, RUN)):
        held = len(words)
        words += [m[0] for m in more]
        starts = np.fromiter((m.start() for m in more), dtype=np.int64, count=len(more))
        owner = np.concatenate([owner, np.searchsorted(offsets, starts, side="right") - 1])
        spaced = [b" " + w for w in words]
        sums = list(map(crc32, words))
        for n in range(1, longest + 1):
            if n > 1:  # the checksum goes on from that of the run without its last word
                sums = list(map(crc32, spaced[n - 1 :], sums))
            first, end = max(0, held - n + 1), max(0, len(words) - n + 1)  # runs that end among the words just found
            inside = owner[first:end] == owner[first + n - 1 : end + n - 1]
            yield owner[first:end][inside], np.array(sums[first:end], dtype=np.int64)[inside] % buckets
        kept = max(0, len(words) - longest + 1)  # a later run may begin there
        words, owner = words[kept:], owner[kept:]


def _batches(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows with about ``JOINED`` bytes; a null has no bytes."""
    texts, size, first = [], 0, 0
    for k, text in enumerate(column):
        own = text.as_py() or b""
        if texts and size + len(own) > JOINED:
            yield first, texts
            texts, size, first = [], 0, k
        texts.append(own)
        size += len(own)
    if texts:
        yield first, texts


def bucket_counts(table: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """bucket, n: how often features of the table's texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in _batches(batch.column("content")):
                for _, own in features(texts, buckets, longest):
                    counts += np.bincount(own, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    rows = table.select(F.col("text").cast("binary").alias("content")).mapInArrow(run, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's log of how much likelier the target is, add-one smoothed, in thousandths rounded down."""
    all_source, all_target = sum(source.values()) + buckets, sum(target.values()) + buckets
    of = lambda s, t: math.floor(1000 * math.log(float((t + 1) * all_source) / float((s + 1) * all_target)))
    return np.array([of(source.get(b, 0), target.get(b, 0)) for b in range(buckets)], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """A draw from the Gumbel distribution in thousandths, fixed by the id."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of each document."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight, words = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for first, texts in _batches(batch.column("content")):
                for k, (owner, own) in enumerate(features(texts, buckets, longest)):
                    if not len(owner):
                        continue
                    # Owners never go down, so each document's features stand together.
                    cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                    at, sizes = first + owner[cuts], np.diff(np.append(cuts, len(owner)))
                    n[at] += sizes
                    weight[at] += np.add.reduceat(gain[own], cuts)
                    if k % longest == 0:
                        words[at] += sizes
            ids = batch.column("doc_id")
            score = weight + np.array([noise(i.as_py(), seed) for i in ids], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (words, n, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("content"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame, least_words: int, percent: int, store: Store) -> DataFrame:
    """The rows with ``rank``: 1, 2, 3... by score downwards, then doc_id, for the share of those with enough words."""
    able = (F.col("n_words") >= least_words).alias("able")
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id")]
    # monotonically_increasing_id holds the number of the part and, in its low 33 bits, the place there.
    placed = scored.select("*", able).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = store.put("placed", placed.select("doc_id", "n_features", "weight", "score", "able", part.alias("part"), place.alias("place")))
    sizes = sorted(placed.groupBy("part").agg(F.count("*"), F.count_if("able")).collect())  # a row for each part
    before, rows = 0, []
    for p, n, _ in sizes:
        rows.append((p, before))
        before += n
    drawn = percent * sum(n for _, _, n in sizes) // 100
    first = placed.sparkSession.createDataFrame(rows, "part long, before long")
    rank = F.col("before") + F.col("place") + 1
    return placed.join(F.broadcast(first), "part").select("doc_id", "n_features", "weight", "score", F.when(F.col("able") & (rank <= drawn), rank).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """A row for each document with its weight, score and, if it is drawn, its rank.

    ``docs`` and ``target`` have a column text. A-Z are lower-cased; words are runs of digits, a-z and
    characters beyond ASCII. A null or empty text has no features and weight 0. Of equal scores the
    smaller doc_id comes first and none last; rows that repeat a document are scored alike and drawn each
    for itself, in any order among them. A null id is drawn by the noise of an empty one. Other columns are
    ignored; an empty table gives no rows, an empty target counts as one without features.

    Returns doc_id, n_features, weight, score, rank (null: not drawn).
    """
    store = Store(docs.sparkSession, "resample")
    count = lambda df: {r["bucket"]: r["n"] for r in bucket_counts(df, buckets, longest).collect()}  # noqa: E731  buckets rows at most
    # Stored, as range partitioning reads its input twice.
    scored = store.put("scored", weights(docs, gains(count(docs), count(target), buckets), longest, seed))
    return ranked(scored, least_words, percent, store)
