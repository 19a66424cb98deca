"""A bigram language model by deleted interpolation.

The probability of a word mixes maximum-likelihood estimates of three orders: the bigram, the unigram
and the uniform one. The weights depend on how often the context was seen, in buckets by powers of two.
They come from expectation-maximisation over a deleted fold: the n-grams of one part of the training
documents are predicted with counts from which that part is taken out. Scores use all training counts.

Counts are exact and cover every training document. Documents are dealt into chunks of about
``chunk_bytes``. A chunk combines its n-grams first and asks for their corpus counts: it sends, for
each range of hashes, its distinct n-grams with their own counts in one packed row, and gets the
totals back in the same order. So a frequent word costs one entry a chunk, not one a use, and a
chunk is all that a task holds. N-grams are known by hashes: of words 64 bits, of bigrams 56.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import LOWER_BYTES, Store, row_key

CHUNK_BYTES = 12 << 20
WORD_BITS, PAIR_BITS = 64, 56
#: Cells of the held-out histogram in each direction, from probability 1 down to 2 ** -CELLS / PER_OCTAVE.
CELLS, PER_OCTAVE = 160, 4
BUCKETS = 48
ROUNDS = 60
END = b"\n"  # no word holds white space


class Chunk:
    """Documents as one run of word numbers, 0 between them: the end of one is the context of the next one's first word."""

    def __init__(self, texts: list[bytes]):
        ids: dict[bytes, int] = {END: 0}
        runs, self.lengths = [np.zeros(1, dtype=np.int64)], np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            words = text.translate(LOWER_BYTES).split()
            runs.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words)))
            runs.append(np.zeros(1, dtype=np.int64))
            self.lengths[k] = len(words) + 1
        run = np.concatenate(runs)
        self.context, self.word = run[:-1], run[1:]
        self.owner = np.repeat(np.arange(len(texts)), self.lengths)
        self.word_hash = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), dtype=np.uint64, count=len(ids))
        pairs, self.pair = np.unique(self.context * len(ids) + self.word, return_inverse=True)
        left, right = self.word_hash[pairs // len(ids)], self.word_hash[pairs % len(ids)]
        mixed = (left * np.uint64(0x9E3779B97F4A7C15) ^ (right + np.uint64(0x2545F4914F6CDD1D))) * np.uint64(0xD6E8FEB86659FD93)
        self.pair_hash = ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - PAIR_BITS)

    def grams(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """kind, bits, hash of each distinct n-gram, its number for each token."""
        yield 1, WORD_BITS, self.word_hash, self.word
        yield 2, PAIR_BITS, self.pair_hash, self.pair


def _pack(hashes: np.ndarray) -> bytes:
    """Sorted hashes as steps, byte by byte: the high bytes are zeros, which the shuffle's compression takes away."""
    return np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _slim(counts: np.ndarray) -> bytes:
    """Counts in the fewest of 1, 2, 4 or 8 bytes each, the width first."""
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or counts.max() < 1 << 8 * w - 1)
    return bytes([width]) + counts.astype(f"<i{width}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<i{data[0]}", offset=1).astype(np.int64)


def _cuts(hashes: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Where each range of hashes begins among sorted ones; the last entry is their number."""
    bounds = np.array([(k << bits) // ranges for k in range(ranges)], dtype=np.uint64)
    return np.append(np.searchsorted(hashes, bounds), len(hashes))


def _requests(chunk_id: int, docs: pd.DataFrame, ranges: int) -> pd.DataFrame:
    chunk, rows = Chunk(_texts(docs)), []
    part = docs["part"].to_numpy()[chunk.owner]
    for kind, bits, hashes, number in chunk.grams():
        own = [np.bincount(number, part == p, minlength=len(hashes)).astype(np.int64) for p in (1, 2)]
        order = np.argsort(hashes)
        hashes, own = hashes[order], [c[order] for c in own]
        cuts = _cuts(hashes, bits, ranges)
        for k in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[k], cuts[k + 1]
            rows.append((kind, int(k), chunk_id, _pack(hashes[a:b]), _slim(own[0][a:b]), _slim(own[1][a:b])))
    return pd.DataFrame(rows, columns=["kind", "span", "chunk", "hashes", "kept", "fold"])


def _replies(rows: pd.DataFrame) -> pd.DataFrame:
    """Totals of one range of hashes for each chunk that asked, in its order; and a row for the range's own sums."""
    lists = [_unpack(h) for h in rows["hashes"]]
    known, of = np.unique(np.concatenate(lists), return_inverse=True)
    kept, fold = (np.bincount(of, np.concatenate([_wide(c) for c in rows[name]]), minlength=len(known)).astype(np.int64) for name in ("kept", "fold"))
    out, at = [], 0
    for chunk, hashes in zip(rows["chunk"], lists, strict=True):
        asked, at = of[at : at + len(hashes)], at + len(hashes)
        out.append((int(rows["kind"].iloc[0]), int(rows["span"].iloc[0]), int(chunk), _slim(kept[asked]), _slim(fold[asked]), 0, 0, 0, 0))
    totals = [int(x) for x in (kept.sum(), fold.sum(), ((kept + fold) > 0).sum(), (kept > 0).sum())]
    out.append((int(rows["kind"].iloc[0]), int(rows["span"].iloc[0]), -1, b"", b"", *totals))
    return pd.DataFrame(out, columns=["kind", "span", "chunk", "kept", "fold", "kept_tokens", "fold_tokens", "types", "kept_types"])


REQUESTS = "kind int, span int, chunk long, hashes binary, kept binary, fold binary"
REPLIES = "kind int, span int, chunk long, kept binary, fold binary, kept_tokens long, fold_tokens long, types long, kept_types long"


def _answered(docs: pd.DataFrame, replies: pd.DataFrame) -> tuple[Chunk, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The chunk, and for each kind the kept and fold totals of its n-grams in the chunk's own numbering."""
    chunk, totals = Chunk(_texts(docs)), {}
    for kind, _, hashes, _ in chunk.grams():
        own = replies[replies["kind"] == kind].sort_values("span")
        order, found = np.argsort(hashes), []
        for name in ("kept", "fold"):
            counts = np.empty(len(hashes), dtype=np.int64)
            counts[order] = np.concatenate([_wide(x) for x in own[name]])
            found.append(counts)
        totals[kind] = tuple(found)
    return chunk, totals


def _bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0 if never seen, else one more than its base-2 logarithm."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def _estimates(context: np.ndarray, pair: np.ndarray, word: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    return pair / np.maximum(context, 1), word / max(tokens, 1)


def _cell(p: np.ndarray) -> np.ndarray:
    """0 for no probability, else 1 + its distance from 1 in parts of an octave."""
    with np.errstate(divide="ignore"):
        steps = np.minimum(np.rint(-np.log2(p) * PER_OCTAVE), CELLS - 2)
    return np.where(p > 0, 1 + steps, 0).astype(np.int64)


def learn_weights(cells: list[tuple[int, int, int, float]], types: int) -> np.ndarray:
    """Weights of bigram, unigram and uniform estimates for each bucket, by EM; (bucket, bigram cell, unigram cell, tokens)."""
    value = np.append(0, 2.0 ** (-np.arange(CELLS - 1) / PER_OCTAVE))
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    weights[0] = [0, 0.8, 0.2]
    if not cells:
        return weights
    bucket, second, first, n = (np.array(c) for c in zip(*cells, strict=True))
    each = np.stack([value[second], value[first], np.full(len(n), 1 / (types + 1))], axis=1)
    for _ in range(ROUNDS):
        share = weights[bucket] * each
        share *= (n / share.sum(axis=1))[:, None]
        mass = np.stack([np.bincount(bucket, share[:, k], minlength=BUCKETS) for k in range(3)], axis=1)
        seen = mass.sum(axis=1) > 0
        # A trace for each order keeps every word possible and buckets that saw little near the even mix.
        mass[seen] += 0.01
        mass[0, 0] = 0
        weights[seen] = mass[seen] / mass[seen].sum(axis=1, keepdims=True)
    return weights


def _chunked(docs: DataFrame, part: Column, chunks: tuple[int, int]) -> DataFrame:
    """Documents with part and chunk, the text compressed as it moves twice. The deleted fold has chunks of its own, the first ones."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([packer.compress(t.as_py()) for t in batch.column("content")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("chunk"), packed], names=["doc_id", "part", "chunk", "content"])

    number = F.xxhash64(row_key(F.col("doc_id"), F.col("text")), F.lit("chunk"))
    chunk = F.when(part == 2, F.pmod(number, F.lit(chunks[0]))).otherwise(F.pmod(number, F.lit(chunks[1])) + chunks[0])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), chunk.alias("chunk"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    return rows.mapInArrow(compress, "doc_id long, part int, chunk long, content binary")


def _texts(group: pd.DataFrame) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in group["content"]]


def score_documents(docs: DataFrame, held: Column, fold: Column, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row for each document with its log10 probability under the model and under add-one unigrams.

    ``held`` marks documents that are only scored, ``fold`` those of the rest that the weights are
    learned on. Words end at spaces and \\t\\n\\v\\f\\r, A-Z are lower-cased; each text ends with an end
    token, so null and empty texts have that one. Without training documents every word has the same
    probability. Repeated rows count and are scored each; other columns are ignored; an empty table
    gives no rows.

    Returns doc_id, held_out, n_tokens, n_known (seen in training), train_tokens, base_score, score.
    """
    # 0 held out, 1 kept, 2 the deleted fold
    part = F.when(held, 0).when(fold, 2).otherwise(1)
    size = F.octet_length("text")
    sizes = docs.agg(F.sum(F.when(part == 2, size)), F.sum(F.when(part < 2, size))).first()
    chunks = tuple(max(1, -(-(n or 0) // chunk_bytes)) for n in sizes)
    ranges, store = sum(chunks), Store(docs.sparkSession, "lm")
    rows = _chunked(docs, part, chunks)

    def ask(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return _requests(int(key[0]), group, ranges)

    asked = rows.groupBy("chunk").applyInPandas(ask, REQUESTS)
    replies = store.put("replies", asked.groupBy("kind", "span").applyInPandas(_replies, REPLIES))
    total = replies.where("kind = 1 AND chunk < 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kept_tokens", "fold_tokens", "types", "kept_types"))).first()
    answers = replies.where("chunk >= 0").select("chunk", "kind", "span", "kept", "fold")

    def tally(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "second", "first", "n"]
        if not len(group):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
        chunk, counts = _answered(group, own)
        word, context = counts[1][0][chunk.word], counts[1][0][chunk.context]
        second, first = _estimates(context, counts[2][0][chunk.pair], word, total["kept_tokens"])
        code = (_bucket(context) * CELLS + _cell(second)) * CELLS + _cell(first)
        cells, n = np.unique(code, return_counts=True)
        return pd.DataFrame({"bucket": cells // CELLS**2, "second": cells // CELLS % CELLS, "first": cells % CELLS, "n": n})

    held_in = rows.where("part = 2").groupBy("chunk").cogroup(answers.where(F.col("chunk") < chunks[0]).groupBy("chunk"))
    cells = held_in.applyInPandas(tally, "bucket long, second long, first long, n long")
    table = cells.groupBy("bucket", "second", "first").agg(F.sum("n").alias("n"))  # BUCKETS * CELLS**2 rows at most, most of them never
    weights = learn_weights([tuple(r) for r in table.collect()], total["kept_types"])
    tokens, types = total["kept_tokens"] + total["fold_tokens"], total["types"]

    def score(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(group):
            return pd.DataFrame({c: [] for c in names})
        chunk, counts = _answered(group, own)
        every = {kind: kept + fold for kind, (kept, fold) in counts.items()}
        word, context = every[1][chunk.word], every[1][chunk.context]
        second, first = _estimates(context, every[2][chunk.pair], word, tokens)
        mix = weights[_bucket(context)]
        p = mix[:, 0] * second + mix[:, 1] * first + mix[:, 2] / (types + 1)
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        add = lambda x: np.add.reduceat(x, starts)
        columns = (
            group["doc_id"].to_numpy(), group["part"].to_numpy() == 0, chunk.lengths, add((word > 0).astype(np.int64)),
            np.full(len(group), tokens), add(np.log10((word + 1) / (tokens + types + 1))), add(np.log10(p)),
        )
        return pd.DataFrame(dict(zip(names, columns, strict=True)))

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(score, schema)
