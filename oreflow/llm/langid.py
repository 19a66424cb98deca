"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring run in numpy over whole batches of texts. A task adds up the n-grams of what
it reads before anything is shuffled, so a row leaves it for each (language, n-gram) it saw, however
many documents of one language or source there are. The model, languages times hash buckets, has
a fixed size and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
SIZES = (1, 2, 3)
BUCKET_BITS = 16
SMOOTHING = 0.5
#: A model has at most so many languages; more is an error, as labels are then no languages.
MOST_LANGUAGES = 1000
#: Characters looked at in one step; what is made of them fits a core's cache.
STEP = 1 << 16
#: What a character counts as: letters as themselves, the end of a text (0) as such, all else as a blank.
SYMBOLS = np.array([c if chr(c).isalpha() else 32 for c in range(0x10000)], dtype=np.uint32)
SYMBOLS[0] = 0


def _runs(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of about STEP characters; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > STEP:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def grams(texts: list[str], sizes: tuple[int, ...], bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(for each n-gram size the bucket of the n-gram at each character, where each text begins).

    Case is ignored and what is no letter is a blank. N-grams of blanks alone, and those that would
    reach into the next text, are in the bucket after the last one.
    """
    low = [t.lower().replace("\x00", " ") for t in texts]
    codes = np.frombuffer(("\x00".join(low) + "\x00").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.cumsum([0, *(len(t) + 1 for t in low[:-1])])
    symbols = SYMBOLS[np.minimum(codes, len(SYMBOLS) - 1)]
    if codes.max() >= len(SYMBOLS):
        symbols = np.where(codes < len(SYMBOLS), symbols, codes)
    letter, inside = symbols > 32, symbols > 0
    hashed, some, whole, found = symbols, letter, inside, []
    for n in range(1, max(sizes) + 1):
        if n > 1:
            hashed = hashed[:-1] * np.uint32(0x01000193) + symbols[n - 1 :]
            some, whole = some[:-1] | letter[n - 1 :], whole[:-1] & inside[n - 1 :]
        if n in sizes:
            bucket = ((hashed + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
            bucket[~(some & whole)] = 1 << bits
            found.append(bucket)
    return found, starts


def learn(docs: DataFrame, rows: Column, sizes: tuple[int, ...] = SIZES, bits: int = BUCKET_BITS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their log priors and the log probability of each bucket, from the rows with a language.

    All of them count; nothing is sampled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                by_lang.setdefault(lang, []).append(text.as_py() or "")
            for lang, texts in by_lang.items():
                # N-grams by bucket and, where none is, the number of documents.
                total = found.setdefault(lang, np.zeros((1 << bits) + 1, dtype=np.int64))
                for run in _runs(texts):
                    for bucket in grams(run, sizes, bits)[0]:
                        total[:-1] += np.bincount(bucket, minlength=len(total))[:-1]
                total[-1] += len(texts)
        for lang, total in found.items():
            used = np.flatnonzero(total)
            columns = [pa.array([lang]), pa.array([used.astype(np.int32)]), pa.array([total[used]])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    labelled = docs.where(rows & F.col("lang").isNotNull()).select(F.col("text"), F.col("lang").cast("string").alias("lang"))
    partial = labelled.mapInArrow(count, "lang string, bucket array<int>, n array<long>")
    flat = partial.select("lang", F.inline(F.arrays_zip("bucket", "n")))
    totals = flat.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"))
    languages = totals.select("lang", F.col("counts.bucket").alias("bucket"), F.col("counts.n").alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1).toArrow()
    if languages.num_rows > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = languages.column("lang").to_pylist()
    counts = np.zeros((len(names), (1 << bits) + 1))
    for k in range(len(names)):
        counts[k, languages.column("bucket")[k].values.to_numpy()] = languages.column("n")[k].values.to_numpy()
    prior = np.log(counts[:, -1] / max(1, counts[:, -1].sum()))
    smooth = counts[:, :-1] + SMOOTHING
    return names, prior, np.log(smooth / smooth.sum(axis=1, keepdims=True))


def identify(docs: DataFrame, rows: Column, held: Column, sizes: tuple[int, ...] = SIZES, bits: int = BUCKET_BITS) -> DataFrame:
    """A row for each document: doc_id, held_out, lang_pred, score (the language's posterior).

    ``rows`` says which rows to learn from, ``held`` is handed through. A text that is null or has
    no letter is ``und`` with score 0, and so is every text when nothing could be learned. Equal
    posteriors go to the language first by name. Repeated rows count and are scored each; a null id
    is an id like others; other columns are ignored; an empty table gives no rows.
    """
    names, prior, likely = learn(docs, rows, sizes, bits)
    padded = np.concatenate([likely, np.zeros((len(names), 1))], axis=1).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast((prior, padded))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, table = sent.value
        for batch in batches:
            langs, scores = [], []
            for run in _runs([t.as_py() or "" for t in batch.column("text")]):
                known = [bool(names) and any(c.isalpha() for c in text) for text in run]
                best, share = np.zeros(len(run), dtype=np.int64), np.zeros(len(run))
                if any(known):
                    buckets, starts = grams(run, sizes, bits)
                    total = np.tile(first, (len(run), 1))
                    for k, own in enumerate(table):
                        sums = own[buckets[0]]
                        for bucket in buckets[1:]:
                            sums[: len(bucket)] += own[bucket]
                        total[:, k] += np.add.reduceat(sums, starts, dtype=np.float64)
                    best = total.argmax(axis=1)
                    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                for k, sure in enumerate(known):
                    langs.append(names[best[k]] if sure else UNKNOWN)
                    scores.append(float(share[k]) if sure else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text"))
    return inputs.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")
