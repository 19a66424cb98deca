"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A document is toxic when at least one sentence is: with p a sentence's probability, the document's is
1 - product of (1 - p), the noisy-or. A sentence's p is logistic in the sum of its distinct
words' weights, and a word's weight is the sum over hashed features: the word and its first letters. The likelihood
of the document labels trains the weights; sentences with high p are then the offending ones.

Training takes a sample of labelled documents of a documented size (``train_docs``, ``train_chars``).
Scoring takes every sentence of every document.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import Store, alone, row_key, small_batches

TRAIN_DOCS = 8_000
#: A labelled document longer than this isn't learned from.
TRAIN_CHARS = 100_000
FEATURE_BITS = 20
PREFIXES = (3, 4, 5, 6)
#: A sentence without an end in sight is cut after so many words.
SENTENCE_WORDS = 64
#: A feature is learned if so many training documents have it, and one in so many.
LEAST_DOCS, LEAST_SHARE = 5, 400
STEPS, RATE, DECAY = 80, 0.15, 2e-3
START = -7.0
#: Bias of a model that has seen nothing toxic.
NEVER = -30.0
#: Bytes in which a Python task remembers words; a text that takes it beyond makes it start anew.
REMEMBERED = 64 << 20
STOP = b"."

# Sentences end at . ! ? and line ends; other ASCII signs separate words.
_ENDS = b".!?\n\r"
_CLASSES = bytes(46 if b in _ENDS else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def tokens(text: str) -> list[bytes]:
    """Lower-cased words in order, with STOP where a sentence ends."""
    return text.lower().encode("utf-8", "replace").translate(_CLASSES).replace(b".", b" . ").split()


def features(word: bytes) -> list[int]:
    """Hashed features: the word, and its first 3 to 6 letters as far as it has more."""
    letters = word.decode("utf-8", "replace")
    parts = [b"w" + word] + [b"p" + letters[:n].encode() for n in PREFIXES if len(letters) > n]
    return [xxhash.xxh64_intdigest(p) >> 64 - FEATURE_BITS for p in parts]


def sentence_starts(stop: np.ndarray) -> np.ndarray:
    """Positions where a sentence begins, among words and stops; no sentence is longer than SENTENCE_WORDS."""
    if not len(stop):
        return np.zeros(0, dtype=np.int64)
    first = np.concatenate(([True], stop[:-1])) & ~stop
    begun = np.maximum.accumulate(np.where(first, np.arange(len(stop)), 0))
    return np.flatnonzero(~stop & ((np.arange(len(stop)) - begun) % SENTENCE_WORDS == 0))


def instances(ids: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sentences as sets of words: (where each begins, sentence and word of each member, the distinct sentences).

    A word counts once in a sentence and a sentence once in a document, so repetition proves nothing.
    """
    starts = sentence_starts(stop)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    sentence = np.searchsorted(starts, np.arange(len(ids)), side="right") - 1
    live = ~stop
    members = np.unique(sentence[live] << 32 | ids[live])
    sentence, word = members >> 32, members & 0xFFFFFFFF
    mixed = (word.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
    return starts, sentence, word, np.sort(np.unique(np.add.reduceat(mixed, first), return_index=True)[1])


class _Weights(dict):
    """Word to its number; ``values`` has the numbers' weights. Number 0 is STOP."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.values, self.size = weights, array("d", [0.0]), 0
        self[STOP] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.values)
        self.values.append(float(self.weights[features(word)].sum()))
        self.size += len(word) + 200  # the word, its number and its weight
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if self.size > REMEMBERED:
            self.clear()
            self.values, self[STOP], self.size = array("d", [0.0]), 0, 0
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def sentence_scores(text: str, weights: _Weights, bias: float) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(logit of each sentence, the tokens, where each sentence begins, the distinct sentences)."""
    words = tokens(text)
    ids = weights.numbers(words)
    starts, sentence, word, distinct = instances(ids, ids == 0)
    values = np.frombuffer(weights.values, dtype=np.float64)[word]
    return bias + np.bincount(sentence, values, minlength=len(starts)), words, starts, distinct


def noisy_or(logits: np.ndarray) -> float:
    """1 - product of (1 - p) over sentences; 0 for a text without any."""
    return float(-np.expm1(-np.logaddexp(0, logits).sum()))


def document_score(text: str, weights: _Weights, bias: float) -> float:
    logits, _, _, distinct = sentence_scores(text, weights, bias)
    return noisy_or(logits[distinct])


def train(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Feature weights and bias that maximise the likelihood of the labels, with decay, by Adam."""
    ids: dict[bytes, int] = {STOP: 0}
    flat, sentence, owner, base = [], [], [], 0
    for k, text in enumerate(texts):
        words = tokens(text)
        numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
        starts, own, word, distinct = instances(numbers, numbers == 0)
        place = np.full(len(starts), -1)
        place[distinct] = np.arange(len(distinct))
        kept = place[own] >= 0
        flat.append(word[kept].astype(np.int32))
        sentence.append((place[own][kept] + base).astype(np.int32))
        owner.append(np.full(len(distinct), k))
        base += len(distinct)
    weights, bias = np.zeros(1 << FEATURE_BITS, dtype=np.float32), START
    if labels.sum() == 0 or not base:
        return weights, NEVER
    owner, flat, sentence = np.concatenate(owner), np.concatenate(flat), np.concatenate(sentence)
    n_words, flat_features, sizes = len(ids), array("i"), array("b")
    for w in ids:
        own = features(w)
        flat_features.extend(own)
        sizes.append(len(own))
    word, feature = np.repeat(np.arange(n_words, dtype=np.int32), sizes), np.frombuffer(flat_features, dtype=np.int32)
    # A feature that few documents have explains them one by one and says nothing about others.
    documents = np.bincount(np.unique(owner[sentence] * n_words + flat) % n_words, minlength=n_words)
    spread = np.bincount(feature, documents[word], minlength=1 << FEATURE_BITS)
    common = spread[feature] >= max(LEAST_DOCS, len(texts) // LEAST_SHARE)
    word, feature = word[common], feature[common]
    used, slot = np.unique(feature, return_inverse=True)
    own = np.zeros(len(used))
    m, v, bm, bv = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, STEPS + 1):
        by_word = np.bincount(word, own[slot], minlength=n_words)
        z = bias + np.bincount(sentence, by_word[flat], minlength=base)
        total = np.maximum(np.bincount(owner, np.logaddexp(0, z), minlength=len(texts)), 1e-12)
        # d(-log likelihood)/d(total): 1 for clean documents, -exp(-total)/(1 - exp(-total)) for toxic ones.
        outer = np.where(labels > 0, -1 / np.expm1(np.minimum(total, 50)), 1.0)
        inner = outer[owner] / (1 + np.exp(-np.clip(z, -50, 50)))
        by_word = np.bincount(flat, inner[sentence], minlength=n_words)
        grad, bgrad = np.bincount(slot, by_word[word], minlength=len(used)) + DECAY * len(texts) / 100 * own, inner.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        bm, bv = 0.9 * bm + 0.1 * bgrad, 0.999 * bv + 0.001 * bgrad**2
        own -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bias -= RATE * (bm / (1 - 0.9**step)) / (np.sqrt(bv / (1 - 0.999**step)) + 1e-8)
    weights[used] = own
    return weights, float(bias)


def learn(docs: DataFrame, labels: DataFrame, rows: Column, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> tuple[np.ndarray, float]:
    """Model from a sample of the labelled documents that ``rows``, an expression of doc_id, admits.

    A document with several labels is toxic if one says so. The sample is the ``train_docs`` documents
    with the least hash of their id, among those of at most ``train_chars`` characters. Which they are is
    settled first, on ids and lengths; only their texts then move, to the one task that trains.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            toxic += batch.column("toxic").to_pylist()
        weights, bias = train(texts, np.array(toxic, dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], names=["weights", "bias"])

    small_batches(docs.sparkSession)
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    text = F.coalesce("text", F.lit(""))
    key = row_key(F.col("doc_id"), F.col("text")).alias("row_key")
    sizes = docs.where(rows).select("doc_id", key, F.length(text).alias("chars")).where(F.col("chars") <= train_chars).drop("chars")
    chosen = sizes.join(marked, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "row_key").limit(train_docs)
    ids = Store(docs.sparkSession, "toxicity").put("sample", chosen)
    # At most train_docs rows, a fixed number.
    sample = docs.select("doc_id", key, text.alias("text")).join(F.broadcast(ids), ["doc_id", "row_key"]).dropDuplicates(["doc_id", "row_key"])
    model = sample.select("text", "toxic").repartition(1).mapInArrow(alone(fit), "weights binary, bias double").first()
    if model is None:
        return np.zeros(1 << FEATURE_BITS, dtype=np.float32), NEVER
    return np.frombuffer(bytes(model["weights"]), dtype=np.float32), model["bias"]


LOCATED = ("n_offending integer", "worst_sentence integer", "worst_score double", "worst_words string")


def located(text: str, weights: _Weights, bias: float, least: float = 0.5) -> tuple[float, int, int | None, float | None, str | None]:
    """Score of a text, how many of its sentences reach ``least`` by themselves, and the first of the worst ones: number, probability, words."""
    logits, words, starts, distinct = sentence_scores(text, weights, bias)
    if not len(logits):
        return 0.0, 0, None, None, None
    own, k = 1 / (1 + np.exp(-logits)), int(np.argmax(logits))
    return noisy_or(logits[distinct]), int((own >= least).sum()), k, float(own[k]), said(words, starts, k)


def said(words: list[bytes], starts: np.ndarray, k: int) -> str:
    """The words of sentence ``k``."""
    end = starts[k + 1] if k + 1 < len(starts) else len(words)
    return b" ".join(w for w in words[starts[k] : end] if w != STOP).decode("utf-8", "replace")


def score(docs: DataFrame, model: tuple[np.ndarray, float], columns: list[str], name: str = "score", locate: bool = False) -> DataFrame:
    """The given columns of each document and its probability of being toxic under ``name``; null text is empty.

    With ``locate`` also ``LOCATED``: where in the text the offence is.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = "text" if "text" in columns else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        known = _Weights(weights)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(text)]
            arrays = [batch.column(c) for c in columns]
            if locate:
                found = list(zip(*[located(t, known, bias) for t in texts], strict=True)) or [()] * 5
                arrays += [pa.array(x, kind) for x, kind in zip(found, (pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.string()), strict=True)]
            else:
                arrays.append(pa.array([document_score(t, known, bias) for t in texts], pa.float64()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, name, *[c.split()[0] for c in LOCATED if locate]])

    small_batches(docs.sparkSession)
    named = [F.col(f"`{c}`") for c in columns]
    inputs = docs.select(*named) if text in columns else docs.select(*named, F.col("text").alias(text))
    schema = docs.select(*named).schema.add(name, "double")
    for column in LOCATED if locate else ():
        schema = schema.add(*column.split())
    return inputs.mapInArrow(alone(run), schema)


def offending_sentences(docs: DataFrame, model: tuple[np.ndarray, float], least: float = 0.5) -> DataFrame:
    """doc_id, sentence (number), words, score of each sentence whose own probability reaches ``least``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        known = _Weights(weights)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                logits, words, starts, _ = sentence_scores(text.as_py() or "", known, bias)
                for k in np.flatnonzero(1 / (1 + np.exp(-logits)) >= least):
                    rows.append((doc_id, int(k), said(words, starts, k), float(1 / (1 + np.exp(-logits[k])))))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            types = (pa.int64(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "sentence", "words", "score"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(alone(run), "doc_id long, sentence int, words string, score double")


def toxicity(docs: DataFrame, labels: DataFrame, held: Column, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """A row for each document: doc_id, held_out, score, predicted (1 from 0.5 on), and where its worst sentence is.

    n_offending counts sentences whose own probability reaches 0.5; worst_sentence (number), worst_score and worst_words tell the worst,
    the first of equals, and are null for a text without words. Learns from labelled rows that ``held`` leaves; without any toxic label all scores are next to
    0. Null and empty texts score 0. A null id has no label and is scored; repeated rows are
    scored each; an empty table gives no rows.
    """
    model = learn(docs, labels, ~held, train_docs)
    found = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text"), model, ["doc_id", "held_out"], locate=True)
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
