from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from oreflow.llm.common import held_out
from oreflow.llm.toxicity import SENTENCE_WORDS, document_score, learn, offending_sentences, sentence_scores, tokens, toxicity, train

DOCS, LABELS = "doc_id long, text string, score double, held_out string", "doc_id long, toxic int, text string"
BAD = ["vile", "grubby", "rotten"]


def corpus(n=500):
    draw = random.Random(6)
    vocabulary = [f"word{k}" for k in range(400)]
    rows = []
    for k in range(n):
        sentences = [[draw.choice(vocabulary) for _ in range(8)] for _ in range(draw.randint(1, 12))]
        toxic = int(draw.random() < 0.3)
        if toxic:
            draw.choice(sentences).insert(3, draw.choice(BAD))
        rows.append((k, ". ".join(" ".join(s) for s in sentences).capitalize() + "!", toxic))
    return rows


def frames(spark, rows):
    odd = [(9000, None), (9001, ""), (9002, "?!\n."), (None, "vile"), (9003, "word1 " * 60_000), (9004, "tie"), (9004, "tie")]
    docs = spark.createDataFrame([(i, t, 0.0, "x") for i, t, _ in rows] + [(i, t, 0.0, "x") for i, t in odd], DOCS)
    labels = spark.createDataFrame([(i, y, "t") for i, _, y in rows] + [(9000, None, ""), (None, 1, ""), (9001, 0, ""), (0, 0, "")], LABELS)
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    got = toxicity(docs, labels, held_out(F.col("doc_id"), 5, 0)).collect()
    assert len(got) == len(rows) + 7
    by_id = {r.doc_id: r for r in got}
    tested = [(by_id[i].predicted, y) for i, _, y in rows if by_id[i].held_out]
    assert len(tested) > 60 and np.mean([a == b for a, b in tested]) > 0.95
    assert by_id[9000].score == by_id[9001].score == by_id[9002].score == 0 and by_id[9003].predicted == 0


def test_locates_sentences(spark):
    docs, labels = frames(spark, corpus())
    model = learn(docs, labels, F.lit(True))
    text = "word1 word2 word3. word4 vile word5. word6 word7"
    one = spark.createDataFrame([(1, text, 0.0, "")], DOCS)
    found = offending_sentences(one, model).collect()
    assert [(r.sentence, r.words) for r in found] == [(1, "word4 vile word5")]


def test_scores_equal_plain_formula():
    texts, labels = ["a b. c d", "vile x. y", "z z"] * 30, np.array([0.0, 1.0, 0.0] * 30)
    weights, bias = train(texts, labels)
    from oreflow.llm.toxicity import _Weights, features

    text = "A vile, b! c\nd" + " q" * (3 * SENTENCE_WORDS)
    sentences, now = [], []
    for w in [*tokens(text), b"."]:
        if w == b"." or len(now) == SENTENCE_WORDS:
            sentences += [now] if now else []
            now = []
        if w != b".":
            now.append(w)
    logits = [bias + sum(float(weights[f]) for w in set(s) for f in features(w)) for s in sentences]
    assert np.allclose(sentence_scores(text, _Weights(weights), bias)[0], logits)
    once = {frozenset(s): z for s, z in zip(sentences, logits, strict=True)}
    plain = 1 - math.prod(1 - 1 / (1 + math.exp(-z)) for z in once.values())
    assert len(once) < len(sentences) and abs(document_score(text, _Weights(weights), bias) - plain) < 1e-9


def test_without_toxic_labels(spark):
    docs, labels = frames(spark, corpus(20))
    none = toxicity(docs, labels.where("toxic = 0"), held_out(F.col("doc_id"), 5, 0))
    assert none.agg(F.max("predicted")).first()[0] == 0
    assert toxicity(docs.limit(0), labels.limit(0), held_out(F.col("doc_id"), 5, 0)).count() == 0


def test_the_worst_sentence_is_told(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0.0, "") for i, t, _ in rows] + [(9001, None, 0.0, ""), (9002, " . ", 0.0, "")], DOCS)
    labels = spark.createDataFrame([(i, y, "") for i, _, y in rows], LABELS)
    got = {r.doc_id: r for r in toxicity(docs, labels, held_out(F.col("doc_id"), 5, 0)).collect()}
    assert {"doc_id", "held_out", "score", "predicted", "n_offending", "worst_sentence", "worst_score", "worst_words"} == set(got[0].asDict())
    assert all((got[k].score, got[k].n_offending, got[k].worst_sentence, got[k].worst_words) == (0.0, 0, None, None) for k in (9001, 9002))
    model = learn(docs, labels, ~held_out(F.col("doc_id"), 5, 0))
    offending = {}
    for r in offending_sentences(docs, model).collect():
        offending.setdefault(r.doc_id, []).append((-r.score, r.sentence, r.words))
    for i, text, _ in rows:
        worst = min(offending[i]) if i in offending else None
        assert got[i].n_offending == len(offending.get(i, []))
        if worst:
            assert (-got[i].worst_score, got[i].worst_sentence, got[i].worst_words) == worst
        assert got[i].worst_words in " ".join(w.decode() for w in tokens(text)) and got[i].worst_score <= got[i].score + 1e-12
    caught = [i for i, _, y in rows if y and got[i].predicted]
    assert len(caught) > 100 and sum(any(b in got[i].worst_words.split() for b in BAD) for i in caught) > 0.95 * len(caught)
