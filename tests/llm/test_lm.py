from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm.common import held_out
from oreflow.llm.lm import CELLS, PER_OCTAVE, _cell, _pack, _slim, _unpack, _wide, learn_weights, score_documents

SCHEMA = "doc_id long, text string, score double, chunk int, part int"


def corpus():
    draw = random.Random(8)
    vocabulary = [f"w{int(draw.paretovariate(0.7))}" for _ in range(400)]
    follow = {w: draw.sample(vocabulary, 3) for w in set(vocabulary)}
    rows = []
    for k in range(160):
        words = [draw.choice(vocabulary)]
        for _ in range(draw.randint(0, 60)):
            words.append(draw.choice(follow[words[-1]]) if draw.random() < 0.7 else draw.choice(vocabulary))
        rows.append((k, " ".join(words).capitalize()))
    return rows + [(500, None), (501, ""), (502, " \n\t"), (503, "newword another"), (None, "w1 w2"), (504, "w1 " * 50_000), (505, "tie w1"), (505, "tie w1"), (506, "É é")]


def words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split() + [b"\n"]


@pytest.mark.parametrize("chunk_bytes", [12 << 20, 20_000])
def test_equals_brute_force(spark, chunk_bytes):
    rows = corpus()
    held, fold = held_out(F.col("doc_id"), 7, 2), held_out(F.col("doc_id"), 7, 3)
    frame = spark.createDataFrame([(i, t, 0.0, 1, 2) for i, t in rows], SCHEMA)
    parts = {(r[0], r[1]): (r[2], r[3]) for r in frame.select("doc_id", "text", held, fold).collect()}
    one, two, kept_one, kept_two, cells = Counter(), Counter(), Counter(), Counter(), Counter()
    for i, t in rows:
        out, deleted = parts[i, t]
        w = words(t)
        if not out:
            one.update(w)
            two.update(zip([b"\n", *w], w, strict=False))
            if not deleted:
                kept_one.update(w)
                kept_two.update(zip([b"\n", *w], w, strict=False))
    n, v, kept = sum(one.values()), len(one), sum(kept_one.values())
    for i, t in rows:
        if parts[i, t] == (False, True):
            w = words(t)
            for h, x in zip([b"\n", *w], w, strict=False):
                cell = [int(_cell(np.array([a / b if b else 0.0]))[0]) for a, b in ((kept_two[h, x], kept_one[h]), (kept_one[x], kept))]
                cells[kept_one[h].bit_length(), *cell] += 1
    mix = learn_weights([(*k, c) for k, c in cells.items()], len(kept_one))
    want = []
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w)
        own = 0.0
        for h, x in zip([b"\n", *w], w, strict=False):
            m = mix[one[h].bit_length()]
            own += math.log10(m[0] * (two[h, x] / one[h] if one[h] else 0) + m[1] * one[x] / n + m[2] / (v + 1))
        want.append((i, parts[i, t][0], len(w), sum(one[x] > 0 for x in w), n, base, own))
    got = [tuple(r) for r in score_documents(frame, held, fold, chunk_bytes).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9)
    tested = [r for r in got if r[1] and r[2] > 5]
    assert sum(r[6] for r in tested) > sum(r[5] for r in tested)


def test_probabilities_sum_to_one():
    weights = learn_weights([(3, 5, 9, 40), (3, 0, 12, 10), (0, 0, 4, 7)], 50)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0 and weights.min() >= 0


def test_packing_round_trips():
    hashes = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64))
    assert (_unpack(_pack(hashes)) == hashes).all()
    for top in (5, 300, 70_000, 2**40):
        counts = np.array([0, 1, top])
        assert (_wide(_slim(counts)) == counts).all()
    assert _cell(np.array([0.0, 1.0, 0.5])).tolist() == [0, 1, 1 + PER_OCTAVE] and _cell(np.array([1e-300]))[0] == CELLS - 1


def test_empty_tables(spark):
    frame = spark.createDataFrame([(2, "a b", 0.0, 1, 2)], SCHEMA)
    alone = score_documents(frame, F.lit(True), F.lit(False)).first()
    assert (alone.train_tokens, alone.n_known) == (0, 0) and alone.score < 0.1
    assert score_documents(frame.limit(0), F.lit(False), F.lit(False)).count() == 0
