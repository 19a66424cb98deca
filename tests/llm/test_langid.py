from __future__ import annotations

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from oreflow.llm.common import held_out
from oreflow.llm.langid import SMOOTHING, identify, learn

SCHEMA = "doc_id long, text string, lang string, source string, score double, bucket int"
SYLLABLES = {"aa": ["the", "ing", "er", "on"], "bb": ["sch", "ung", "ein", "ö"], "cc": ["ción", "que", "ñ", "os"]}


def corpus(n=240):
    draw = random.Random(11)
    rows = []
    for k in range(n):
        lang = draw.choice(sorted(SYLLABLES))
        words = ["".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(4, 60))]
        rows.append((k, " ".join(words).capitalize() + ".", lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0.0, 0) for i, t, g in rows], SCHEMA)


def test_held_out_accuracy_and_edges(spark):
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "123 !?", "cc"), (903, "the thing", None), (None, "schung ein", "bb"), (904, "the " * 60_000, "aa"), (905, "x\x00y the", None), (906, "tie", "aa"), (906, "tie", "aa"), (907, "日本", None)]
    docs = frame(spark, corpus() + odd)
    held = held_out(F.col("doc_id"), 4, 2)
    got = identify(docs, ~held, held).collect()
    assert len(got) == 250
    by_id = {r.doc_id: r for r in got}
    assert [by_id[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and by_id[900].score == 0
    assert by_id[903].lang_pred == "aa" and by_id[None].lang_pred == "bb" and by_id[904].lang_pred == "aa"
    tested = [(r.lang_pred, lang) for (i, _, lang), r in ((row, by_id[row[0]]) for row in corpus()) if r.held_out]
    assert len(tested) > 30 and all(a == b for a, b in tested)
    assert all(0 <= r.score <= 1 for r in got)


def test_counts_equal_brute_force(spark):
    rows = corpus(40)
    names, prior, likely = learn(frame(spark, rows), F.lit(True), bits=20)
    for k, lang in enumerate(names):
        counted = Counter()
        for _, text, own in rows:
            if own == lang:
                s = "".join(c if c.isalpha() else " " for c in text.lower())
                counted.update(s[a : a + n] for n in (1, 2, 3) for a in range(len(s) - n + 1) if s[a : a + n].strip())
        total = sum(counted.values()) + SMOOTHING * (1 << 20)
        top = math.log((counted.most_common(1)[0][1] + SMOOTHING) / total)
        assert abs(likely[k].max() - top) < 0.05
        assert abs(prior[k] - math.log(sum(x[2] == lang for x in rows) / 40)) < 1e-9


def test_nothing_to_learn(spark):
    held = held_out(F.col("doc_id"), 4, 2)
    docs = frame(spark, [(1, "some text", None)])
    assert [(r.lang_pred, r.score) for r in identify(docs, ~held, held).collect()] == [("und", 0.0)]
    assert identify(docs.limit(0), ~held, held).count() == 0
