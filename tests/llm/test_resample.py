from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from oreflow.llm import resample as module
from oreflow.llm.resample import features, joined, resample

DOCS = "doc_id long, text string, bucket string, score string, part string, rank string"
ITEMS = "item_id long, text string, n string"
SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, longest=3):
    w = words(text)
    return [zlib.crc32(" ".join(w[k : k + n]).encode()) % 10_000 for n in range(1, longest + 1) for k in range(len(w) - n + 1)]


def brute(docs, items, least=20, percent=5):
    s, t = Counter(b for _, x in docs for b in grams(x)), Counter(b for x in items for b in grams(x))
    all_s, all_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)}
    rows = []
    for i, x in docs:
        own = grams(x)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def data():
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "ß", "x9", "日本"]
    say = lambda n: " ".join(draw.choice(vocabulary) + draw.choice(["", ",", ".\n", " \x00"]) for _ in range(n))
    docs = [(k, say(draw.randrange(1, 90))) for k in range(300)]
    docs += [(None, say(40)), (500, None), (501, ""), (502, "one"), (503, " . "), (504, "ONE two"), (505, say(20)), (506, say(19)), (7, docs[7][1]), (7, docs[7][1]), (507, "again " * 30_000)]
    return docs, [say(25) for _ in range(30)] + [None, "", "w1"]


@pytest.mark.parametrize("joined_bytes, run", [(module.JOINED, module.RUN), (200, 7), (1, 1)])
def test_equals_brute_force(spark, monkeypatch, joined_bytes, run):
    monkeypatch.setattr(module, "JOINED", joined_bytes)
    monkeypatch.setattr(module, "RUN", run)
    docs, items = data()
    if run == 1:
        docs = docs[:-1]
    got = resample(spark.createDataFrame([(i, t, "b", "s", "p", "r") for i, t in docs], DOCS).repartition(7), spark.createDataFrame([(k, t, "n") for k, t in enumerate(items)], ITEMS))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    mine = sorted((tuple(r) for r in got.collect()), key=repr)
    # Rows that repeat a document have its ranks in any order; sorted they are the same.
    assert mine == brute(docs, items)


def test_features_of_joined_texts():
    texts = [b"a b", b"", b"c", b"A  b,c\xc3\xa9"]
    whole, offsets = joined(texts)
    assert whole == b"a b\x00\x00c\x00a  b,c\xc3\xa9" and offsets.tolist() == [0, 4, 5, 7]
    got = Counter((int(o), int(b)) for owners, own in features(texts) for o, b in zip(owners, own, strict=True))
    assert got == Counter((k, b) for k, t in enumerate(texts) for b in grams(t.decode()))
    assert not list(features([]))
    assert sum(len(o) for o, _ in features([b"x y z"], longest=1)) == 3


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_runs_of_words_hand_on_what_later_ones_need(monkeypatch, run):
    texts = [b" ".join(b"w%d" % (k % 11) for k in range(n)) for n in (0, 1, 2, 3, 4, 17)]
    want = Counter((k, b) for k, t in enumerate(texts) for b in grams(t.decode(), 5))
    monkeypatch.setattr(module, "RUN", run)
    assert Counter((int(o), int(b)) for owners, own in features(texts, longest=5) for o, b in zip(owners, own, strict=True)) == want


def test_ranks_over_many_parts_and_ties(spark):
    rows = [(k % 900, 20 + k % 3, 5, 7, int(np.floor(k / 100))) for k in range(1000)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(13)
    got = module.ranked(scored, 21, 50, module.Store(spark, "ranks")).collect()
    able = sorted((-r[4], r[0]) for r in rows if r[1] >= 21)
    drawn = sorted((r.rank, -r.score, r.doc_id) for r in got if r.rank is not None)
    assert len(got) == 1000 and drawn == [(k + 1, s, i) for k, (s, i) in enumerate(able[: len(able) // 2])]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert resample(docs, items).count() == 0
    one = resample(spark.createDataFrame([(1, "a b", "", "", "", "")], DOCS), items).first()
    assert (one.n_features, one.rank) == (3, None)
