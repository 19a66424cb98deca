from __future__ import annotations

import hashlib
import random
import re

import pytest

from oreflow.llm.decontam import contamination, proximity_matches

DOCS = "doc_id long, text string, term string, pos string, words string"
ITEMS = "item_id long, text string, query string"
SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, length=10):
    out = []
    for i, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            q = words(t)
            for s in range(max(1, len(q) - length + 1)) if q else ():
                part = q[s : s + length]
                for k in range(len(w) - len(part) + 1):
                    if w[k : k + len(part)] == part:
                        hit |= set(range(k, k + len(part)))
                        if item is not None:
                            ids.add(str(item))
        joined = ",".join(sorted(ids)).encode()
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(joined).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def data():
    draw = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)] + ["Été", "ß", "x9"]
    say = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(k, say(25)) for k in range(8)] + [(20, "Short item, three"), (21, None), (22, ""), (23, "..."), (None, say(12)), (24, "the"), (25, "the the the")]
    items += [(30, items[0][1]), (31, items[0][1])]
    docs = [(k, say(60) + ". " + items[k % 8][1][: 40 + 9 * k] + " , " + say(30)) for k in range(20)]
    docs += [(50, "short ITEM three"), (51, None), (52, ""), (53, "the the the the"), (None, items[12][1]), (54, "ÉTÉ " + items[2][1].upper())]
    docs += [(55, items[1][1]), (55, items[1][1]), (55, say(5)), (56, "the " * 30_000), (57, say(20_000) + items[3][1])]
    return docs, items


@pytest.mark.parametrize("length", [10, 3])
def test_equals_brute_force(spark, length):
    docs, items = data()
    docs = docs if length == 10 else docs[:-2]
    frame = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in docs], DOCS)
    bench = spark.createDataFrame([(i, t, "q") for i, t in items], ITEMS)
    got = contamination(frame, bench, length).drop("row_key").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(docs, items, length)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", "", "")], DOCS), spark.createDataFrame([], ITEMS)
    assert [r.contaminated for r in contamination(docs, items).collect()] == [False]
    assert contamination(docs.limit(0), items).count() == 0


def test_proximity(spark):
    docs = [(1, "red filler filler green filler blue"), (2, "red " + "filler " * 50 + "green blue"), (3, "green blue"), (4, "solo red")]
    frame = spark.createDataFrame([(i, t, "", "", "") for i, t in docs], DOCS)
    items = spark.createDataFrame([(7, "red green blue", ""), (8, "solo", "")], ITEMS)
    got = {(r.doc_id, r.item_id, r.width) for r in proximity_matches(frame, items, slop=10).collect()}
    assert got == {(1, 7, 6), (4, 8, 1)}
