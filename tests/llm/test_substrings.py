from __future__ import annotations

import hashlib
import random

import pytest

from oreflow.llm.substrings import remove_repeats

SCHEMA = "doc_id long, text string, key string, start string, row_key string"


def brute(rows, length):
    first = {}
    for i, text in rows:
        words = (text or "").split()
        for s in range(len(words) - length + 1):
            window = tuple(words[s : s + length])
            rank = float("inf") if i is None else i
            first[window] = min(first.get(window, rank), rank)
    out = []
    for i, text in rows:
        words, gone = (text or "").split(), set()
        for s in range(len(words) - length + 1):
            if first[tuple(words[s : s + length])] < (float("inf") if i is None else i):
                gone |= set(range(s, s + length))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(length):
    draw = random.Random(9)
    say = lambda n, size=400: [f"w{draw.randrange(size)}" for _ in range(n)]
    shared = [say(int(length * 2.3)) for _ in range(5)]
    rows = []
    for k in range(60):
        passage = list(draw.choice(shared))
        if k % 4 == 0:
            passage[draw.randrange(len(passage))] = "edit"
        cut = draw.randrange(len(passage) // 2)
        rows.append((draw.randrange(10_000), " ".join(say(draw.randrange(30)) + passage[cut:] + say(draw.randrange(30)))))
    whole = " ".join(say(120))
    low = " ".join(say(300, 2))
    return rows + [(20_001, whole), (20_002, whole), (20_002, whole), (None, whole), (20_003, None), (20_004, ""), (20_005, " \t\n"), (20_006, "a " * 5000), (20_007, "a " * 300 + "b"), (20_008, low), (20_009, low[20:]), (20_010, whole.replace(" ", "\n\t ")), (20_011, "É " * 70), (20_012, "é " * 70)]


@pytest.mark.parametrize(("length", "group_contexts"), [(50, 50_000), (50, 3), (10, 50_000), (4, 50_000)])
def test_equals_brute_force(spark, length, group_contexts):
    rows = corpus(length)
    frame = spark.createDataFrame([(i, t, "k", "s", "r") for i, t in rows], SCHEMA)
    got = remove_repeats(frame, length, group_contexts).drop("kept", "spans").collect()
    want = brute(rows, length)
    assert sorted([tuple(r) for r in got], key=repr) == want
    assert sum(r[2] > 0 for r in want) > 40


def test_kept_text_and_spans(spark):
    common = " ".join(f"c{k}" for k in range(60))
    frame = spark.createDataFrame([(1, common, "", "", ""), (2, f"x y {common} z", "", "", "")], SCHEMA)
    got = {r.doc_id: r for r in remove_repeats(frame).collect()}
    assert got[1].kept == common and got[2].kept == "x y z"
    assert [tuple(s) for s in got[2].spans] == [(2, 62)] and got[1].spans == []
    assert remove_repeats(frame.limit(0)).count() == 0
