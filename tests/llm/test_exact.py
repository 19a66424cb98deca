from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from oreflow.llm.exact import exact_duplicates

SCHEMA = "doc_id long, text string, digest string, salt string, content string"


def brute(rows):
    low = [(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for i, t in rows]
    out = []
    for i, t in low:
        ids = [j for j, u in low if u == t]
        known = [j for j in ids if j is not None]
        keep = max(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


CASES = [(1, "Abc"), (2, "aBC"), (3, "Äbc"), (4, "äbc"), (5, None), (6, ""), (None, "abc"), (None, "x"), (7, "w " * 50_000), (8, "W " * 50_000), (9, "tie"), (9, "tie")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "d", "s", "c") for i, t in rows], SCHEMA)


def test_equals_brute_force(spark):
    got = sorted([tuple(r) for r in exact_duplicates(frame(spark, CASES)).collect()], key=repr)
    assert got == brute(CASES)


def test_contents_with_one_digest_stay_apart(spark):
    weak = exact_duplicates(frame(spark, CASES), salts=3, digest=lambda c: F.length(c).cast("string"))
    assert sorted([tuple(r) for r in weak.collect()], key=repr) == brute(CASES)


def test_hot_text_and_empty_table(spark):
    rows = [(i, "same") for i in range(300)] + [(1000 + i, f"other {i}") for i in range(20)]
    got = exact_duplicates(frame(spark, rows)).where("kept").orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [299, *range(1000, 1020)] and got[0].group_size == 300
    assert exact_duplicates(frame(spark, [])).count() == 0
