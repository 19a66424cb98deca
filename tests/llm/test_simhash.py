from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from oreflow.llm.simhash import forest, linked_pairs, near_duplicates

SCHEMA = "doc_id long, text string, value string, root string, a long"


def mark(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, budget=2):
    marks = [mark(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for x in range(len(rows)):
            for y in range(x):
                if (marks[x] ^ marks[y]).bit_count() <= budget and group[x] != group[y]:
                    group[x] = group[y] = min(group[x], group[y])
                    changed = True
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [j for g, (j, _) in zip(group, rows, strict=True) if g == group[k] and j is not None]
        out.append((i, f"{marks[k]:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def corpus():
    draw = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows = [(None, "lonely text here"), (1, None), (2, ""), (3, "  \n\t"), (4, "One"), (5, "one"), (6, "two words"), (7, "x " * 40_000)]
    for g in range(6):
        base = [draw.choice(words) for _ in range(250)]
        for c in range(12):
            copy = list(base)
            if c % 3:
                copy[draw.randrange(250)] = draw.choice(words)
            rows.append((100 + g * 20 + c, " ".join(copy)))
    return rows + [(9, "tie tie tie tie"), (9, "tie tie tie tie")]


@pytest.mark.parametrize("subtree_rows", [200_000, 1])
def test_equals_brute_force(spark, subtree_rows):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, "v", "r", 0) for i, t in rows], SCHEMA)
    got = near_duplicates(frame, subtree_rows=subtree_rows).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows)
    assert len({r.component_id for r in got}) < len({r.fingerprint for r in got}) - 5


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("budget", [0, 1, 2, 4])
def test_trie_walk_finds_every_pair(budget):
    rng = np.random.default_rng(budget)
    centres = rng.integers(0, 2**63, 20, dtype=np.uint64)
    values = [c ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, 3, replace=False)) for c in centres for _ in range(60)]
    values = np.unique(np.array([*values, 0, 2**64 - 1], dtype=np.uint64))
    found = {(int(i), int(j)) for a, b in linked_pairs(values, 0, budget) for i, j in zip(a, b, strict=True)}
    real = {(i, j) for j in range(len(values)) for i in range(j) if int(values[i] ^ values[j]).bit_count() <= budget}
    assert found == real
    left, right = forest(values, 0, budget)
    assert len(left) == len(right) < len(values)
