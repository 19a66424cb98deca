from __future__ import annotations

import numpy as np
import pytest

from oreflow.llm.caps import decoded, near_vectors, product_codes, units_of
from oreflow.llm.common import join_counted

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n string, filter string, root string, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, k, "n", "n", "f", "r", "c") for i, e, k in rows], SCHEMA)


def usable(e, k):
    return k is not None and e is not None and len(e) > 0 and None not in e and bool(np.isfinite(np.array(e, dtype=np.float32)).all()) and any(e)


def brute(rows, least=0.93):
    n = len(rows)
    links, group = [0] * n, list(range(n))
    points = [np.array(e, dtype=np.float32).astype(np.float64) if usable(e, k) else None for _, e, k in rows]
    pairs = 0
    for x in range(n):
        for y in range(x):
            a, b = points[x], points[y]
            if a is not None and b is not None and rows[x][2] == rows[y][2] and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                links[x] += 1
                links[y] += 1
                pairs += 1
                if group[x] != group[y]:
                    group = [group[y] if g == group[x] else g for g in group]
    out = []
    for x, (i, _, _) in enumerate(rows):
        ids = [rows[y][0] for y in range(n) if group[y] == group[x] and rows[y][0] is not None]
        least_id = min(ids) if ids else None
        out.append((i, links[x], least_id, i == least_id))
    return sorted(out, key=repr), pairs


def near(rng, base, cosine):
    unit = base / np.linalg.norm(base)
    other = rng.normal(size=len(base))
    other -= other @ unit * unit
    return unit * cosine + other / np.linalg.norm(other) * np.sqrt(1 - cosine**2)


def corpus():
    rng, rows, i = np.random.default_rng(4), [], 0
    for label in range(3):
        for _ in range(12):
            base = rng.normal(size=64)
            group = [base, base * 3, base]
            for cosine in (0.999, 0.97, 0.95, 0.94, 0.92, 0.9):
                group.append(near(rng, base, cosine) * rng.uniform(0.1, 9))
            rows += [(i := i + 1, g.tolist(), label) for g in group]
        rows += [(i := i + 1, rng.normal(size=64).tolist(), label) for _ in range(40)]
    one = rows[0][1]
    odd = [(5000, None, 0), (5001, [], 0), (5002, [0.0] * 64, 0), (5003, [None, *one[1:]], 0), (5004, [float("nan"), *one[1:]], 0), (5005, [float("inf"), *one[1:]], 0)]
    odd += [(5006, one, None), (5007, one, 7), (None, one, 0), (None, [1.0] * 64, 9), (5008, one[:63], 0), (1, one, 0), (5009, [1.0, 0.1], 1), (5010, [1.0, 0.2], 1), (5011, [0.0, 1.0], 1), (5012, [1e-40] * 64, 1)]
    return rows + odd


@pytest.mark.parametrize("tile", [2048, 3])
def test_equals_brute_force(spark, tile):
    rows = corpus()
    got = near_vectors(frame(spark, rows).repartition(5), tile=tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want, pairs = brute(rows)
    assert pairs > 300
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_one_large_group_of_near_copies_and_one_hot_vector(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=64)
    rows = [(k, near(rng, base, rng.uniform(0.94, 1)).tolist(), 1) for k in range(700)] + [(1000 + k, base.tolist(), 1) for k in range(500)] + [(2000 + k, rng.normal(size=64).tolist(), 1) for k in range(300)]
    got = {r.vec_id: r for r in near_vectors(frame(spark, rows), tile=128).collect()}
    points = np.array([e for _, e, _ in rows], dtype=np.float32).astype(np.float64)
    units = points / np.linalg.norm(points, axis=1, keepdims=True)
    links = (units @ units.T >= 0.93).sum(axis=1) - 1
    mine = np.array([got[i].n_links for i, _, _ in rows])
    assert (mine <= links).all() and mine.sum() >= 0.995 * links.sum()
    assert {got[k].component_id for k in range(700)} == {0} and sum(r.kept for r in got.values()) == 301


def test_recall_at_the_threshold():
    rng = np.random.default_rng(6)
    one = rng.normal(size=(1500, 64))
    other = np.array([near(rng, v, 0.93) for v in one])
    codes = product_codes(64, 20, 2, 64)
    filters = []
    for side in (one, other):
        owner, found = decoded(units_of(side), 3.36 / 8, codes)
        filters.append([set(found[owner == k].tolist()) for k in range(len(side))])
        assert 15 < len(found) / len(side) < 25
    assert np.mean([not a.isdisjoint(b) for a, b in zip(*filters, strict=True)]) > 0.98


@pytest.mark.parametrize("blocks", [1, 2, 3])
def test_list_decoding_finds_every_filter_exceeded(blocks):
    rng = np.random.default_rng(7)
    units, codes = units_of(rng.normal(size=(50, 40))), product_codes(40, 3, blocks, 9)
    owner, found = decoded(units, 0.3, codes)
    want = set()
    for nth, (rotation, parts) in enumerate(codes):
        for choice in np.ndindex(*[9] * blocks):
            direction = np.concatenate([words[c] for c, (_, words) in zip(choice, parts, strict=True)])
            number = nth * 9**blocks + int(np.ravel_multi_index(choice, [9] * blocks))
            want |= {(int(k), number) for k in np.flatnonzero(units @ rotation @ direction >= 0.3)}
    assert set(zip(owner.tolist(), found.tolist(), strict=True)) == want and len(owner) == len(want) > 0


def test_empty_table(spark):
    assert near_vectors(frame(spark, [])).count() == 0


@pytest.mark.parametrize("hot_keys", [1, 4, 1000])
def test_join_counted_is_an_inner_join(spark, hot_keys):
    rows = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(60)] + [(None, 99)], "key int, v int")
    ones = rows.where("key IS NOT NULL").groupBy("key").count().where("key <> 5")
    want = rows.join(ones, "key").collect()
    assert sorted(join_counted(rows, ones, ["key"], "count", hot_keys).collect()) == sorted(want)
    assert join_counted(rows, ones.limit(0), ["key"], "count").count() == 0
