from __future__ import annotations

import random

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, count string, digest int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    draw = random.Random(12)
    say = lambda n: " ".join(f"w{draw.randrange(500)}" for _ in range(n))
    rows = [(k, say(draw.randint(5, 80)), 0) for k in range(300)]
    rows += [(1000 + k, say(20) + ". You vile thing. " + say(10), 1) for k in range(120)]
    leak = say(30)
    long = say(900)
    rows += [(2000, "Copy " + rows[5][1], 0), (2001, "copy " + rows[5][1], 0), (2002, long, 0), (2003, long.replace(" ", "  "), 0), (2004, say(9) + " " + leak + " " + say(9), 0), (2005, say(3000), 0)]
    rows += [(2006, None, 0), (2007, "", 0), (None, "no id here", 0), (None, "NO id here", 0), (2008, "tie tie", 0), (2008, "tie tie", 0)]
    table = [(i, t, "en", "s", len(t or ""), "c", 1) for i, t, _ in rows]
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, say(15)), (3, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_decides(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before, seen = {(r.doc_id, r.text) for r in docs.collect()}, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        path = f"{folder}/stage-{k}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.dtypes == spark.read.parquet(f"{folder}/documents.parquet").dtypes
            now = {(r.doc_id, r.text) for r in docs.collect()}
            seen[name], before = before - now, now
            assert docs.count() >= len(now)
    ids = {name: {i for i, _ in gone} for name, gone in seen.items()}
    toxic = {1000 + k for k in range(120)}
    assert len(ids["toxicity"] & toxic) > 110 and not ids["toxicity"] - toxic
    assert ids["exact_dedup"] == {2000, 2006, None}
    assert 2003 in ids["simhash_dedup"] and not ids["simhash_dedup"] & set(range(300))
    assert ids["decontamination"] == {2004}
    packed = {r.doc_id for r in docs.collect()}
    assert packed == {i for i, _ in before}
    assert docs.where("doc_id = 2008 AND piece = 0").count() == 1


def test_run_equals_its_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "sequence_id", "offset"} <= set(got.columns)
    assert got.where("doc_id = 2004").isEmpty() and got.where("doc_id = 2007").count() == 1


@pytest.mark.parametrize("name", ["toxicity", "exact_dedup", "simhash_dedup", "decontamination"])
def test_stages_keep_columns_of_any_name_and_repeated_rows(spark, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [(1, "some words that stand here", "a"), (1, "some words that stand here", "b"), (2, None, "c"), (2, None, "d"), (None, "", "e"), (3, "x" * 50_000, "f")]
    extra = ["key", "Key_", "score", "__score", "row_key", "root", "members", "__digest"]
    docs = spark.createDataFrame([(i, t, *[v] * len(extra)) for i, t, v in rows], f"doc_id long, text string, {', '.join(f'`{c}` string' for c in extra)}")
    out = stage(spark, docs, folder)
    assert out.columns == docs.columns
    got = out.collect()
    assert all(len(set(r[2:])) == 1 for r in got)
    ids = sorted((r.doc_id is None, r.doc_id) for r in got)
    want = {"exact_dedup": [1, 2, 3], "simhash_dedup": [1, 2, 3]}.get(name, [1, 1, 2, 2, 3, None])
    assert [i for _, i in ids] == want


def test_stages_of_an_empty_table(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)
