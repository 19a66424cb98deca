"""Bucketed tables: what an upsert touches, and two writers at once."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oreflow import fs
from oreflow.errors import CommitConflict
from oreflow.sinks import buckets
from oreflow.sinks.buckets import Buckets


def rows(spark, ids, value):
    return spark.createDataFrame([(i, value) for i in ids], "id long, v string")


def content(table):
    return {r.id: r.v for r in table.read().collect()}


def test_upsert_leaves_other_buckets_files_alone(spark, tmp_path):
    table = Buckets(spark, str(tmp_path / "t"), ["id"], 16)
    assert not table.exists() and table.write(rows(spark, range(1000), "a")) == 1000
    before = table.state()["folders"]
    files = {f: f.stat().st_mtime_ns for f in Path(tmp_path / "t").rglob("*.parquet")}
    written = table.upsert(rows(spark, [3, 4, 5000], "b"))
    after = table.state()["folders"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 3 and written < 300
    assert content(table) == {i: "a" for i in range(1000)} | {3: "b", 4: "b", 5000: "b"}
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    wider = spark.createDataFrame([(7, "c", 1.5)], "id long, v string, extra double")
    table.upsert(wider)
    assert {r.id: r.extra for r in table.read().where("id IN (7, 8)").collect()} == {7: 1.5, 8: None}
    table.upsert(rows(spark, [], "none"))
    assert table.read().count() == 1001
    table.discard_old(1)
    assert table.read().count() == 1001 and len(fs.files(spark, f"{tmp_path}/t/_manifests")) == 1


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    one, other = (Buckets(spark, str(tmp_path / "t"), ["id"], 4) for _ in range(2))
    one.write(rows(spark, range(10), "a"))
    real, met = fs.create_text, []

    def between(session, path, text):
        if not met:  # while the first writer is about to commit, the second one does
            met.append(path)
            other.upsert(rows(spark, [1, 20], "other"))
        return real(session, path, text)

    monkeypatch.setattr(buckets.fs, "create_text", between)
    one.upsert(rows(spark, [1, 2], "one"))
    assert content(one) == {i: "a" for i in range(10)} | {1: "one", 2: "one", 20: "other"}
    assert one.state()["version"] == 3


def test_a_writer_gives_up_without_a_trace(spark, tmp_path, monkeypatch):
    table = Buckets(spark, str(tmp_path / "t"), ["id"], 4)
    table.write(rows(spark, range(4), "a"))
    monkeypatch.setattr(buckets.fs, "create_text", lambda *_: False)
    with pytest.raises(CommitConflict):
        table.upsert(rows(spark, [1], "b"))
    assert content(table) == dict.fromkeys(range(4), "a") and len(fs.folders(spark, f"{tmp_path}/t")) == 2


def test_create_text_is_made_once(spark, tmp_path):
    path = str(tmp_path / "x/1.json")
    assert fs.create_text(spark, path, "a") and not fs.create_text(spark, path, "b")
    assert fs.read_text(spark, path) == "a" and fs.files(spark, str(tmp_path / "x")) == ["1.json"]


def test_one_key_of_each_bucket_is_enough(spark, tmp_path):
    table = Buckets(spark, str(tmp_path / "t"), ["id"], 3)
    table.upsert(rows(spark, range(30), "a"))
    assert table.read().where(F.col("v") == "a").count() == 30
