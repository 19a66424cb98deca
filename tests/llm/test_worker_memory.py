from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oreflow.llm import nearcopies, packing, simhash, toxicity
from oreflow.llm.common import BATCH_BYTES, BATCH_LIMIT, alone, per_process, small_batches

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = np.zeros(1 << toxicity.FEATURE_BITS, dtype=np.float32), -7.0
STEPS = {
    "toxicity": lambda docs: toxicity.score(docs, MODEL, ["doc_id", "text"]),
    "offending": lambda docs: toxicity.offending_sentences(docs, MODEL),
    "sketches": nearcopies._sketches,
    "fingerprints": simhash.fingerprints,
    "packing": lambda docs: packing.pieces(docs, PATH),
}


@pytest.fixture
def unset(spark):
    before = spark.conf.get(BATCH_LIMIT, None)
    spark.conf.unset(BATCH_LIMIT)
    yield
    spark.conf.set(BATCH_LIMIT, before) if before else spark.conf.unset(BATCH_LIMIT)


@pytest.mark.parametrize("step", STEPS)
def test_texts_come_in_small_batches(spark, unset, step):
    def largest(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max(b.nbytes for b in batches)])], names=["n"])

    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"))
    STEPS[step](docs)
    assert docs.mapInArrow(largest, "n long").first().n < 2 * BATCH_BYTES


def test_a_limit_that_the_session_sets_stays(spark, unset):
    spark.conf.set(BATCH_LIMIT, "1m")
    small_batches(spark)
    assert spark.conf.get(BATCH_LIMIT) == "1m"


@pytest.mark.parametrize("step", STEPS)
def test_an_idle_worker_keeps_nothing_of_another_operator(spark, monkeypatch, step):
    docs, tasks = spark.createDataFrame([(1, "some words")], "doc_id long, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda rows, task, schema: tasks.append(task))
    STEPS[step](docs)
    other = []

    def batches():
        other.append(per_process("test-other", list))  # made while the task runs
        yield from ()

    assert list(tasks[0](batches())) == []
    assert per_process("test-other", list) is not other[0]


def test_memory_is_given_back_after_the_locals_are_gone(monkeypatch):
    from oreflow.llm import common

    class Large:
        alive = 0

        def __init__(self):
            Large.alive += 1

        def __del__(self):
            Large.alive -= 1

    def run(batches):
        own = Large()
        for batch in batches:
            yield batch, type(own).alive

    seen = []
    monkeypatch.setattr(common, "release", lambda but="": seen.append((but, Large.alive)))
    assert list(alone(run, "mine")(iter([1, 2]))) == [(1, 1), (2, 1)]
    assert seen == [("mine", 0), ("mine", 0)]
