"""Column expressions and storage shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from string import ascii_lowercase, ascii_uppercase
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow import fs
from oreflow.session import shared_folder

#: Largest table, in estimated bytes, that is sent to every executor.
BROADCAST_BYTES = 8 << 20

#: Bytes of texts that a Python worker is handed at once; Spark's own limit is 64 MB, which a worker and the JVM beside it hold several times.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

#: A-Z to a-z on bytes, for Python workers.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Text without other letters takes the fast built-in."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def row_key(doc_id: Column, text: Column) -> Column:
    """A number for a document, the same for rows that repeat it. Join it together with the id."""
    return F.xxhash64(doc_id, text)


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return (left["row_key"] == right["row_key"]) & left["doc_id"].eqNullSafe(right["doc_id"])


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Is crc32 of the id, written as text, this remainder? A null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


class Store:
    """Tables one operator writes to the shared folder, to cut lineage and to read more than once.

    ``drop`` frees a table that no later step reads. What a returned frame reads has to stay.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.base = spark, shared_folder(spark, purpose)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        fs.delete(self.spark, f"{self.base}/{name}")


def per_process(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker makes once and keeps over the tasks it runs."""
    kept = sys.modules.setdefault("oreflow_per_process", ModuleType("oreflow_per_process"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def release(but: str = "") -> None:
    """Drop what a Python worker keeps, but for the one object named: for tasks that need memory of their own.

    Workers serve one operator after the other, so what the last one freed goes back to the system too: Arrow and the C
    library would keep it for a use of the same kind that may not come.
    """
    kept = sys.modules.get("oreflow_per_process")
    for name in [k for k in vars(kept) if not k.startswith("__") and k != but] if kept else []:
        delattr(kept, name)
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def alone(run: Callable[[Iterator], Iterator], but: str = "") -> Callable[[Iterator], Iterator]:
    """The task with ``release`` before and after it, so an idle worker holds no more than the one object named."""

    def whole(batches: Iterator) -> Iterator:
        release(but)
        yield from run(batches)
        release(but)

    return whole


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in small batches. It holds for the session, as frames run later; a limit set there stays."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


class Remembered(dict):
    """What a Python worker remembers of short texts: ``bound`` bytes at most, for keys of up to ``longest`` characters.

    When half the bytes are full they become the older half and what was the older half is forgotten, so frequent texts stay.
    """

    def __init__(self, bound: int, longest: int = 64):
        super().__init__()
        self.half, self.longest, self.size, self.older = bound // 2, longest, 0, {}

    def recall(self, key):
        """The value from the older half, or None; to be called for keys that the dictionary lacks."""
        value = self.older.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) > self.longest:
            return
        self.size += 220 + 4 * len(key) + (len(value) if type(value) is bytes else 0)  # with the entry itself
        if self.size > self.half:
            self.older, self.size = dict(self), 0
            self.clear()
        self[key] = value


def small(df: DataFrame, row_bytes: int, bound: int = BROADCAST_BYTES) -> bool:
    """Does the frame, counted first, fit the broadcast bound? Count only stored or tiny frames."""
    return df.limit(bound // row_bytes + 1).count() * row_bytes <= bound


def broadcast_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark the frame for broadcast when its counted size is within the bound; else leave the choice to Spark."""
    return F.broadcast(df) if small(df, row_bytes) else df


#: Keys that may meet their rows by broadcast.
HOT_KEYS = 1000


def join_counted(rows: DataFrame, ones: DataFrame, keys: list[str], count: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Inner join of rows with ``ones``, which has one row a key and, in ``count``, how many of the rows have it.

    Keys with more than a ``hot_keys``-th part of all rows, of which there are fewer than that number, go to the rows by
    broadcast; no other key is hot, and those meet by shuffle. Both frames are read more than once: store them first.
    """
    total = ones.agg(F.sum(count)).first()[0]
    if not total:
        return rows.join(ones, keys)
    hot = F.col(count) * hot_keys > total
    if ones.where(hot).isEmpty():
        return rows.join(ones, keys)
    few = F.broadcast(ones.where(hot))
    rest = rows.join(few.select(*keys), keys, "left_anti")
    return rows.join(few, keys).unionByName(rest.join(ones.where(~hot), keys))
