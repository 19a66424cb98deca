"""A keyed Parquet table in hash buckets, of which an upsert rewrites only those that hold incoming keys.

A manifest names the folder of each bucket. Every commit is a new manifest, made only if no other writer has made
the one of that number: the loser reads the table again and does its work once more. Readers see whole commits,
and a run that dies before its manifest stands has changed nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow import fs
from oreflow.errors import CommitConflict
from oreflow.operators.upsert import upsert

BUCKETS = 64
ATTEMPTS = 5
_BUCKET = "_bucket"


class Buckets:
    """``buckets`` is fixed by the first commit. Rows must be unique by key."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets

    def state(self) -> dict:
        """The last manifest: version, schema, number of buckets, and the folder of each bucket that has rows."""
        names = fs.files(self.spark, f"{self.path}/_manifests")
        text = fs.read_text(self.spark, f"{self.path}/_manifests/{names[-1]}") if names else None
        return json.loads(text) if text else {"version": 0, "n": self.buckets, "folders": {}}

    def exists(self) -> bool:
        return bool(self.state()["version"])

    def read(self) -> DataFrame:
        return self._load(self.state(), None)

    def _load(self, state: dict, buckets: Sequence[int] | None) -> DataFrame:
        folders = [f for b, f in state["folders"].items() if buckets is None or int(b) in buckets]
        reader = self.spark.read.schema(state["schema"])  # no footer is opened for it; columns that came later are null
        return reader.parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], state["schema"])

    def _of(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(n)).cast("int")

    def write(self, rows: DataFrame) -> int:
        """Replace the whole table; returns the rows written."""
        return self._commit(rows, whole=True)

    def upsert(self, rows: DataFrame) -> int:
        """Replace the rows with incoming keys and add the new keys; returns the rows written, kept ones of their buckets too.

        ``rows`` should be stored: they are read for their buckets and again for the merge.
        """
        return self._commit(rows, whole=False)

    def _commit(self, rows: DataFrame, whole: bool) -> int:
        for _ in range(ATTEMPTS):
            state = self.state()
            whole = whole or not state["version"]
            merged, folders = rows, {}
            if not whole:
                met = {r[0] for r in rows.select(self._of(state["n"])).distinct().collect()}  # state["n"] at most
                if not met:
                    return 0
                merged = upsert(self._load(state, met), rows, self.key)
                folders = {b: f for b, f in state["folders"].items() if int(b) not in met}
            part = f"part-{uuid4().hex}"
            out = merged.withColumn(_BUCKET, self._of(state["n"])).hint("rebalance", _BUCKET)
            out.write.partitionBy(_BUCKET).parquet(f"{self.path}/{part}")
            new = {name.removeprefix(f"{_BUCKET}="): f"{part}/{name}" for name in fs.folders(self.spark, f"{self.path}/{part}") if name.startswith(_BUCKET)}
            folders |= new
            made = {"version": state["version"] + 1, "n": state["n"], "schema": merged.schema.toDDL(), "folders": folders}
            if fs.create_text(self.spark, f"{self.path}/_manifests/{made['version']:012d}.json", json.dumps(made)):
                return self._load(made, [int(b) for b in new]).count()  # from the footers
            fs.delete(self.spark, f"{self.path}/{part}")
        raise CommitConflict(f"{self.path}: others committed {ATTEMPTS} times meanwhile")

    def discard_old(self, keep: int = 2) -> None:
        """Drop manifests older than the last ``keep`` and the folders that no other one names."""
        names = fs.files(self.spark, f"{self.path}/_manifests")
        texts = {n: json.loads(fs.read_text(self.spark, f"{self.path}/_manifests/{n}")) for n in names}
        needed = {f for n in names[-keep:] for f in texts[n]["folders"].values()}
        for name in names[:-keep]:
            for folder in {*texts[name]["folders"].values()} - needed:
                fs.delete(self.spark, f"{self.path}/{folder}")
            fs.delete(self.spark, f"{self.path}/_manifests/{name}")
