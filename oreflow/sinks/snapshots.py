"""Snapshot tables: every write is a new folder, then a new version names it.

A plan that reads a table can write its successor, readers never meet a half-written table, and
a run that dies before its version stands has changed nothing. A version is made by one writer only.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow import fs
from oreflow.errors import CommitConflict
from oreflow.operators.gold import scd2_apply, scd2_changes, scd2_open
from oreflow.sinks.versions import ATTEMPTS, Versions

BUCKETS = 64
#: So many closed parts of one month and level become one part of the next level.
FAN = 8
_SLOT, _CLOSED = "_slot", "closed"


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with its row count taken along while it is written.

    To be called on the frame a sink writes: in the last stage each task counts once, even when
    lost executors make Spark run tasks again.
    """
    seen = Observation()
    return df.observe(seen, F.count("*").alias("rows")), seen


class Snapshot:
    """A Parquet table that is replaced as a whole.

    A writer first claims a number; of writers at work at the same time the one that claimed last makes the present
    state, and none writes into another's folder.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._versions, self._claims = Versions(spark, path, "_version-"), Versions(spark, path, "_claim-")

    def exists(self) -> bool:
        return bool(self._versions.numbers())

    def read(self) -> DataFrame:
        state = self._versions.last()
        return self.spark.read.schema(state["schema"]).parquet(f"{self.path}/v{state['version']}")

    def write(self, df: DataFrame) -> int:
        """Replace the whole table; returns the rows written."""
        number = self._claimed()
        rows, seen = counted(df)
        rows.write.mode("overwrite").parquet(f"{self.path}/v{number}")
        self._versions.add({"version": number, "schema": df.schema.toDDL()})
        return seen.get["rows"]

    def _claimed(self) -> int:
        while True:
            number = max([0, *self._claims.numbers(), *self._versions.numbers()]) + 1
            if self._claims.add({"version": number}):
                return number

    def discard_old(self, keep: int = 2) -> None:
        """Drop all but the last ``keep`` versions, with folders of that age that never became one."""
        newest = max([0, *self._versions.numbers()])
        for name in fs.folders(self.spark, self.path):
            number = name.removeprefix("v")
            if number.isdigit() and int(number) <= newest - keep:
                fs.delete(self.spark, f"{self.path}/{name}")
        for files in (self._versions, self._claims):
            for number in files.numbers():
                if number <= newest - keep:
                    files.drop(number)


class History:
    """Versioned rows: open ones in hash buckets of the key, closed ones in parts by the time of their end.

    A merge compares keys and hashes, then rewrites only buckets in which a version opens or closes. Closed rows are
    added as a part that no merge reads again. Small closed parts of a month are united level by level; a month or a
    year that is over ends up as one part. Each version holds the schema and, of each closed part, the first and last
    end and the first start, so that a read as of a day opens only parts that can hold rows of it.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.key, self.buckets, self.fan = spark, path.rstrip("/"), list(key), buckets, fan
        self._versions = Versions(spark, f"{self.path}/_versions", "")

    def state(self) -> dict:
        """Version, schema, number of buckets, folder of each open bucket, and the closed parts with their bounds."""
        return {"n": self.buckets, "schema": "", "open": {}, "closed": []} | self._versions.last()

    def exists(self) -> bool:
        return bool(self.state()["version"])

    def read(self) -> DataFrame:
        state = self.state()
        return self._load(state, [*state["open"].values(), *[p["folder"] for p in state["closed"]]])

    def read_open(self) -> DataFrame:
        state = self.state()
        return self._load(state, state["open"].values())

    def read_as_of(self, day: str) -> DataFrame:
        """The versions that hold on ``day``: started by then and not ended."""
        state = self.state()
        parts = [p["folder"] for p in state["closed"] if p["start"] <= day < p["last"]]
        return self._load(state, [*state["open"].values(), *parts]).where((F.col("_eff_start") <= day) & (F.col("_eff_end") > day))

    def _load(self, state: dict, folders: Sequence[str]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in folders]
        # With the schema given no footer is opened for it, and columns that came later are null in older files.
        return self.spark.read.schema(state["schema"]).parquet(*paths) if paths else self.spark.createDataFrame([], state["schema"])

    def _of(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(n)).cast("string")

    def write(self, df: DataFrame) -> int:
        """Open rows of ``df`` replace all open rows, closed ones are added; returns the rows written.

        Another writer's commit meanwhile is a conflict, as ``df`` may come from the state before it.
        """

        def work(state, part):
            return df, {}

        return self._commit(work, 1)

    def merge(self, incoming: DataFrame, tracked: Sequence[str], effective_date: str) -> int:
        """Merge a snapshot of the source, as ``scd2_merge`` does; returns the rows written, kept ones of touched buckets too.

        ``incoming`` should be stored: it is read for its keys and hashes and again for the rows that open. It is
        unique by key. A null key is a key like others. Nothing is written when no version opens.
        """

        def work(state, part):
            opened = scd2_open(incoming, tracked, effective_date)
            if not state["version"]:
                return opened, {}
            current = self._load(state, state["open"].values())
            changes = scd2_changes(current, opened, self.key)
            changes = changes.select(*[F.col(f"`{k}`").cast(current.schema[k].dataType).alias(k) for k in self.key])  # slots depend on types
            changes.withColumn(_SLOT, self._of(state["n"])).write.parquet(f"{part}-changes")
            changes = self.spark.read.parquet(f"{part}-changes")
            met = {r[0] for r in changes.select(_SLOT).distinct().collect()}  # state["n"] at most
            if not met:
                return None, {}
            old = self._load(state, [f for b, f in state["open"].items() if b in met])
            kept = {b: f for b, f in state["open"].items() if b not in met}
            return scd2_apply(old, opened, changes.drop(_SLOT), self.key, effective_date), kept

        written = self._commit(work)
        self.compact()
        return written

    def _commit(self, work, attempts: int = ATTEMPTS) -> int:
        """``work`` gives the rows to write and the open buckets that stay; it is done again when another writer was first."""
        for _ in range(attempts):
            state, part = self.state(), f"part-{uuid4().hex}"
            rows, kept = work(state, f"{self.path}/{part}")
            if rows is None:
                fs.delete(self.spark, f"{self.path}/{part}-changes")
                return 0
            slot = F.when(F.col("_current"), self._of(state["n"])).otherwise(_CLOSED)
            written, bounds = self._put(rows.withColumn(_SLOT, slot).hint("rebalance", _SLOT), part, [_SLOT])
            fs.delete(self.spark, f"{self.path}/{part}-changes")
            names = [n.removeprefix(f"{_SLOT}=") for n in fs.folders(self.spark, f"{self.path}/{part}") if n.startswith(_SLOT)]
            made = state | {
                "version": state["version"] + 1,
                "schema": _wider(state["schema"], rows.schema),
                "open": kept | {n: f"{part}/{_SLOT}={n}" for n in names if n != _CLOSED},
                "closed": state["closed"] + ([{"folder": f"{part}/{_SLOT}={_CLOSED}", "level": 0} | bounds] if _CLOSED in names else []),
            }
            if self._versions.add(made):
                return written
            fs.delete(self.spark, f"{self.path}/{part}")
        raise CommitConflict(f"{self.path}: others committed first, {attempts} times")

    def _put(self, rows: DataFrame, part: str, by: Sequence[str] = ()) -> tuple[int, dict]:
        """Write ``rows``; how many there are, and the bounds of the closed ones."""
        seen, closed = Observation(), ~F.col("_current")
        ends = [F.min(F.when(closed, F.col("_eff_end"))).alias("first"), F.max(F.when(closed, F.col("_eff_end"))).alias("last")]
        start = F.min(F.when(closed, F.col("_eff_start"))).alias("start")
        rows = rows.observe(seen, F.count("*").alias("rows"), *ends, start)
        rows.write.partitionBy(*by).parquet(f"{self.path}/{part}")
        found = seen.get
        return found["rows"], {c: found[c] for c in ("first", "last", "start")}

    def compact(self) -> int:
        """Unite closed parts where :func:`due` says so; returns how many went into others.

        The united part is its own version, so readers and merges go on meanwhile.
        """
        gone = 0
        while group := due(self.state()["closed"], self.fan):
            state, part = self.state(), f"part-{uuid4().hex}"
            names = {p["folder"] for p in group}
            if not names <= {p["folder"] for p in state["closed"]}:
                continue
            rows = self._load(state, sorted(names)).repartitionByRange("_eff_end", *self.key)
            self._put(rows, part)
            one = {
                "folder": part,
                "level": max(p["level"] for p in group) + 1,
                "first": min(p["first"] for p in group),
                "last": max(p["last"] for p in group),
                "start": min(p["start"] for p in group),
            }
            while names <= {p["folder"] for p in state["closed"]}:  # a merge met meanwhile only added parts
                rest = [p for p in state["closed"] if p["folder"] not in names]
                if self._versions.add(state | {"version": state["version"] + 1, "closed": [*rest, one]}):
                    gone += len(group)
                    break
                state = self.state()
            else:
                fs.delete(self.spark, f"{self.path}/{part}")
        return gone

    def discard_old(self, keep: int = 2) -> None:
        """Drop versions older than the last ``keep`` and the folders that only they name."""

        def folders(number):
            state = self._versions.get(number)
            return {*state["open"].values(), *[p["folder"] for p in state["closed"]]}

        numbers = self._versions.numbers()
        needed = set().union(*[folders(n) for n in numbers[-keep:]])
        for number in numbers[:-keep]:
            for folder in folders(number) - needed:
                fs.delete(self.spark, f"{self.path}/{folder}")
            self._versions.drop(number)


def due(closed: list[dict], fan: int = FAN) -> list[dict]:
    """Closed parts to unite next, none if all is well.

    ``fan`` parts of a level that end in the newest month; all parts of a month that is over; all parts of a year that is
    over. A row is so written again once for each level of its month, once for its month and once for its year.
    """
    if not closed:
        return []
    newest = max(p["last"] for p in closed)
    groups: dict[tuple, list[dict]] = defaultdict(list)
    for part in closed:
        year, month = part["last"][:4], part["last"][:7]
        if year < newest[:4]:
            groups[(year,)].append(part)
        elif month < newest[:7]:
            groups[(year, month)].append(part)
        else:
            groups[(year, month, part["level"])].append(part)
    for group, parts in sorted(groups.items()):
        if len(parts) >= (fan if len(group) == 3 else 2):
            return parts
    return []


def _wider(known: str, schema: T.StructType) -> str:
    """The schema of new rows, with columns that only older rows have behind."""
    old = T.StructType.fromDDL(known) if known else T.StructType()
    fields = [f for f in schema.fields if f.name != _SLOT]
    names = {f.name for f in fields}
    return T.StructType([*fields, *[f for f in old.fields if f.name not in names]]).toDDL()
