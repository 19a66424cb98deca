"""What outlives a run: one high-water mark per source and the run history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreflow.errors import CommitConflict
from oreflow.sinks.versions import Versions

RUN_SCHEMA = (
    "date string, status string, error string, started_at string, finished_at string, duration_sec double, "
    "stages array<struct<stage:string,status:string,error:string,duration_sec:double,counts:map<string,bigint>,reasons:map<string,bigint>>>"
)


#: Older versions of the marks that stay for a look back.
_KEPT = 20
_ANY = object()


class RunState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._versions = Versions(spark, f"{path}/marks", "")

    def marks(self) -> dict[str, str]:
        return self._versions.last().get("marks", {})

    def mark(self, source: str) -> str | None:
        return self.marks().get(source)

    def set_mark(self, source: str, value: str, seen: object = _ANY) -> None:
        """Move one mark; other marks that other writers move meanwhile stay moved.

        With ``seen``, the mark the load began from, a mark that another run has moved since is a conflict: it may
        stand behind or before rows of this load, so the next run has to look again.
        """
        while True:
            state = self._versions.last()
            marks = state.get("marks", {})
            if seen is not _ANY and marks.get(source) != seen:
                raise CommitConflict(f"{source}: mark is {marks.get(source)!r}, the load began from {seen!r}")
            if self._versions.add({"version": state["version"] + 1, "marks": marks | {source: value}}):
                break
        for number in self._versions.numbers()[:-_KEPT]:
            self._versions.drop(number)

    def record(self, run: dict) -> None:
        """Append one run to the history table."""
        row = self.spark.createDataFrame([run], RUN_SCHEMA).coalesce(1)
        row.write.mode("append").json(f"{self.path}/run_history")

    def history(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).json(f"{self.path}/run_history")
