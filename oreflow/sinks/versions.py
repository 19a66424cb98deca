"""Numbered small files of which each is made by one writer only; the last one is the state.

A commit is the file of the next number, made only if it is not there. Who comes second looks at the state again
and does its work once more, so no commit is lost under another one.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from oreflow import fs

#: How often a writer starts again after others committed first.
ATTEMPTS = 5


class Versions:
    """The files ``prefix`` + number of a folder. Other files in it are left alone."""

    def __init__(self, spark: SparkSession, folder: str, prefix: str):
        self.spark, self.folder, self.prefix = spark, folder.rstrip("/"), prefix

    def numbers(self) -> list[int]:
        names = [n.removeprefix(self.prefix) for n in fs.files(self.spark, self.folder) if n.startswith(self.prefix)]
        return sorted(int(n.removesuffix(".json")) for n in names)

    def get(self, number: int) -> dict:
        return json.loads(fs.read_text(self.spark, self._path(number)))

    def last(self) -> dict:
        numbers = self.numbers()
        return self.get(numbers[-1]) if numbers else {"version": 0}

    def add(self, state: dict) -> bool:
        """Make the file of ``state["version"]``; False if another writer has made it."""
        return fs.create_text(self.spark, self._path(state["version"]), json.dumps(state))

    def drop(self, number: int) -> None:
        fs.delete(self.spark, self._path(number))

    def _path(self, number: int) -> str:
        return f"{self.folder}/{self.prefix}{number:012d}.json"
