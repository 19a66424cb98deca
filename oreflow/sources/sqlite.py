"""Python data source over a SQLite file.

Each task opens the file read-only and scans one range of row ids, so the file has to be on
storage that every executor mounts. The classes are pickled by value and import nothing from
this package: executors need not have it installed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BATCH = 10_000


class RowRange(InputPartition):
    def __init__(self, low: int | None, high: int | None):
        self.low, self.high = low, high


class SqliteTable(DataSource):
    """Options: ``path``, ``table``, and optionally ``cursor``, ``since``, ``inclusive``, ``partitions``.

    All columns are text. SQLite types belong to values, not to columns, and text keeps a
    stray value for the contract to refuse instead of losing it in the scan.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        with _open(self.options["path"]) as link:
            found = link.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        if not found:
            raise ValueError(f"table not found: {self.options['table']}")
        return ", ".join(f"`{column[1]}` string" for column in found)

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(schema, dict(self.options))


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names = schema.fieldNames()
        self.options = options

    def partitions(self) -> list[InputPartition]:
        import sqlite3

        wanted = int(self.options.get("partitions", "1"))
        with _open(self.options["path"]) as link:
            try:
                low, high = link.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.options['table'])}").fetchone()
            except sqlite3.OperationalError:  # a table without row ids
                return [RowRange(None, None)]
        if low is None:
            return [RowRange(None, None)]
        step = max(1, -(-(high - low + 1) // wanted))
        return [RowRange(at, min(at + step - 1, high)) for at in range(low, high + 1, step)]

    def read(self, partition: RowRange) -> Iterator:
        import pyarrow as pa

        tests, values, order = [], [], ""
        if partition.low is not None:
            tests.append("rowid BETWEEN ? AND ?")
            values += [partition.low, partition.high]
            order = " ORDER BY rowid"
        if "since" in self.options:
            sign = ">=" if self.options.get("inclusive", "false").lower() == "true" else ">"
            tests.append(f"{_quoted(self.options['cursor'])} {sign} ?")
            values.append(self.options["since"])
        where = f" WHERE {' AND '.join(tests)}" if tests else ""
        columns = ", ".join(_quoted(n) for n in self.names)
        with _open(self.options["path"]) as link:
            found = link.execute(f"SELECT {columns} FROM {_quoted(self.options['table'])}{where}{order}", values)
            while rows := found.fetchmany(_BATCH):
                arrays = [pa.array([_text(v) for v in column], pa.string()) for column in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=self.names)


def _open(path: str):
    import sqlite3
    from contextlib import closing
    from urllib.parse import quote

    return closing(sqlite3.connect(f"file:{quote(path.removeprefix('file:'))}?mode=ro", uri=True))


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return value.decode("utf-8", "replace") if isinstance(value, bytes) else repr(value)
