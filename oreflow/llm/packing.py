"""Packing tokenised documents into sequences by minimum bin slack.

Spark tokenises, cuts and counts; a histogram of piece lengths, ``capacity`` numbers at most
whatever the corpus, is all the planner sees. It fills one sequence at a time: the longest piece
left opens it, and subset sums over the lengths still available, a bitset with a bit for each
reachable total, give the combination that leaves the least slack. That combination is taken as
often as the counts allow, so a plan has a few thousand lines at any scale. Pieces of one length
are interchangeable: Spark numbers them within salted groups and each finds its line by number.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import Remembered, Store, alone, per_process, row_key, small_batches

CAPACITY = 2048
END_ID = 0
#: Pieces numbered in one group.
GROUP_ROWS = 50_000
#: Bytes in which a Python worker remembers encoded chunks, of texts' begins and of what follows a space, and signs.
REMEMBERED = {"first": 24 << 20, "rest": 176 << 20, "signs": 4 << 20}
#: Letters, and ASCII signs behind them.
_WORD_SIGNS = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write each byte as a printable letter: itself, or one from 256 on in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(rest)}


class _Chunks(Remembered):
    """Chunk of text to its ids, little-endian 32-bit. A chunk stands between single spaces; ``lead`` is the space before it.

    The vocabulary's splitting rule never joins a letter to a space that follows it, so between
    two characters that aren't space such chunks are encoded on their own. Nor does it join a word
    to the signs behind it, or either to a line end, so chunks are made of known parts where they can be.
    """

    def __init__(self, tokenizer, lead: str, first: _Chunks | None = None, remembered: int | None = None):
        super().__init__(remembered or REMEMBERED["first" if first is None else "rest"])
        self.lead, self.split, self.merge = lead, tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        self.letters, self.first, self.signs = _byte_letters(), self if first is None else first, Remembered(REMEMBERED["signs"])
        self.line = self._merged(["\u010a"])

    def _merged(self, parts: list[str]) -> bytes:
        return array("I", [t.id for p in parts for t in self.merge(p)]).tobytes()

    def _made(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._merged([(self.lead + chunk).encode().decode("latin-1").translate(self.letters)])
        if "\n" in chunk:
            head, *tail = lines = chunk.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                return self.line.join([self[head], *map(self.first.__getitem__, tail)])
        elif (found := _WORD_SIGNS.fullmatch(chunk)) and found[1].isalpha():
            signs = self.signs.get(found[2])
            if signs is None:
                signs = self.signs.recall(found[2])
            if signs is None:
                signs = self._merged([p for p, _ in self.split(found[2])])
                self.signs.keep(found[2], signs)
            return self[found[1]] + signs
        return self._merged([p for p, _ in self.split(self.lead + chunk)])

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            if not chunk or chunk[0].isspace() or chunk[-1].isspace() or "<|" in chunk:
                raise LookupError(chunk)
            ids = self._made(chunk)
        if len(chunk) <= self.longest:
            self.keep(chunk, ids)
        return ids


class Encoder:
    """Text to ids, as the tokenizer gives them without special tokens added."""

    def __init__(self, path: str, remembered: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.first = _Chunks(self.tokenizer, "")
        self.rest = _Chunks(self.tokenizer, " ", self.first, remembered)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        head, *tail = text.split(" ")
        try:
            return self.first[head] + b"".join(map(self.rest.__getitem__, tail))
        except LookupError:  # unusual white space or a special token's name: as one text
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, remembered: int | None = None) -> DataFrame:
    """doc_id, row_key, piece, start, length, ids_crc32: documents, ended by id 0, cut where longer than a sequence.

    All pieces of a cut document but the first are full.
    """

    name = f"encoder:{tokenizer}:{remembered}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_process(name, lambda: Encoder(tokenizer, remembered))
        end = array("I", [END_ID]).tobytes()
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column("text")):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at.append(k)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("row_key").take(at), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "row_key", "piece", "start", "length", "ids_crc32"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("row_key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(alone(run, but=name), "doc_id long, row_key long, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, with how many of each, whose total is the largest that fits the room."""
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            more = reach | reach << length * take & mask
            if more != reach:
                steps.append((length, take, reach))
                reach = more
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how many sequences, lengths with how many of each in one of them) until nothing is left."""
    left, lines = dict(counts), []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest({k: n for k, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // m for k, m in chosen.items())
        lines.append((times, chosen))
        for k, m in chosen.items():
            left[k] -= times * m
            if not left[k]:
                del left[k]
    return lines


def _places(lines: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """A line for each length of each combination: from which number on, sequence, how many in each, offset."""
    used, rows, sequence = {}, [], 0
    for times, chosen in lines:
        offset = 0
        for length, each in sorted(chosen.items(), reverse=True):
            rows.append((length, used.get(length, 0), sequence, each, offset))
            used[length] = used.get(length, 0) + times * each
            offset += length * each
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _numbered(rows: DataFrame, total: int) -> DataFrame:
    """Number the pieces of each length from 0 in column ``nth``; no group is larger than its share of the total."""
    groups = max(1, -(-total // GROUP_ROWS))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row_key", "piece"), F.lit(groups)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "row_key")
    return salted.withColumn("nth", F.row_number().over(inside) - 1).join(first, ["length", "salt"]).withColumn("nth", F.col("nth") + F.col("first"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, remembered: int | None = None) -> DataFrame:
    """A row for each piece with its sequence and place there; sequences are gapless from 0 on.

    A null or empty text is the end id alone. Repeated rows are packed each for itself, a null id
    like any other; other columns are ignored; an empty table gives no rows. ``remembered``: bytes in which a Python
    worker remembers what follows a space, where memory allows more or less than usual.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    store = Store(docs.sparkSession, "packing")
    rows = store.put("pieces", pieces(docs, tokenizer, capacity, remembered))
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # capacity rows at most
    places = _places(plan_sequences(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = places[:, 0] << 44 | places[:, 1]
        for batch in batches:
            length, nth = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "nth"))
            line = places[np.searchsorted(keys, length << 44 | nth, side="right") - 1]
            k = nth - line[:, 1]
            sequence, offset = line[:, 2] + k // line[:, 3], line[:, 4] + k % line[:, 3] * length
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return _numbered(rows, sum(counts.values())).mapInArrow(alone(place), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
