"""WARC archives: written from pages, read back record by record.

Every record is one gzip member. The reader is sequential: it inflates a member bit by bit, takes
the header up to the blank line, then exactly Content-Length bytes of block, and checks the block's
and payload's digests while it goes. It holds one record at most.

Pages with an equal payload of at least ``least`` bytes share one response record; the others are
revisits that name it. Equality is that of SHA-256 and length, which is what a revisit record states.

Spark has no writer for raw bytes, so tasks write archives through a file system of pyarrow, which
opens local, shared and object-store paths alike. A task writes under a name of its own attempt
and reports it; only names that reached the stored manifest are ever read, so a task that is lost
or run twice leaves no record behind twice.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote
from uuid import NAMESPACE_URL, uuid4, uuid5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.common import Store, broadcast_if_small

#: Payloads below this many bytes are stored each time.
LEAST_BYTES = 100
#: Compressed bytes after which a task begins the next archive.
ARCHIVE_BYTES = 256 << 20
#: Bytes read from a file, or inflated, at once.
STEP = 1 << 16
DATE = "2025-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class DamagedRecord(ValueError):
    """A record whose framing or digest is wrong."""


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'{page_id}:{digest}')}>"


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One gzip member: a response with its payload, or a revisit that names the response's page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "", safe=";/?:@&=+$,#%-_.!~*'()[]")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Page-ID", "" if page_id is None else str(page_id)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[6:6] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Page-ID", str(refers_to))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


class _Member:
    """Inflates one gzip member in steps; what follows it stays in ``rest``."""

    def __init__(self, stream, rest: bytes):
        self.stream, self.inflate, self.rest, self.held = stream, zlib.decompressobj(31), rest, b""

    def more(self) -> bool:
        if self.inflate.eof:
            return False
        raw = self.inflate.unconsumed_tail or self.rest or self.stream.read(STEP)
        self.rest = b""
        if not raw:
            raise DamagedRecord("the archive ends inside a record")
        try:
            self.held += self.inflate.decompress(raw, STEP)
        except zlib.error as error:
            raise DamagedRecord(str(error)) from error
        if self.inflate.eof:
            self.rest = self.inflate.unused_data
        return True

    def until(self, mark: bytes) -> bytes:
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                raise DamagedRecord("no end of header")
        found, self.held = self.held[:at], self.held[at + len(mark) :]
        return found

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise DamagedRecord("a block is shorter than its Content-Length")
            part, self.held = self.held[:n], self.held[n:]
            n -= len(part)
            yield part

    def end(self) -> bytes:
        while self.more():
            pass
        return self.held


def read_records(stream) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(WARC fields, HTTP fields, payload) of each record in order; names are lower-cased.

    Raises :class:`DamagedRecord` where framing or a digest is wrong.
    """
    rest = b""
    while rest := rest or stream.read(STEP):
        member = _Member(stream, rest)
        fields = _fields(member.until(b"\r\n\r\n"), VERSION)
        digest, block = hashlib.sha256(), bytearray()
        for part in member.exactly(int(fields.get("content-length", -1))):
            digest.update(part)
            block += part
        if member.end() != b"\r\n\r\n":
            raise DamagedRecord("a record is longer than its Content-Length")
        if fields.get("warc-block-digest") not in (None, f"sha256:{digest.hexdigest()}"):
            raise DamagedRecord("block digest")
        http, _, payload = bytes(block).partition(b"\r\n\r\n")
        if fields.get("warc-type") == "response" and fields.get("warc-payload-digest") not in (None, f"sha256:{hashlib.sha256(payload).hexdigest()}"):
            raise DamagedRecord("payload digest")
        yield fields, _fields(http, b"HTTP/1.1 200 OK"), payload
        rest = member.rest


def _fields(head: bytes, first: bytes) -> dict[str, str]:
    line, *lines = head.split(b"\r\n")
    if line != first:
        raise DamagedRecord(f"unexpected first line {line[:40]!r}")
    parts = (x.decode().partition(":") for x in lines)
    return {k.strip().lower(): v.strip() for k, _, v in parts}


def _opened(path: str):
    from pyarrow import fs

    if path.startswith("file:/"):
        path = "/" + path[6:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def plan_records(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for a response) of each page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    marks = rows.where(F.col("size") >= least).groupBy("digest", "size").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    store = Store(pages.sparkSession, "warc-plan")
    shared = broadcast_if_small(store.put("shared", marks.where("copies > 1").drop("copies")), 128)
    met = rows.join(shared, ["digest", "size"], "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return met.select("page_id", "url", "payload", "digest", F.when(again, F.col("first_id")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the records as .warc.gz under the folder; path, records and bytes of each archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        system.create_dir(base, recursive=True)
        out, path, written, size = None, None, 0, 0
        done = []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in zip(*columns, strict=True):
                if out is None:
                    path, written, size = f"{base}/{uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                member = write_record(*(x.as_py() for x in row))
                out.write(member)
                written, size = written + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, written, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, written, size))
        columns = list(zip(*done, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "records", "bytes"])

    return records.mapInArrow(run, "path string, records long, bytes long")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """A row for each record of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The size of a revisit is that of the full payload, which its HTTP header keeps; its payload is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(folder)
        number = lambda text: int(text) if text else None
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_stream(path, compression=None) as stream:
                    rows, size = [], 0
                    for fields, http, payload in read_records(stream):
                        kind = fields["warc-type"]
                        rows.append((
                            number(fields["warc-page-id"]), fields["warc-target-uri"], int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:"),
                            kind, number(fields.get("warc-refers-to-page-id")), payload if kind == "response" else None,
                        ))
                        size += len(payload)
                        if size > STEP * 64 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    files = manifest.count()
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return manifest.repartition(max(1, files)).mapInArrow(run, schema)


def archive(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Pages written as archives and read back; columns as in :func:`read_archives`.

    Null html is an empty payload, a null url an empty one; neither a null page id nor a repeated row
    is lost. Where the smallest id of equal payloads is repeated, each of its rows is a response; a
    null id is a revisit of one that isn't null. Other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    store = Store(spark, "warc")
    folder = f"{store.base}/archives"
    manifest = store.put("manifest", write_archives(plan_records(pages, least), folder))
    return read_archives(spark, manifest, folder)
