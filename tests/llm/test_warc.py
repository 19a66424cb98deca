from __future__ import annotations

import gzip
import hashlib
import io

import pytest

from oreflow.llm.warc import DamagedRecord, archive, read_records, write_record

SCHEMA = "page_id long, url string, html string, digest string, payload string"
LONG = "<p>" + "x" * 200
PAGES = [(5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, None, LONG), (1, "u", "short"), (2, "u", "short"), (4, "http://a/ä b\r\nX: y", None), (6, "u", ""), (None, "u", LONG), (7, "u", "é" * 50), (8, "u", "é" * 50), (10, "u", "\r\n\r\n" * 60_000), (11, "u", "y" * 120), (11, "u", "y" * 120)]


def brute(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, h in rows if h == html and j is not None] if len(data) >= 100 else []
        first = min(ids) if ids else None
        revisit = first is not None and first != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    frame = spark.createDataFrame([(i, u, h, "d", "p") for i, u, h in PAGES], SCHEMA)
    got = archive(frame).collect()
    assert sorted([tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got], key=repr) == brute(PAGES)
    held = {r.page_id: r.payload for r in got if r.record_type == "response"}
    assert held[10] == ("\r\n\r\n" * 60_000).encode() and held[4] == b""
    assert archive(frame.limit(0)).count() == 0


def members(*rows):
    return [write_record(i, "http://x", p, hashlib.sha256(p).hexdigest(), r) for i, p, r in rows]


def test_one_member_for_each_record():
    parts = members((1, b"abc", None), (2, b"abc", 1), (3, b"", None))
    assert [gzip.decompress(p).startswith(b"WARC/1.1\r\n") for p in parts] == [True] * 3
    found = [(f["warc-type"], f["warc-page-id"], p) for f, _, p in read_records(io.BytesIO(b"".join(parts)))]
    assert found == [("response", "1", b"abc"), ("revisit", "2", b""), ("response", "3", b"")]


@pytest.mark.parametrize("change", [lambda d: d[:-9], lambda d: d.replace(b"payload!", b"payloads"), lambda d: d.replace(b"Content-Length: 8", b"Content-Length: 9"), lambda d: d + b"x"])
def test_damage_is_found(change):
    plain = gzip.decompress(members((1, b"payload!", None))[0])
    with pytest.raises(DamagedRecord):
        list(read_records(io.BytesIO(gzip.compress(change(plain)))))
    whole = members((1, b"payload!" * 500, None))[0]
    with pytest.raises(DamagedRecord):
        list(read_records(io.BytesIO(whole[: len(whole) // 2])))
