import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest

from gleanstream.llm import warc
from gleanstream.session import run_dir

ROWS = [
    (5, "http://a/", "same"), (3, "http://b/\r\nX: y", "same"), (9, None, "same"), (1, "u", None), (2, "v", ""),
    (4, "w", "é😀\r\n\r\nWARC/1.1\r\n"), (6, "x", "y" * 300_000), (None, "z", "lone"), (None, "z2", "same"),
    (7, "r", "twice"), (7, "r", "twice"), (8, "lang", "lang"),
]
SCHEMA = "page_id bigint, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, min_bytes):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= min_bytes:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        to = first.get(html or "")
        revisit = to is not None and to != page
        out.append((page, len((html or "").encode()), digest(html), "revisit" if revisit else "response",
                    to if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes):
    path = run_dir(spark, "archives")
    warc.write_archives(spark.createDataFrame(ROWS, SCHEMA), path, min_bytes, file_records=3)
    got = warc.read_archives(spark, path, strict=True).collect()
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(row[key] for key in keys) for row in got), key=str) == expected(ROWS, min_bytes)
    texts = {page: html or "" for page, _, html in ROWS}
    for row in got:
        assert row["problem"] is None
        if row["record_type"] == "response" and row["page_id"] is not None:
            assert row["html"] == texts[row["page_id"]]


def test_files_are_plain_archives(spark):
    """Another reader of gzip gets whole records, one member each."""
    path = run_dir(spark, "archives")
    warc.write_archives(spark.createDataFrame(ROWS, SCHEMA), path)
    files = spark.read.format("binaryFile").load(path + "/part-*").collect()
    text = b"".join(gzip.decompress(bytes(row["content"])) for row in files if row["content"])
    assert text.count(b"WARC-Record-ID") == len(ROWS)
    assert b"X:%20y" in text and b"\r\nX: y" not in text  # no header is smuggled in by a url


def archive(*payloads):
    return b"".join(warc.record(i, "u", text, warc.base32_sha1(hashlib.sha1(text).digest()), False, None)
                    for i, text in enumerate(payloads))


def pieces(data, size):
    return (data[at:at + size] for at in range(0, len(data), size))


@pytest.mark.parametrize("size", [1, 7, 1 << 16])
def test_reader_takes_any_pieces(size):
    texts = [b"", b"a", b"\r\n\r\n" * 5, random.Random(1).randbytes(70_000)]
    records = list(warc.read_records(pieces(archive(*texts), size)))
    assert [one.http[1] for one in records] == texts


def member(text):
    return gzip.compress(text)


@pytest.mark.parametrize("broken", [
    archive(b"abc")[:-5], archive(b"abc")[:30] + b"\x00\x01" + archive(b"abc")[32:], b"plain text",
    member(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"), member(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabc\r\n\r\n"),
    member(b"WARC/1.1\r\nContent-Length: x\r\n\r\nabc\r\n\r\n"), member(b"HTTP/1.1\r\n\r\n"), member(b"WARC/1.1 no end"),
    member(gzip.decompress(archive(b"abc")).replace(b"abc", b"abd")),
])
def test_faults_are_found(spark, broken):
    with pytest.raises(warc.WarcError):
        list(warc.read_records([archive(b"good"), broken]))
    frame = spark.createDataFrame([(archive(b"good") + broken,)], "content binary")
    rows = frame.mapInArrow(warc._read(True, False), "page_id bigint, payload_bytes bigint, payload_digest string, "
                            "record_type string, refers_to bigint, url string, html string, problem string").collect()
    assert [row["problem"] is None for row in rows] == [True, False] and rows[0]["html"] == "good"


def test_large_record_ends_in_zero():
    payload = random.Random(2).randbytes(17 << 20)
    data = archive(payload)
    assert data[-1] == 0 and next(warc.read_records([data])).http[1] == payload
    assert zlib.decompressobj(31).decompress(warc._EMPTY_MEMBER) == b""
    assert io.BytesIO(data).read(2) == b"\x1f\x8b"


def test_empty(spark):
    path = run_dir(spark, "archives")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0
