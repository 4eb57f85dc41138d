"""WARC archives of pages: a deduplicating writer and a sequential reader.

The writer makes one gzip member per record. Of records with equal payloads (of at least
``min_bytes``) that with the smallest page_id is a response, the others are revisits that
refer to it and carry no payload. Payloads are compared by SHA-1; only pages whose digest may
repeat are shuffled. Files are written by Spark's text writer, so they can lie in any store
that Spark reaches: a record's bytes are a line, and the line separator is the zero byte that
ends a gzip member below 16 MiB. A larger record is followed by an empty member, whose last
byte is zero too. Files are named ``part-*.txt``; each is a plain multi-member archive.

The reader goes through a file once: members are inflated in pieces, headers are read up to
their blank line, the block by its content length, and each record must end with its member.
Block and payload digests are verified. A fault gives a row with its ``problem``, and the rest
of that file is not read; ``strict`` raises instead.

A null html is an empty payload, a null url has no target, a null page_id is written and read
back as null. Rows that repeat an id and payload are all responses. Of the pages only
page_id, url and html go into the archive. An empty table writes no record and gives none.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanstream.llm import tables

#: Records of one archive file at most, and bytes that the reader inflates at once.
FILE_RECORDS, PIECE = 20_000, 1 << 16
DATE = "2000-01-01T00:00:00Z"
_END = b"\r\n\r\n"
_EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found.group(1)) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisits: bool,
           refers_to: int | None) -> bytes:
    """One record as a gzip member that ends in a zero byte."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisits else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}",
             f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        # a target must not end its header line
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}",
              f"WARC-Block-Digest: sha1:{base32_sha1(hashlib.sha1(block).digest())}"]
    if revisits:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress("\r\n".join(lines).encode("utf-8") + _END + block + _END) + packer.flush()
    return member if member[-1] == 0 else member + _EMPTY_MEMBER


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            rows = batch.slice(start, 200).to_pylist()
            members = [record(row["page_id"], row["url"], row["payload"], base32_sha1(row["sha"]),
                              row["revisits"], row["refers_to"])[:-1] for row in rows]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0,
                   file_records: int = FILE_RECORDS) -> None:
    """Write pages (page_id, url, html) as archives to a new folder."""
    tables.prepare(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    sha = F.unhex(F.sha1(payload))
    narrow = tables.stored(pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), sha.alias("sha"), F.xxhash64(sha).alias("key"),
        F.octet_length(payload).alias("bytes")).filter(F.col("bytes") >= min_bytes), "payloads")
    bits = tables.filter_bits(narrow.count(), tables.FILTER_BITS)
    known = tables.stored(tables.repeat_filter(narrow, "key", bits), "repeat-filter")
    groups = tables.stored(
        tables.with_maybe(narrow, "key", known, bits).filter("maybe").groupBy("sha").agg(
            F.count("*").alias("size"), F.min("page_id").alias("first")).filter("size > 1"),
        "payload-groups")

    rows = tables.with_maybe(pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
        sha.alias("sha"), F.xxhash64(sha).alias("key")), "key", known, bits)
    shared = tables.attach(rows.filter("maybe").drop("maybe", "key"), groups, "sha", "size")
    alone = rows.filter(~F.col("maybe")).select(
        "page_id", "url", "payload", "sha", F.lit(None).cast("bigint").alias("first"))
    long_enough = F.octet_length("payload") >= min_bytes
    revisits = F.coalesce(long_enough & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    decided = shared.drop("size").unionByName(alone).withColumn(
        "revisits", F.col("first").isNotNull() & revisits)
    members = decided.select(
        "page_id", "url", "payload", "sha", "revisits",
        F.when(F.col("revisits"), F.col("first")).alias("refers_to")
    ).mapInArrow(_written, "member binary")
    members.select(F.col("member").cast("string")).write.option("lineSep", "\x00").option(
        "maxRecordsPerFile", file_records).text(path)


class WarcError(ValueError):
    """Broken framing, compression or digest."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        head, _, payload = self.block.partition(_END)
        return _headers(head), payload


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _members(pieces: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """Each member of an archive as an iterator of inflated pieces, to be used up in turn."""
    source = iter(pieces)
    rest = b""

    def inflate() -> Iterator[bytes]:
        nonlocal rest
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof:
            data = rest or next(source, b"")
            if not data:
                raise WarcError("the archive ends inside a member")
            try:
                out = unpacker.decompress(data, PIECE)
            except zlib.error as error:
                raise WarcError(f"member does not inflate: {error}") from None
            rest = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
            if out:
                yield out

    while True:
        while not rest:
            rest = next(source, None)
            if rest is None:
                return
        yield inflate()


def read_records(pieces: Iterable[bytes]) -> Iterator[Record]:
    """The records of an archive, framed by content length and verified, one after another."""
    for member in _members(pieces):
        head = bytearray()
        for piece in member:
            head += piece
            if _END in head[-len(piece) - 3:]:
                break
        if not head:
            continue  # an empty member holds no record
        raw, found, start = bytes(head).partition(_END)
        if not found or not raw.startswith(b"WARC/"):
            raise WarcError("a record has no header")
        headers = _headers(raw)
        length = headers.get("content-length", "")
        if not length.isdecimal():
            raise WarcError("a record has no content length")
        body = bytearray(start)
        for piece in member:
            body += piece
            if len(body) > int(length) + len(_END):
                raise WarcError("a record is longer than its content length")
        if len(body) != int(length) + len(_END) or not body.endswith(_END):
            raise WarcError("a record does not end at its content length")
        one = Record(headers, bytes(body[:int(length)]))
        _verify(one)
        yield one


def _verify(one: Record) -> None:
    checks = [("warc-block-digest", one.block)]
    if one.headers.get("warc-type") == "response":
        checks.append(("warc-payload-digest", one.http[1]))
    for name, data in checks:
        stated = one.headers.get(name)
        if stated and stated != f"sha1:{base32_sha1(hashlib.sha1(data).digest())}":
            raise WarcError(f"{name} does not match")


def _row(one: Record, with_payload: bool) -> dict:
    http, payload = one.http
    kind = one.headers.get("warc-type")
    return {
        "page_id": _page_id(one.headers.get("warc-record-id")),
        "payload_bytes": int(http.get("content-length", len(payload))),
        "payload_digest": one.headers.get("warc-payload-digest", "").removeprefix("sha1:"),
        "record_type": kind, "refers_to": _page_id(one.headers.get("warc-refers-to")),
        "url": one.headers.get("warc-target-uri"),
        "html": payload.decode("utf-8", "replace") if with_payload and kind == "response" else None,
        "problem": None}


_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
    ("html", pa.string()), ("problem", pa.string())])


def _read(with_payload: bool, strict: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                content = batch.column(0)[place].as_buffer()
                pieces = (content.slice(at, min(PIECE, content.size - at)).to_pybytes()
                          for at in range(0, content.size, PIECE))
                rows: list[dict] = []
                try:
                    for one in read_records(pieces):
                        rows.append(_row(one, with_payload))
                        if len(rows) == 200:
                            yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                            rows = []
                except WarcError as error:
                    if strict:
                        raise
                    rows.append({"problem": str(error)})
                yield pa.RecordBatch.from_pylist(rows, _RECORDS)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True,
                  strict: bool = False) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url,
    html (of responses), problem. A task reads whole files, which ``file_records`` bounds."""
    tables.prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(
        _read(with_payload, strict),
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, url string, html string, problem string")


_BITS = "('0x' || substr(hex || '0', 1 + (5 * i) // 4, 3))::INTEGER >> (7 - (5 * i) % 4)"
ORACLE_SQL = f"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS hex FROM pages),
placed AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first,
    list_aggregate(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({_BITS}) & 31), 1)), 'string_agg', '')
      AS payload_digest
  FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM placed"""
