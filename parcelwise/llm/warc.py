"""WARC archives: a writer with identical-payload revisits and a salvaging reader (operator 8).

Writing: every page becomes one record in its own gzip member. Of pages with
equal payloads (of at least ``min_payload`` bytes) the one with the smallest
page_id is a response, the others are revisits that refer to it; smaller
payloads are always responses. Each task attempt writes files of its own name
and reports them in a manifest; only files of the committed manifest are read,
so a repeated or lost attempt leaves no double records.

Reading: a member (or, in plain archives, a record that starts with a version
line) has to decompress, parse, have its announced length and match its
payload digest. Where a check fails, the reader looks for the next valid
member or version line, goes on with the records behind it and logs the bytes
between as a quarantined gap.

Rules for odd rows: a null html is an empty payload; a null url becomes
``urn:page:<id>``; rows that repeat the smallest page_id of a payload are all
responses; null page_ids come last, and a payload that only such rows have is
written as responses; an empty table writes no file and reads no record;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import stored
from parcelwise.session import shared_path

ROLL_BYTES = 32 << 20
CHUNK = 1 << 20
SLICE = 1 << 15
VERSION = b"WARC/1.1"
MEMBER_START = b"\x1f\x8b\x08"
VERSION_START = b"WARC/1."

MANIFEST = "uri string, bytes long, records long"
RECORDS = ("kind string, archive string, offset long, length long, reason string, record_type string, target_uri string, "
           "page_id long, payload_digest string, payload_bytes long, refers_to long, payload binary")


def with_record_types(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, record_type, refers_to) for every row of pages (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    first = rows.groupBy("sha1").agg(F.min("page_id").alias("first_id"))
    is_revisit = (F.length("payload") >= min_payload) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "sha1").select(
        "page_id", "url", "payload", "sha1",
        F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(is_revisit, F.col("first_id")).alias("refers_to"))


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to, date: str) -> bytes:
    """One record: WARC header, HTTP header, payload (a revisit has no payload)."""
    target = quote(url, safe=":/?#[]@!$&'()*+,;=%~-._") if url else f"urn:page:{page_id}"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if kind == "revisit" else http + payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", date), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Bytes", str(len(payload)))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    c = zlib.compressobj(3, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


def write_archives(typed: DataFrame, base_uri: str | None = None, date: str = "2024-01-01T00:00:00Z", compress: bool = True,
                   roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the rows of ``with_record_types`` as archives; return the committed manifest (uri, bytes, records)."""
    base = base_uri or shared_path(typed.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(base)
        attempt, made, out, size, count, name = uuid.uuid4().hex, [], None, 0, 0, ""

        def close():
            out.close()
            made.append((name, size, count))

        for batch in batches:
            for page_id, url, payload, sha1, kind, refers_to in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "payload", "sha1", "record_type", "refers_to")), strict=True):
                if out is None:
                    filesystem.create_dir(root, recursive=True)
                    name = f"pages-{attempt}-{len(made):05d}.warc" + ".gz" * compress
                    out, size, count = filesystem.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = record_bytes(page_id, url, payload, digest, kind, refers_to, date)
                data = member(data) if compress else data
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if made:
            names, sizes, counts = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([f"{base}/{n}" for n in names]), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                                             names=["uri", "bytes", "records"])

    columns = typed.select("page_id", "url", "payload", "sha1", "record_type", "refers_to")
    return stored(columns.mapInArrow(run, MANIFEST), "warc-manifest")


class Damaged(Exception):
    """A record that fails a check."""


class _Window:
    """Bytes of a seekable file by offset, read in chunks."""

    def __init__(self, file):
        self.file, self.size, self.at, self.data = file, file.size(), 0, b""

    def read(self, offset: int, n: int) -> bytes:
        if not self.at <= offset or offset + n > self.at + len(self.data):
            self.file.seek(offset)
            self.at, self.data = offset, self.file.read(max(n, CHUNK))
        return self.data[offset - self.at: offset - self.at + n]

    def some(self, offset: int) -> bytes:
        """A few bytes from ``offset`` on, as far as they lie in the chunk at hand."""
        if not self.at <= offset < self.at + len(self.data):
            return self.read(offset, CHUNK)[:SLICE]
        return self.data[offset - self.at: offset - self.at + SLICE]

    def find(self, patterns: tuple[bytes, ...], offset: int) -> int:
        """The next offset at which one of the patterns stands, or the end."""
        most = max(map(len, patterns))
        while offset < self.size:
            data = self.read(offset, CHUNK)
            hits = [k for k in (data.find(p) for p in patterns) if k >= 0]
            if hits:
                return offset + min(hits)
            if len(data) < most:
                break
            offset += len(data) - most + 1
        return self.size


def _parse(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(VERSION_START):
        raise Damaged("no version line")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        fields[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields


def _checked(fields: dict[str, str], block: bytes) -> tuple:
    """Payload and columns of a record whose digest holds."""
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            raise Damaged("no end of the HTTP header")
    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind != "revisit" and digest and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise Damaged("payload digest differs")
    number = lambda key: int(fields[key]) if re.fullmatch(r"-?\d+", fields.get(key, "")) else None
    size = number("x-payload-bytes") if kind == "revisit" else len(payload)
    return (kind, fields.get("warc-target-uri"), number("x-page-id"), digest or None, size, number("x-refers-to-page"),
            None if kind == "revisit" else payload)


def _length(fields: dict[str, str]) -> int:
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
        raise Damaged("no content length")
    return int(fields["content-length"])


def _gzip_record(window: _Window, offset: int) -> tuple[int, tuple]:
    unzip, parts, at = zlib.decompressobj(31), [], offset
    try:
        while not unzip.eof:
            data = window.some(at)
            if not data:
                raise Damaged("member cut short")
            parts.append(unzip.decompress(data))
            at += len(data)
    except zlib.error as e:
        raise Damaged(f"member: {e}") from e
    end, record = at - len(unzip.unused_data), b"".join(parts)
    head, gap, rest = record.partition(b"\r\n\r\n")
    if not gap:
        raise Damaged("no end of the header")
    fields = _parse(head)
    n = _length(fields)
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise Damaged("block length differs")
    return end, _checked(fields, rest[:n])


def _plain_record(window: _Window, offset: int) -> tuple[int, tuple]:
    gap = window.find((b"\r\n\r\n",), offset)
    if gap >= window.size:
        raise Damaged("no end of the header")
    head = window.read(offset, gap - offset)
    fields = _parse(head)
    n, start = _length(fields), offset + len(head) + 4
    if start + n + 4 > window.size:
        raise Damaged("block cut short")
    rest = window.read(start, n + 4)
    if rest[n:] != b"\r\n\r\n":
        raise Damaged("block length differs")
    return start + n + 4, _checked(fields, rest[:n])


def salvage(file) -> Iterator[tuple]:
    """Records and gaps of one seekable archive: (kind, offset, length, reason, columns or None)."""
    window, offset, gap, reason = _Window(file), 0, None, ""
    while offset < window.size:
        try:
            start = window.read(offset, 7)
            if start.startswith(MEMBER_START):
                end, found = _gzip_record(window, offset)
            elif start.startswith(VERSION_START):
                end, found = _plain_record(window, offset)
            else:
                raise Damaged("neither a member nor a version line")
        except Damaged as e:
            if gap is None:
                gap, reason = offset, str(e)
            offset = window.find((MEMBER_START, VERSION_START), offset + 1)
            continue
        if gap is not None:
            yield "gap", gap, offset - gap, reason, None
            gap = None
        yield "record", offset, end - offset, None, found
        offset = end
    if gap is not None:
        yield "gap", gap, window.size - gap, reason, None


def read_archives(manifest: DataFrame) -> DataFrame:
    """Rows of all archives of a manifest: records (kind ``record``) and quarantined byte ranges (kind ``gap``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in RECORDS.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                filesystem, path = pafs.FileSystem.from_uri(uri)
                rows, held = [], 0
                with filesystem.open_input_file(path) as file:
                    for kind, offset, length, reason, found in salvage(file):
                        record = found or (None,) * 7
                        rows.append((kind, uri, offset, length, reason, *record))
                        held += len(record[6] or b"") + 200
                        if held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    spread = manifest.select("uri").repartition(max(1, min(manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism)), "uri")
    return spread.mapInArrow(run, RECORDS)


ORACLE_SQL = r"""
with rows_ as (
  select page_id, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as hex,
         min(page_id) over (partition by coalesce(html, '')) as first_id
  from pages),
nibbles as (
  select *, (select string_agg('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v + 1)::int], '' order by g)
    from (select g, (('0x' || substr(hex, 1 + 10 * (g // 8), 10))::bigint >> (5 * (7 - g % 8))) & 31 as v
          from (select unnest(range(32)) as g))) as b32
  from rows_)
select page_id, octet_length(payload)::bigint as payload_bytes, b32 as payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from nibbles
"""
