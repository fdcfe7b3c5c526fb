"""WARC archives as a data source: records written with repeats as revisits, headers read before payloads.

Writing: every record is a gzip member of its own, with its compressed length in the member's extra field, so
a reader can go from record to record without inflating them. Each task writes one file under a name of its
attempt; the commit lists the files of successful attempts in a manifest with the places where they can be
split. Reading: partitions are planned from the manifest (or, for archives from elsewhere, one per file),
predicates on record type and headers are pushed into the source, headers are parsed first, and the payload
of a record that a predicate rejects, or that nobody asks for, is not inflated.

Defined results: null html is an empty payload; of pages with equal payloads the one with the largest
page_id is the response, and so is every repeated row with that id; pages without an id refer to the largest
id there is, and are responses where there is none; other columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha1
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
    StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ebbtide.llm.shared import attach, store, written

SPLIT_BYTES = 8 << 20  # a partition of a listed archive
BATCH_BYTES = 4 << 20
SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes long, headers map<string,string>, payload binary"
)
_FIELDS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BYTES = "X-Payload-Bytes"  # extension field: a revisit holds no payload to measure


def digest_of(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def record(kind: str, record_id: str, uri: str | None, date: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record; a revisit names the record it repeats and holds no payload."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"Content-Length: {len(payload)}\r\n" if kind == "response" else "") + "\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_clean(uri)}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"{_BYTES}: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """A gzip member whose extra field ``sl`` holds its compressed and plain length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


# --- reading ---------------------------------------------------------------------------------------------


def _skip_length(head: bytes) -> int | None:
    """Compressed length of the member that begins here, if its extra field tells it."""
    if len(head) < 24 or not head[3] & 4:
        return None
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(end, len(head)):
        name, size = struct.unpack_from("<2sH", head, at)
        if name == b"sl" and size == 8:
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + size
    return None


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def _inflate_head(f, at: int, end: int) -> bytes:
    """The record's headers, inflating no more than they take."""
    inflate, plain, step = zlib.decompressobj(31), b"", 1024
    while b"\r\n\r\n" not in plain:
        f.seek(at)
        chunk = f.read(min(step, end - at))
        if not chunk:
            break
        plain += inflate.decompress(chunk, 4096)
        while inflate.unconsumed_tail and b"\r\n\r\n" not in plain:
            plain += inflate.decompress(inflate.unconsumed_tail, 4096)
        if inflate.eof:
            break
        at += len(chunk)
    return plain.partition(b"\r\n\r\n")[0]


def _inflate_all(f, at: int, end: int, keep: bool) -> tuple[bytes, int]:
    """Plain bytes (when kept) and the place after a member whose length nobody wrote down."""
    inflate, out = zlib.decompressobj(31), []
    while not inflate.eof and at < end:
        f.seek(at)
        chunk = f.read(min(1 << 18, end - at))
        if not chunk:
            break
        plain = inflate.decompress(chunk)
        if keep:
            out.append(plain)
        at += len(chunk) - len(inflate.unused_data)
    return b"".join(out), at


def payload_of(block: bytes, content_type: str) -> bytes:
    return block.partition(b"\r\n\r\n")[2] if content_type.startswith("application/http") else block


def records(f, begin: int, end: int, wanted: Callable[[dict[str, str]], bool], payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers, and payload when asked for, of the wanted records that begin in the range; plain or gzip members."""
    at, size = begin, f.size()
    while at < end:
        f.seek(at)
        head = f.read(64)
        if not head.strip(b"\r\n\0"):
            return
        if head[:2] == b"\x1f\x8b":
            length = _skip_length(head)
            headers = parse_headers(_inflate_head(f, at, at + length if length else size))
            take = wanted(headers)
            need = payloads and take and headers.get("WARC-Type") != "revisit"
            if length:
                plain = b""
                if need:
                    f.seek(at)
                    plain = zlib.decompress(f.read(length), 31)
                at += length
            else:
                plain, at = _inflate_all(f, at, size, need)
            block = plain.partition(b"\r\n\r\n")[2][: int(headers.get("Content-Length", 0))] if need else None
        else:
            while b"\r\n\r\n" not in head and len(more := f.read(4096)):
                head += more
            top = head.partition(b"\r\n\r\n")[0]
            headers = parse_headers(top)
            take, length = wanted(headers), int(headers.get("Content-Length", 0))
            need = payloads and take and headers.get("WARC-Type") != "revisit"
            block = None
            if need:
                f.seek(at + len(top) + 4)
                block = f.read(length)
            at += len(top) + 4 + length + 4
        if take:
            yield headers, payload_of(block, headers.get("Content-Type", "")) if block is not None else None


def _value(headers: dict[str, str], column: str) -> str | int | None:
    if column == "payload_bytes":
        return int(headers[_BYTES]) if _BYTES in headers else None
    value = headers.get(_FIELDS[column])
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        return value.strip("<>")
    return value.rpartition(":")[2] if column == "payload_digest" else value


_COMPARE = {
    EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, StringStartsWith: lambda a, b: a.startswith(b), IsNotNull: lambda a, b: True,
}


@dataclass
class Stretch(InputPartition):
    path: str
    begin: int
    end: int


class WarcReader(DataSourceReader):
    """payload: ``full`` (payload column filled), ``verify`` (inflated and held against the digest only) or ``none``."""

    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "full")
        self.pushed: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            # Only a header decides: sizes of foreign records are known after inflating them.
            if type(f) in _COMPARE and column in _FIELDS:
                self.pushed.append(f)
            else:
                yield f

    def partitions(self) -> list[Stretch]:
        files, folder = store(self.path)
        listed = [x for x in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.is_file]
        manifests = [x for x in listed if x.base_name.startswith("_manifest-")]
        out = []
        if manifests:
            for m in manifests:
                with files.open_input_stream(m.path) as f:
                    for name, bounds in json.loads(f.read()):
                        out += [Stretch(name, a, b) for a, b in zip(bounds[:-1], bounds[1:])]
        else:
            out = [Stretch(x.base_name, 0, x.size) for x in listed if re.search(r"\.warc(\.gz)?$", x.base_name)]
        return out or [Stretch("", 0, 0)]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for f in self.pushed:
            value = _value(headers, f.attribute[0])
            if value is None or not _COMPARE[type(f)](value, getattr(f, "value", None)):
                return False
        return True

    def read(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        files, folder = store(self.path)
        rows, size = [], 0
        with files.open_input_file(f"{folder}/{part.path}") as f:
            for headers, payload in records(f, part.begin, part.end, self._wanted, self.payload != "none"):
                digest = _value(headers, "payload_digest")
                if payload is not None and digest and (headers["WARC-Payload-Digest"].startswith("sha1:") and digest_of(payload) != digest):
                    raise ValueError(f"payload of {headers.get('WARC-Record-ID')} does not match its digest")
                measured = len(payload) if payload is not None else _value(headers, "payload_bytes")
                rows.append([*(_value(headers, c) for c in _FIELDS), measured, list(headers.items()), payload if self.payload == "full" else None])
                size += 512 + (len(payload or b"") if self.payload == "full" else 0)
                if size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


_ARROW = pa.schema([*((c, pa.string()) for c in _FIELDS), ("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


# --- writing ---------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    name: str
    bounds: list[int]


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, date, refers_to, payload) to archives in a folder."""

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = store(self.path)
        files.create_dir(folder, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid4().hex[:8]}.warc.gz"
        at, bounds = 0, [0]
        with files.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in iterator:
                columns = [batch.column(batch.schema.get_field_index(c)) for c in ("record_type", "record_id", "target_uri", "date", "refers_to", "payload")]
                for k in range(batch.num_rows):
                    kind, record_id, uri, date, refers_to, payload = (c[k].as_py() for c in columns)
                    raw = member(record(kind, record_id, uri, date, payload or b"", refers_to))
                    out.write(raw)
                    at += len(raw)
                    if at - bounds[-1] >= SPLIT_BYTES:
                        bounds.append(at)
        return Written(name, bounds + [at] * (at > bounds[-1]))

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = store(self.path)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/_manifest-{uuid4().hex[:12]}.json") as out:
            out.write(json.dumps([(m.name, m.bounds) for m in messages if m and len(m.bounds) > 1]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing to undo: files that no manifest lists are never read."""


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# --- pages -----------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame) -> DataFrame:
    """Rows for the writer: of equal payloads the largest page_id is the response, the others revisit it."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    largest = written(rows.groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1"), "warc-repeats")
    joined = attach(rows, largest, "digest", "n", ["page_id", "url"])
    top = F.coalesce("top", "page_id")
    response = top.isNull() | (F.col("page_id").eqNullSafe(top))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    return joined.select(
        F.when(response, "response").otherwise("revisit").alias("record_type"), name(F.col("page_id")).alias("record_id"), F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"), F.when(~response, name(top)).alias("refers_to"), F.col("html").cast("binary").alias("payload"),
    )


def write(rows: DataFrame, folder: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").option("path", folder).save()


def read(spark: SparkSession, folder: str, payload: str = "full") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("path", folder).option("payload", payload).load()


def page_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per archived page: size and digest of its payload, and what it is; payloads are inflated and verified."""
    page = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS BIGINT)")
    return read(spark, folder, "verify").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"),
    )
