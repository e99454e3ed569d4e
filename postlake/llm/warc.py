"""WARC archives as seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames that each hold a group of whole WARC records, a skippable frame that
maps record identifiers to (frame, offset in the frame, length), and as footer the seek table of the seekable format
(compressed and decompressed size of each frame), itself a skippable frame. Any Zstandard tool decompresses the whole
file; a reader that wants one record reads the footer, the map and one frame.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, materialize, prepare, read_blobs, tidied, write_blobs

# Fixed values of the Zstandard seekable format: magic numbers of skippable frames and of the footer.
SEEK_TABLE_MAGIC = 0x184D2A5E
RECORD_MAP_MAGIC = 0x184D2A51
SEEKABLE_MAGIC = struct.pack("<I", 0x8F92EAB1)

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 16 * 1024 * 1024
DATE = "1970-01-01T00:00:00Z"

RECORD_SCHEMA = T.StructType([
    T.StructField("record_key", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload", T.BinaryType()), T.StructField("bundle", T.StringType()),
    T.StructField("frame", T.IntegerType()), T.StructField("frame_offset", T.LongType())])


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(s: str) -> str:
    """A header value on one line; other control characters and non-ASCII are percent-encoded."""
    return "".join(c if " " < c < "\x7f" and c != "%" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in s)


def _plain_text(s: str) -> str:
    from urllib.parse import unquote

    return unquote(s)


def record_bytes(key: str | None, uri: str | None, payload: bytes, refers_to: str | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record: a response with an HTTP message, or a revisit with headers only."""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:record:{'' if key is None else _header_text(key)}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest32(payload)}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_header_text(uri)}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:record:{_header_text(refers_to)}>")
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record; checks the payload of a response against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    ident = lambda s: _plain_text(s[len("<urn:record:"):-1])
    return {"uri": _plain_text(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
            "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": ident(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload}


class Bundle:
    """Builds one bundle's bytes (without the last magic number, which the file writer appends)."""

    def __init__(self, frame_bytes: int):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True).compress
        self.frame_bytes, self.parts, self.sizes, self.where = frame_bytes, [], [], []
        self.open, self.open_bytes, self.total = [], 0, 0

    def add(self, key: str | None, record: bytes) -> None:
        if self.open and self.open_bytes + len(record) > self.frame_bytes:
            self.close_frame()
        self.where.append((key, len(self.sizes), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)

    def close_frame(self) -> None:
        if self.open:
            frame = self.pack(b"".join(self.open))
            self.parts.append(frame)
            self.sizes.append((len(frame), self.open_bytes))
            self.total += len(frame)
            self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        self.close_frame()
        entries = self.pack(json.dumps(self.where).encode())
        self.parts.append(struct.pack("<II", RECORD_MAP_MAGIC, len(entries)) + entries)
        self.sizes.append((len(self.parts[-1]), 0))
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IB", len(self.sizes), 0)
        self.parts.append(struct.pack("<II", SEEK_TABLE_MAGIC, len(table) + 9) + table + footer)
        return b"".join(self.parts)


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(position, compressed size, decompressed size) of each frame, from a bundle's footer."""
    if data[-4:] != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the file")
    n = struct.unpack("<I", data[-9:-5])[0]
    sizes = struct.iter_unpack("<II", data[len(data) - 9 - 8 * n:len(data) - 9])
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def record_map(data: bytes, table: list[tuple[int, int, int]]) -> list[tuple]:
    """(record key, frame, offset in the frame, length) of each record."""
    import zstandard

    at, packed, _ = table[-1]
    return [tuple(x) for x in json.loads(zstandard.ZstdDecompressor().decompress(data[at + 8:at + packed]))]


def read_records(data: bytes, keys: set | None = None):
    """The records of a bundle, or those with the given keys; decompresses only frames that hold one."""
    import zstandard

    table = seek_table(data)
    unpack, now, plain = zstandard.ZstdDecompressor().decompress, -1, b""
    for key, frame, offset, length in record_map(data, table):
        if keys is None or key in keys:
            if frame != now:
                at, packed, size = table[frame]
                plain, now = unpack(data[at:at + packed], max_output_size=size), frame
            yield key, frame, offset, parse_record(plain[offset:offset + length])


def with_revisits(pages: DataFrame, id_col: str, payload: Column, min_bytes: int = 0) -> DataFrame:
    """Add ``_payload`` (binary), ``_revisit`` and ``_first``: the smallest id among rows of equal payload.

    Rows of a payload of at least ``min_bytes`` bytes other than those with its smallest id are revisits. A null id
    comes after all others; rows that share the smallest id are all responses.
    """
    data = pages.withColumn("_payload", payload) \
        .withColumn("_digest", F.when(F.octet_length("_payload") >= min_bytes, F.sha1("_payload")))
    groups = data.where(F.col("_digest").isNotNull()).groupBy("_digest") \
        .agg(F.min(id_col).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    out = attach(data, materialize(groups, "warc-groups"), "_digest", "_n", [id_col])
    revisit = F.col("_first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("_first"))
    return out.withColumn("_revisit", revisit).drop("_digest")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url",
                  min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> None:
    """Write a record per row as bundles below ``path``.

    The payload is ``payload_col`` in UTF-8 (null: empty). Every task fills bundles of about ``bundle_bytes`` in the
    order of its rows; a record longer than ``frame_bytes`` has a frame of its own. An empty table writes no bundle.
    Columns other than the three named ones are ignored, whatever their names.
    """
    spark = pages.sparkSession
    prepare(spark)
    uri = F.col(uri_col) if uri_col else F.lit(None)
    rows = pages.select(F.col(id_col).alias("id"), uri.cast("string").alias("uri"), F.col(payload_col).cast("string").alias("text"))
    payload = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = with_revisits(rows.select("id", "uri", "text"), "id", payload, min_bytes).select(
        F.col("id").cast("string").alias("id"), "uri", "_payload", "_revisit", F.col("_first").cast("string").alias("_first"))

    def pack(batches):
        bundle = Bundle(frame_bytes)
        for b in tidied(batches):
            for key, uri, data, revisit, first in zip(*(c.to_pylist() for c in b.columns)):
                bundle.add(key, record_bytes(key, uri, data, first, revisit, date))
                if bundle.total >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.finish()], pa.binary())], names=["bundle"])
                    bundle = Bundle(frame_bytes)
        if bundle.where:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.finish()], pa.binary())], names=["bundle"])

    write_blobs(rows.mapInArrow(pack, "bundle binary"), "bundle", path, SEEKABLE_MAGIC)


def read_archive(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """The records of all bundles below ``path``, found through seek table and record map.

    ``keys``: a short list of record keys; only frames that hold one of them are decompressed. Columns as in
    ``RECORD_SCHEMA``; ``payload`` is null for revisits. A damaged payload or footer is an error.
    """
    prepare(spark)
    wanted = None if keys is None else set(keys)
    names = [f.name for f in RECORD_SCHEMA]
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(RECORD_SCHEMA)

    def unpack(batches):
        for b in tidied(batches):
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows, held = [], 0
                for key, frame, offset, record in read_records(content.as_py(), wanted):
                    rows.append({"record_key": key, "bundle": path, "frame": frame, "frame_offset": offset} | record)
                    held += len(record["payload"] or b"")
                    if held > 8 << 20 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=arrow)

    return read_blobs(spark, path).mapInArrow(unpack, RECORD_SCHEMA)
