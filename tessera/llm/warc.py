"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle ends with a
seek table in a skippable frame (number of frames, their compressed and full
sizes), so any frame can be read alone. The manifest maps each record id to
bundle, frame and the offset inside the frame.

Every task writes bundles of its own rows straight to the shared folder, under
names that no other attempt uses; the manifest, written by Spark, names only
the bundles of attempts that ended well, so lost or repeated attempts leave
at most unused files. Memory is bounded by one frame (or one longer record).

Of records with equal payloads of at least ``min_bytes`` bytes the one with
the smallest page id is a response, the others are revisits that refer to it.

A bundle begins with a warcinfo record. A response holds an HTTP header and
the payload, a revisit only names the response's page, URI and date. Every
record has an id of its own, also where rows repeat a page id.

Defined results: null html counts as an empty payload; rows that repeat the
smallest page id and the payload are responses too (the same capture twice);
a null page id never is the smallest, unless all are null; other columns are
left out, an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small, staged

# fixed values of the seekable format: magic numbers of the skippable frame and of its footer
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

MANIFEST = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("bundle", T.StringType()),
    T.StructField("frame", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("record_id", T.StringType()),
])
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder (any URI that Arrow knows, or a plain path)."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class BundleWriter:
    """Frames of records, then the seek table."""

    def __init__(self, stream, frame_bytes: int):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=3)
        self.sizes: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.filled = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in the frame) of the record."""
        if self.parts and self.filled + len(record) > self.frame_bytes:
            self.end_frame()
        at = len(self.sizes), self.filled
        self.parts.append(record)
        self.filled += len(record)
        return at

    def end_frame(self) -> None:
        packed = self.packer.compress(b"".join(self.parts))
        self.stream.write(packed)
        self.sizes.append((len(packed), self.filled))
        self.written += len(packed)
        self.parts, self.filled = [], 0

    def close(self) -> None:
        if self.parts:
            self.end_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.stream.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, full size) of every frame, from the end of an open bundle."""
    size = file.size()
    frames, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    raw = file.read_at(8 * frames, size - 9 - 8 * frames)
    out, start = [], 0
    for packed, full in struct.iter_unpack("<II", raw):
        out.append((start, packed, full))
        start += packed
    return out


def _one_line(text: str | None) -> str:
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def info_bytes(name: str, date: str) -> bytes:
    """The warcinfo record at a bundle's begin."""
    body = b"format: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <{record_urn(name, 'info')}>", f"WARC-Date: {date}",
            f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def record_urn(bundle: str, number: int | str) -> str:
    """The id of a bundle's n-th record: bundle names are unique, so ids are."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{bundle}/{number}')}"


def record_bytes(urn: str, date: str, page_id: int | None, url: str | None, payload: bytes, refers: tuple | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of ``refers`` (page id, URI), which keeps the length of its payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: <{urn}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {_one_line(url)}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To-Target-URI: {_one_line(refers[1])}", f"WARC-Refers-To-Date: {date}",
                 f"X-Refers-To-Page: {'' if refers[0] is None else refers[0]}"]
        body += b"\r\n"
    else:
        body += b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """The fields of ``RECORD``; a response's length and digest are taken from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    field = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])

    def page(name: str) -> int | None:
        return int(field[name]) if field.get(name) else None

    revisit = field["WARC-Type"] == "revisit"
    payload = rest[: int(field["Content-Length"])].partition(b"\r\n\r\n")[2]
    size = int(field["WARC-Payload-Length"]) if revisit else len(payload)
    digest = (field["WARC-Payload-Digest"].removeprefix("sha1:") if revisit
              else base64.b32encode(hashlib.sha1(payload).digest()).decode())
    return (page("X-Page-ID"), size, digest, field["WARC-Type"], page("X-Refers-To-Page"),
            field["WARC-Target-URI"].replace("%0D", "\r").replace("%0A", "\n"), None if revisit else payload)


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = 0, frame_bytes: int = 1 << 20,
                  bundle_bytes: int = 256 << 20, date: str | None = None) -> DataFrame:
    """Write (page_id, url, html) as bundles under ``folder``; returns the (lazy) manifest.

    Store the manifest and read that: every run of it writes bundles anew.
    ``date`` is the records' WARC-Date (default: now). Only digests that occur
    twice are joined to the pages, by broadcast up to a counted bound.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"),
                        F.unhex(F.sha1(payload)).alias("digest"))
    copies = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"))
              .where("n > 1").select("digest", "first", "first_url", F.lit(True).alias("copied")))
    marked = (rows.join(small(staged(copies, "warc-copies")), "digest", "left")
              .select("page_id", "url", "payload", "first", "first_url",
                      (F.coalesce("copied", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        writer, name, number = None, "", 0
        for batch in batches:
            found = []
            for page_id, url, body, first, first_url, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    name, number = f"{uuid.uuid4().hex}.warc.zst", 0
                    writer = BundleWriter(store.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                    writer.add(info_bytes(name, date))
                number += 1
                urn = record_urn(name, number)
                record = record_bytes(urn, date, page_id, url, body, (first, first_url) if revisit else None)
                frame, offset = writer.add(record)
                found.append((page_id, name, frame, offset, len(record), urn))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            if found:
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                                                 names=MANIFEST.names)
        if writer is not None:
            writer.close()

    return marked.mapInArrow(run, MANIFEST)


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """The records that the manifest names, each frame fetched through its bundle's seek table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        unpack = zstandard.ZstdDecompressor()
        name, file, table, at, data = None, None, [], None, b""
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            out, size = [], 0
            for bundle, frame, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    name, file, at = bundle, store.open_input_file(f"{base}/{bundle}"), None
                    table = seek_table(file)
                if frame != at:
                    start, packed, full = table[frame]
                    at, data = frame, unpack.decompress(file.read_at(packed, start), max_output_size=full)
                out.append(parse_record(data[offset : offset + length]))
                size += length
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=RECORD.names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=RECORD.names)

    # a fixed number of tasks: the manifest is small, but every row of it stands for a whole record
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_frame = manifest.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return by_frame.select("bundle", "frame", "offset", "length").mapInArrow(run, RECORD)
