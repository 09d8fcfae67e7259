"""Token packing: best-fit-decreasing bins with segment-tree capacity search.

Token sequences are packed into rows of ``length`` ids. A sequence longer
than a row is split without loss: whole rows first, the rest is packed like a
short sequence. Within a block of documents (``block_tokens`` at most, or one
longer document) the pieces are placed longest first, each into the open row
with the least room that still holds it; a segment tree over the possible
capacities finds that row in log(length) steps. Blocks are cut from the
running task's rows, so nothing is shuffled and memory is bounded by a block.

Every packed row holds the ids (padded), the cumulative segment lengths, and
positions that restart at 0 with every segment.

Defined results: a document's ids are followed by the end id, so empty and
null documents are one end id; repeated documents are packed once per row;
a null id is carried as null; an empty table gives no rows; other columns are
not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN as SPLIT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import ByteBPE
from .common import file_bytes, task_number

OUTPUT_BYTES = 4 << 20

PACKED = T.StructType([
    T.StructField("pack_id", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("positions", T.BinaryType()),
    T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("doc_starts", T.ArrayType(T.LongType())),
])
PACKED_ARROW = pa.schema([
    ("pack_id", pa.int64()), ("ids", pa.binary()), ("positions", pa.binary()),
    ("cu_seqlens", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())),
])


class CapacityTree:
    """Open bins by free capacity; finds the smallest free capacity that is large enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, number: int) -> None:
        self.bins[free].append(number)
        node = free + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (free, number) of the fullest bin with ``need`` free, if there is one."""
        node = need + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not self.count[node]:
                    node += 1
        free = node - self.size
        while node:
            self.count[node] -= 1
            node >>= 1
        return free, self.bins[free].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths`` (each at most ``capacity``); equal lengths in given order."""
    tree, bins = CapacityTree(capacity), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None:
            found = (capacity, len(bins))
            bins.append([])
        bins[found[1]].append(i)
        if found[0] > need:
            tree.add(found[0] - need, found[1])
    return bins


def pack_block(docs: list[tuple[int | None, np.ndarray]], length: int, pad: int, dtype: str) -> Iterator[tuple]:
    """Packed rows (ids, positions, cu_seqlens, doc_ids, doc_starts) of one block."""
    pieces = [(doc, start, ids[start : start + length]) for doc, ids in docs for start in range(0, len(ids), length)]
    for members in best_fit_decreasing(np.array([len(p[2]) for p in pieces], np.int64), length):
        row, used, cu = np.full(length, pad, dtype), 0, [0]
        places = np.zeros(length, "<u4")
        for i in members:
            part = pieces[i][2]
            row[used : used + len(part)] = part
            places[used : used + len(part)] = np.arange(len(part))
            used += len(part)
            cu.append(used)
        yield row.tobytes(), places.tobytes(), cu, [pieces[i][0] for i in members], [pieces[i][1] for i in members]


_ENCODINGS: dict[int, tiktoken.Encoding] = {}


def _encoding(raw: bytes) -> tiktoken.Encoding:
    key = hash(raw)
    if key not in _ENCODINGS:
        ranks = ByteBPE.from_file_bytes(raw).ranks
        _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[key]


def pack(df: DataFrame, doc_id: str = "doc_id", ids: str = "ids", length: int = 2048, end: int = 50256,
         pad: int = 50256, dtype: str = "<u2", block_tokens: int = 2_000_000) -> DataFrame:
    """Packed rows of the documents' ids (binary, little-endian unsigned 32-bit integers).

    ``dtype`` is the matrix's element type ("<u2" for vocabularies up to 65,536
    ids, else "<u4"; an id that does not fit raises ValueError); ``pack_id`` is
    unique: task number and running number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = ((doc, np.frombuffer(packed or b"", "<u4"))
                for batch in batches for doc, packed in zip(batch.column(0), batch.column(1).to_pylist()))
        return _packed(docs, length, end, pad, dtype, block_tokens)

    return df.select(doc_id, ids).mapInArrow(run, PACKED)


def pack_texts(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", length: int = 2048,
               end: int = 50256, pad: int = 50256, dtype: str = "<u2", block_tokens: int = 2_000_000) -> DataFrame:
    """``pack`` of the documents' texts, encoded by the tokenizer library in the same worker: ids never leave it unpacked."""
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(shared.value).encode_ordinary
        # one text at a time becomes a Python string
        docs = ((doc, np.array(encode(t.as_py() or ""), "<u4"))
                for batch in batches for doc, t in zip(batch.column(0), batch.column(1)))
        return _packed(docs, length, end, pad, dtype, block_tokens)

    return df.select(doc_id, text).mapInArrow(run, PACKED)


def _packed(docs: Iterator[tuple[pa.Scalar, np.ndarray]], length: int, end: int, pad: int, dtype: str,
            block_tokens: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches of packed rows, block by block, of (doc_id, ids) pairs."""
    first, block, tokens = task_number() << 32, [], 0
    largest = np.iinfo(dtype).max
    at_once = max(1, OUTPUT_BYTES // (length * (4 + np.dtype(dtype).itemsize)))

    def flush():
        nonlocal first
        rows = []
        for row in pack_block(block, length, pad, dtype):
            rows.append((first, *row))
            first += 1
            if len(rows) == at_once:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)

    if max(end, pad) > largest:
        raise ValueError(f"id {max(end, pad)} does not fit into {dtype}")
    for doc, ids in docs:
        if len(ids) and int(ids.max()) > largest:
            raise ValueError(f"id {int(ids.max())} of document {doc.as_py()} does not fit into {dtype}")
        own = np.append(ids, np.uint32(end)).astype(dtype)
        if block and tokens + len(own) > block_tokens:
            yield from flush()
            block, tokens = [], 0
        block.append((doc.as_py(), own))
        tokens += len(own)
    if block:
        yield from flush()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED_ARROW)], schema=PACKED_ARROW)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as zstd Parquet: one row of the id matrix per record."""
    packed.write.option("compression", "zstd").parquet(path)


def segments(packed: DataFrame, dtype: str = "<u2") -> DataFrame:
    """One row per segment, read back: pack_id, segment, doc_id, doc_start, offset, n_tokens, resets, ids_sha256.

    ``resets`` tells whether the positions of the segment count up from 0;
    the digest is over the segment's ids as 32-bit integers.
    """
    import hashlib

    schema = T.StructType([
        T.StructField("pack_id", T.LongType()), T.StructField("segment", T.IntegerType()),
        T.StructField("doc_id", T.LongType()), T.StructField("doc_start", T.LongType()),
        T.StructField("offset", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()),
        T.StructField("resets", T.BooleanType()), T.StructField("ids_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (large.slice(i, 256) for large in batches for i in range(0, large.num_rows, 256)):
            out = []
            for pack_id, ids, positions, cu, docs, starts in zip(*(c.to_pylist() for c in batch.columns)):
                row, places = np.frombuffer(ids, dtype).astype("<u4"), np.frombuffer(positions, "<u4")
                for i, (a, b) in enumerate(zip(cu, cu[1:])):
                    out.append((pack_id, i, docs[i], starts[i], a, b - a,
                                bool((places[a:b] == np.arange(b - a)).all()), hashlib.sha256(row[a:b]).hexdigest()))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], pa.schema([
                ("pack_id", pa.int64()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("doc_start", pa.int64()),
                ("offset", pa.int32()), ("n_tokens", pa.int32()), ("resets", pa.bool_()), ("ids_sha256", pa.string())]))

    columns = ["pack_id", "ids", "positions", "cu_seqlens", "doc_ids", "doc_starts"]
    return packed.select(*(F.col(c) for c in columns)).mapInArrow(run, schema)
