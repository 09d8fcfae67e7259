r"""Chat formatting: token-level assembly of conversations with a loss mask.

Every turn is assembled from ids: the reserved id of a control string, then
the role, the text and again control ids, each segment encoded on its own, so
no token ever spans a border. The rendered form of a turn is
``<turn>role<text>text</turn>``. The loss mask comes from prefix sums: +1 where
a text under the loss begins, -1 behind it, added up along the turn.

Control strings inside roles and texts are escaped: one backslash is put
before each, whatever backslashes precede it already; unescaping takes one
away from each. As control strings hold no backslash and cannot overlap, this
is reversible. Ids in encoded segments are never reserved ids, so reading back
needs no search in text.

Defined results: null role or text counts as empty; a null conversation id is
a conversation of its own; turns are taken by turn number (null first), ties
by role, then text, so repeated rows all stay; an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import encoder
from .common import file_bytes

# fixed values: the template's control strings; their ids follow the vocabulary's
CONTROLS = ("<turn>", "<text>", "</turn>")
_CONTROL = re.compile("(?:<turn>|<text>|</turn>)")
_ESCAPED = re.compile(r"\\(\\*(?:<turn>|<text>|</turn>))")
TURN, TEXT, CLOSE = range(3)

FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("ids", T.BinaryType()), T.StructField("loss_mask", T.BinaryType()),
])


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def assemble(enc, base: int, role: str, text: str, loss_roles: frozenset[str]) -> tuple[bytes, bytes]:
    """(ids, mask) of one turn; ``base`` is the first reserved id."""
    name, body = enc.encode(escape(role)), enc.encode(escape(text))
    control = [np.array([base + i], "<u4") for i in (TURN, TEXT, CLOSE)]
    parts = [control[0], np.frombuffer(name, "<u4"), control[1], np.frombuffer(body, "<u4"), control[2]]
    ids = np.concatenate(parts)
    steps = np.zeros(len(ids) + 1, np.int8)
    if role in loss_roles:
        steps[2 + len(parts[1])] += 1
        steps[2 + len(parts[1]) + len(parts[3])] -= 1
    return ids.tobytes(), np.cumsum(steps[:-1], dtype=np.int8).tobytes()


def format_turns(df: DataFrame, vocabulary: str, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Rows (conv_id, turn, ids, loss_mask): turns of (conv_id, turn, role, text) as ids and mask.

    ``ids`` are little-endian unsigned 32-bit integers, ``loss_mask`` a byte
    (0 or 1) for each id. No shuffle: a conversation's rows joined in order
    are its token sequence.
    """
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(vocabulary))
    roles = frozenset(loss_roles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        base = len(enc.bpe.tokens)
        for batch in batches:
            made = [assemble(enc, base, r or "", t or "", roles)
                    for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.binary()),
                 pa.array([m[1] for m in made], pa.binary())], names=FORMATTED.names)

    source = df.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return source.mapInArrow(run, FORMATTED)


def read_turns(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """Rows (conv_id, turn, role, text, loss_text, rendered_chars) read back from ids and mask."""
    shared = formatted.sparkSession.sparkContext.broadcast(file_bytes(vocabulary))
    schema = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("loss_text", T.StringType()), T.StructField("rendered_chars", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value).bpe
        base = len(bpe.tokens)
        for batch in batches:
            rows = []
            for packed, mask in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                ids, under = np.frombuffer(packed, "<u4"), np.frombuffer(mask, np.int8) > 0
                middle = int(np.flatnonzero(ids == base + TEXT)[0])
                role = bpe.decode(ids[1:middle].tolist()).decode()
                text = bpe.decode(ids[middle + 1 : -1].tolist()).decode()
                lost = bpe.decode(ids[under & (ids < base)].tolist()).decode()
                rows.append((unescape(role), unescape(text), unescape(lost),
                             len(role) + len(text) + sum(map(len, CONTROLS))))
            new = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.string()) for c in new[:3]),
                 pa.array(new[3], pa.int64())], names=schema.names)

    return formatted.select(*FORMATTED.names).mapInArrow(run, schema)


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation from ``read_turns``: counts and SHA-256 digests in turn order.

    A conversation's turns meet in one partition, sorted, and are hashed as a
    stream: memory holds one batch and one hash state, however long it is.
    """
    schema = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def row():
            n, turns_hash, loss_chars, loss_hash, chars = state
            return (now[0], n, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars)

        for batch in batches:
            done = []
            for conv, role, text, lost, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (conv,):
                    if now:
                        done.append(row())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(lost)
                state[3].update(lost.encode())
                state[4] += chars
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=schema.names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row(), kinds)], names=schema.names)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text", "loss_text", "rendered_chars").mapInArrow(run, schema)
