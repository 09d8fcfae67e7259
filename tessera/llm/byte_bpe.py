"""Byte-level BPE encoding and decoding by monoid tree reduction.

Encoding one piece of text (a match of the splitting pattern) is a reduction
over a tree: the halves are encoded on their own and two neighbouring results
are joined by re-encoding only a window around the border. The window grows
until its outermost tokens equal those that were there. Greedy lowest-rank
merging has the property that a token sequence is the encoding of its bytes
exactly if every two neighbours are the encoding of theirs; all pairs left of
the window, inside it and right of it then come from finished encodings, so
nothing outside can change any more. Decoding joins token bytes up a tree.

Defined results: null text counts as empty, an empty text has no ids; texts
may be of any length (a piece of n bytes costs about n log n); repeated rows
and ids are encoded row by row; other columns pass through, but a column named
as the output column is replaced.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import file_bytes

LEAF_BYTES = 32
LONG_WINDOW = 64
MEMO_BYTES = 48
MEMO_PIECES = 600_000
NEVER = 1 << 40

# fixed values: the general splitting pattern, its white space taken as the Unicode property
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"""
           r"""|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+""")
# the same for texts without a character above U+024F, where the classes are short lists
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\\t-\\r \u0085 "
LATIN_PATTERN = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
                 f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_LATIN = re.compile(LATIN_PATTERN)
_BEYOND_LATIN = re.compile("[^\\x00-ɏ]")
_ANY = regex.compile(PATTERN)


def pieces(text: str) -> list[str]:
    """The matches of the splitting pattern, in order; together they are the text."""
    return (_ANY if _BEYOND_LATIN.search(text) else _LATIN).findall(text)


class ByteBPE:
    """A vocabulary of byte strings by rank, with every single byte in it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token

    @classmethod
    def from_file_bytes(cls, raw: bytes) -> ByteBPE:
        """Lines of base64 token, space, rank."""
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a})

    # -------------------------------------------------------------- leaves and windows
    def _merge_short(self, data: bytes) -> list[int]:
        """Lowest-rank, leftmost merges over cuts; only the pairs beside a merge are looked up again."""
        ranks, get, n = self.ranks, self.ranks.get, len(data)
        cuts = list(range(n + 1))
        pair = [get(data[i : i + 2], NEVER) for i in range(n - 1)]
        while pair and (low := min(pair)) != NEVER:
            i = pair.index(low)
            del cuts[i + 1], pair[i]
            if i < len(pair):
                pair[i] = get(data[cuts[i] : cuts[i + 2]], NEVER)
            if i:
                pair[i - 1] = get(data[cuts[i - 1] : cuts[i + 1]], NEVER)
        return [ranks[data[x:y]] for x, y in zip(cuts, cuts[1:])]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same merges by a heap over (rank, position) and a linked list of parts."""
        n, ranks = len(data), self.ranks
        end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop or not alive[j]:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return [ranks[data[i : end[i]]] for i in range(n) if alive[i]]

    def _merge(self, data: bytes) -> list[int]:
        return self._merge_short(data) if len(data) <= LONG_WINDOW else self._merge_long(data)

    # -------------------------------------------------------------- the monoid
    def join(self, a: list[int], b: list[int]) -> list[int]:
        """Encoding of the two encodings' bytes together."""
        if not a or not b:
            return a or b
        left = right = 1
        while True:
            left, right = min(left, len(a)), min(right, len(b))
            window = self._merge(b"".join(map(self.tokens.__getitem__, a[len(a) - left :] + b[:right])))
            keeps_left = left == len(a) or window[0] == a[-left]
            keeps_right = right == len(b) or window[-1] == b[right - 1]
            if keeps_left and keeps_right:
                return a[: len(a) - left] + window + b[right:]
            left, right = left * (1 if keeps_left else 2), right * (1 if keeps_right else 2)

    def reduce(self, data: bytes) -> list[int]:
        """Encode the halves, join the results."""
        if len(data) <= LEAF_BYTES:
            return self._merge(data)
        middle = len(data) // 2
        return self.join(self.reduce(data[:middle]), self.reduce(data[middle:]))

    def encode_piece(self, data: bytes) -> list[int]:
        """A piece that is itself a token is that token."""
        whole = self.ranks.get(data)
        return self.reduce(data) if whole is None else [whole]

    def decode(self, ids: list[int]) -> bytes:
        """Join token bytes up a tree (leaves of a thousand tokens)."""
        parts = [b"".join(map(self.tokens.__getitem__, ids[i : i + 1024])) for i in range(0, len(ids), 1024)]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


class TextEncoder(dict):
    """text -> ids (little-endian 32 bits), remembering short pieces."""

    def __init__(self, bpe: ByteBPE):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        ids = self.bpe.encode_piece(data)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(data) <= MEMO_BYTES:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, pieces(text))) if text else b""


_ENCODERS: dict[int, TextEncoder] = {}


def encoder(raw: bytes) -> TextEncoder:
    """The encoder of a vocabulary file's bytes; one for each Python worker."""
    key = xxhash.xxh3_64_intdigest(raw)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(ByteBPE.from_file_bytes(raw))
    return _ENCODERS[key]


def mapped(df: DataFrame, sources: list[str], target: str, kind: T.DataType, arrow: pa.DataType,
           make: Callable[[], Callable]) -> DataFrame:
    """``df`` with column ``target`` = make()(values of ``sources``), row by row in Arrow batches."""
    kept = [c for c in df.columns if c != target]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(target, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in sources]
            new = pa.array(map(f, *columns), arrow, size=batch.num_rows)
            old = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*old, new], names=[*kept, target])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the token ids of ``text`` as little-endian unsigned 32-bit integers (binary).

    ``vocabulary`` is a rank file's path on the driver; its bytes (under a
    megabyte) travel with the tasks.
    """
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(vocabulary))
    return mapped(df, [text], ids, T.BinaryType(), pa.binary(), lambda: encoder(shared.value).encode)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes that ``ids`` stand for (null ids: no bytes)."""
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(vocabulary))

    def make():
        bpe = encoder(shared.value).bpe
        return lambda packed: bpe.decode(np.frombuffer(packed or b"", "<u4").tolist())

    return mapped(df, [ids], decoded, T.BinaryType(), pa.binary(), make)
