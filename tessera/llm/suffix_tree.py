"""Language-model scoring by a probabilistic suffix tree over words.

A context is a run of words; its next-symbol distribution is kept as a node
(a state) of the tree only if it differs from that of the context without its
first word. A continuation is kept if it gains more than ``gain`` nats of
log-likelihood over the parent's distribution, a context if the weighted
Kullback-Leibler divergence over its kept continuations and the rest together
exceeds ``gain`` nats for each. The tree grows a word deeper as long as the
test keeps a context (``order`` can set an end). Every token is scored in the
state of its longest suffix in the tree. A state spreads what its kept
continuations leave, and ``mu`` counts more, like its parent; the root is the
unigram distribution with half a count for every word and for unknown words.
All distributions sum to one.

How it runs: tasks turn their rows into blocks (at most ``block_bytes`` of
text, or one longer text) of word numbers, numbered in the order of the words'
64-bit hashes, written once where they lie as a table bucketed by block. A
level takes two walks over the blocks. In the first a block sends two kinds of
keys, sorted and packed by ranges of keys, of which a task sums one at a time
(``RANGE`` tokens of the corpus each on average): its contexts, each with the
sums over the continuations that gain and that it is the first block to have,
and the runs one word longer that can matter then (not known to be rarer than
``LEAST``, a context tested that they end with or follow), each with its count
in training texts. Back go, packed in the same order, the kept continuations of
contexts that pass the divergence test (0 for the others) and the runs' counts
(0 below ``LEAST``) with a mark in the first block. Words and pairs of words
need no figures to be found and go first, together. In the second walk a block
puts these figures at its tokens and writes them, a table bucketed alike for
each level. So no run of an earlier level is sorted or sent again. From level
``SPARSE`` on only tokens that are still in a state, and their probabilities,
are written: those become fewer with every level. The test is the only pruning besides the fixed
``LEAST``; the tree grows with the corpus and is never collected or broadcast.
Words go by hashes of 64 bits, runs of 63: of g different runs about
g * g / 2**64 pairs are taken for each other.

Defined results: null text counts as empty; an empty text is its end token;
repeated rows count and are scored row by row; without training rows all
counts are 0 and every probability is 1 (half a count for one unknown word);
a null id counts as empty text in the fold; an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path
from ..sources.io import write_bucketed
from .common import GOLDEN, fold, mix, staged, task_number

BLOCK = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("held_out", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.IntegerType())),
    T.StructField("n_train", T.LongType()), T.StructField("tokens", T.BinaryType()), T.StructField("hashes", T.BinaryType()),
])
SCORE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
])
# a block's runs or contexts in one range of keys: the runs' counts; or the contexts' totals, sums of kept continuations
# and numbers of these, with two sums more (``gains``) where there are any
SENT = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("level", T.IntegerType()),
    T.StructField("kind", T.IntegerType()), T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    T.StructField("gains", T.BinaryType()),
])
# what goes back to a block for them, in the same order; ``n`` are the words, runs or states that no smaller block has
FOUND = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("level", T.IntegerType()),
    T.StructField("kind", T.IntegerType()), T.StructField("figures", T.BinaryType()), T.StructField("n", T.LongType()),
])
# what a block knows of a level: counts of the runs that end in its tokens (1: not counted) and which of them it is the first
# to have; level 1: counts of its words (``taken``); level 2: kept continuations of its words as contexts (``taken``);
# from level 3 on counts stand at ``places`` only, and probabilities and counts of contexts at the tested tokens; its texts'
# figures so far; ``n`` are the states of the level before that no smaller block has
LEVEL = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("counts", T.BinaryType()), T.StructField("marks", T.BinaryType()),
    T.StructField("taken", T.BinaryType()), T.StructField("places", T.BinaryType()), T.StructField("tested", T.BinaryType()),
    T.StructField("p", T.BinaryType()), T.StructField("totals", T.BinaryType()), T.StructField("known", T.ArrayType(T.LongType())),
    T.StructField("base", T.ArrayType(T.DoubleType())), T.StructField("score", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType()),
])
RUN, CONTEXT = 0, 1
END = b""  # no word is empty
RANGE = 1_000_000
SPARSE = 3  # from this level on few tokens are left
LEAST = 2  # a run seen once says nothing of what follows it; the same at every corpus size


_EVEN = np.uint64((1 << 64) - 2)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def numbered(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(different words, word numbers of all texts, how many words each text has); A-Z count as lower case."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < ends[1:]]
    begins[first] = inside[first]
    begins = np.flatnonzero(begins)
    # the words one after the other, without white space
    places = np.cumsum(inside, dtype=np.int32 if len(inside) < 1 << 31 else np.int64)
    places = (np.r_[places[begins] - 1, places[-1:]] if len(begins) else np.zeros(1)).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(places), pa.py_buffer(_LOWER[data[inside]])])
    found = found.dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(), np.diff(np.searchsorted(begins, ends))


def blocks(docs: DataFrame, block_bytes: int, folds: int, held: int) -> DataFrame:
    """Rows of ``BLOCK``; words are numbered in the order of their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, filled = task_number() << 32, [], 0

        def row():
            ids, texts, held_out = (pa.concat_arrays([r.column(c) for r in rows]) for c in range(3))
            vocabulary, found, sizes = numbered(texts)
            sizes += 1
            tokens = np.full(sizes.sum(), len(vocabulary), np.int32)
            is_word = np.ones(len(tokens), bool)
            is_word[np.cumsum(sizes) - 1] = False
            tokens[is_word] = found
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, (*vocabulary, END)), np.uint64, len(vocabulary) + 1)
            # words of one hash are one word
            hashes, rank = np.unique(hashes, return_inverse=True)
            n_train = int(sizes[~np.array(held_out)].sum())
            values = (number, ids.to_pylist(), held_out.to_pylist(), sizes.tolist(), n_train, packed(rank.astype(np.int32)[tokens]),
                      packed(np.diff(hashes, prepend=np.uint64(0))))
            return _batch([values], BLOCK)

        for batch in batches:
            begin = 0
            for i, size in enumerate(pc.binary_length(batch.column(1)).fill_null(0).to_pylist()):
                if (rows or i > begin) and filled + size > block_bytes:
                    rows += [batch.slice(begin, i - begin)]
                    yield row()
                    number, rows, filled, begin = number + 1, [], 0, i
                filled += size
            rows += [batch.slice(begin)]
        if any(r.num_rows for r in rows):
            yield row()

    held_out = fold(F.col("doc_id"), folds) == held
    return docs.select(F.col("doc_id").cast("long"), F.col("text"), held_out.alias("held_out")).mapInArrow(run, BLOCK)


def packed(values: np.ndarray) -> bytes:
    """Values, compressed byte by byte of their places."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def unpacked(data: bytes, kind: type = np.int64) -> np.ndarray:
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(places.T).view(kind).ravel()


def packed_counts(values: np.ndarray) -> bytes:
    """Numbers from 0 up, most of them small, compressed: a byte each, 255 for those that follow in full."""
    low, high = np.minimum(values, 255).astype(np.uint8), values[values >= 255].astype(np.int64)
    places = high.view(np.uint8).reshape(len(high), 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(len(low).to_bytes(8, "little") + low.tobytes() + places)


def unpacked_counts(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    low, high = np.frombuffer(raw, np.uint8, n, 8), np.frombuffer(raw, np.uint8, offset=8 + n).reshape(8, -1)
    high = np.ascontiguousarray(high.T).view(np.int64).ravel()
    out = low.astype(np.int32 if high.max(initial=0) < 1 << 30 else np.int64)
    out[low == 255] = high
    return out


def spread(p: np.ndarray, own: np.ndarray, total: np.ndarray, taken: np.ndarray, mu: float) -> np.ndarray:
    """A state's probabilities from its parent's: kept continuations, and the rest spread like the parent."""
    return (own + (mu + total - taken) * p) / (total + mu)


def stepped(p: np.ndarray, seen: np.ndarray, total: np.ndarray, taken: np.ndarray, setting: Setting) -> np.ndarray:
    """Probabilities one level deeper, in states."""
    return spread(p, np.where(gaining(seen, total * p, setting.gain), seen, 0), total, taken, setting.mu)


def gaining(counts: np.ndarray, expected: np.ndarray, gain: float) -> np.ndarray:
    """Whether continuations gain over the parent's distribution."""
    out = counts > expected
    out[out] = counts[out] * np.log(counts[out] / expected[out]) > gain
    return out


@dataclass
class Setting:
    """What all blocks need to know: training tokens and words, the test's threshold, smoothing."""

    n: int
    v: int
    gain: float
    mu: float
    parts: int


class Block:
    """A block's tokens (word numbers), hashes of its words, and what it knows of levels (``row``)."""

    def __init__(self, row: dict, parts: int):
        self.row, self.parts, self.sizes = row, parts, np.array(row["sizes"], np.int64)
        self.tokens, self.hashes = unpacked(row["tokens"], np.int32), np.cumsum(unpacked(row["hashes"], np.uint64), dtype=np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def keys(self, places: np.ndarray, width: int) -> np.ndarray:
        """Hashes (without the lowest bit) of the runs of ``width`` words that end in tokens ``places``."""
        key = self.hashes[self.tokens[places - (width - 1)]]
        for back in range(width - 2, -1, -1):
            key = mix(key * np.uint64(GOLDEN) + self.hashes[self.tokens[places - back]])
        return key & _EVEN

    def spread(self, places: np.ndarray, values) -> np.ndarray:
        """Values at tokens, 0 elsewhere."""
        out = np.zeros(len(self.tokens), getattr(values, "dtype", bool))
        out[places] = values
        return out

    def followers(self) -> np.ndarray:
        """Tokens with a word before them in their text."""
        out = np.ones(len(self.tokens), bool)
        out[self.starts] = False
        return np.flatnonzero(out)

    def counts(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, counts of the runs of ``level`` + 1 words that end in all tokens): those without a count are rarer than ``LEAST``."""
        counts = unpacked_counts(self.row[f"counts_{level}"])
        if level < SPARSE:
            return np.flatnonzero(counts), counts
        places = np.cumsum(unpacked_counts(self.row[f"places_{level}"]), dtype=np.int64)
        return places, self.spread(places, counts)

    def marks(self, level: int, places: np.ndarray) -> np.ndarray:
        """Whether this block is the first to have the run that ends in a token, once a run."""
        bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.row[f"marks_{level}"]), np.uint8)
        if level < SPARSE:
            return np.unpackbits(bits, count=len(self.tokens)).astype(bool)
        return self.spread(places, np.unpackbits(bits, count=len(places)).astype(bool))

    def tested(self, level: int, setting: Setting) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tokens whose contexts of ``level`` words are tested, their probabilities in shorter ones, counts of the contexts)."""
        if level >= SPARSE:
            row = [self.row[f"{c}_{level}"] for c in ("tested", "p", "totals")]
            return np.cumsum(unpacked_counts(row[0]), dtype=np.int64), unpacked(row[1], np.float64), unpacked_counts(row[2])
        own, places = unpacked_counts(self.row["taken_1"]), self.followers()
        total = own[self.tokens[places - 1]]
        places, total = places[total >= LEAST], total[total >= LEAST]
        p = (own[self.tokens[places]] + 0.5) / (setting.n + 0.5 * (setting.v + 1))
        if level == 1:
            return places, p, total
        taken, counts = unpacked_counts(self.row["taken_2"])[self.tokens[places - 1]], self.counts(1)[1]
        deeper = (taken > 0) & (counts[places - 1] >= LEAST)
        places, p, total, taken = places[deeper], p[deeper], total[deeper], taken[deeper]
        return places, stepped(p, counts[places], total, taken, setting), counts[places - 1]

    def runs(self, tested: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens whose runs a word longer are sent, tokens whose runs can be as frequent as ``LEAST``).

        ``tested`` and ``counted`` are the tokens of the level before. A run is counted if its context
        may be tested, or if it can be a context itself one level deeper.
        """
        often = counted[1:][np.diff(counted) == 1]  # a first token of a text has no count
        near = self.spread(tested, True)
        near[tested - 1] = True
        return often[near[often]], often

    def contexts(self, level: int, tested: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys of the contexts of ``level`` words before tokens ``tested``, number of each token's)."""
        if level > 1:
            return np.unique(self.keys(tested - 1, level), return_inverse=True)
        there = np.zeros(len(self.hashes), bool)
        there[self.tokens[tested - 1]] = True
        return self.hashes[there], (np.cumsum(there) - 1)[self.tokens[tested - 1]]

    def by_text(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, dtype=np.float64 if values.dtype == np.float64 else np.int64)

    def in_training(self) -> np.ndarray:
        return np.repeat(~np.array(self.row["held_out"], bool), self.sizes)

    def counted(self, level: int, places: np.ndarray) -> list[tuple]:
        """Rows of ``SENT`` of the runs of ``level`` + 1 words that end in ``places``, with their counts in training texts."""
        keys = np.sort(self.keys(places, level + 1) | self.in_training()[places])  # the free bit tells training texts
        train, keys = (keys & np.uint64(1)).astype(np.int64), keys & _EVEN
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        return self.sent(keys[first], np.add.reduceat(train, first)[None] if len(first) else train[None], level, RUN)

    def sent(self, keys: np.ndarray, counts: np.ndarray, level: int, kind: int, gains: np.ndarray | None = None) -> list[tuple]:
        ends = np.array([(-(-(p << 32) // self.parts)) << 32 for p in range(self.parts)], np.uint64)
        cuts = [*np.searchsorted(keys, ends).tolist(), len(keys)]
        # keys ascend: their differences are smaller
        return [(self.row["block"], p, level, kind, packed(np.diff(keys[a:b], prepend=np.uint64(0))), packed_counts(counts[:, a:b].ravel()),
                 None if gains is None else packed(gains[:, a:b][:, counts[2, a:b] > 0].ravel()))
                for p, (a, b) in enumerate(pairwise(cuts)) if a < b]


def first_sent(block: Block) -> list[tuple]:
    """Rows of ``SENT`` of all words and pairs of words."""
    n = np.bincount(block.tokens[block.in_training()], minlength=len(block.hashes))
    return block.sent(block.hashes, n[None], 0, RUN) + block.counted(1, block.followers())


def next_sent(block: Block, setting: Setting, level: int) -> list[tuple]:
    """Rows of ``SENT`` of the contexts of ``level`` words, and of the runs that are one word longer than this level's."""
    tested, p, total = block.tested(level, setting)
    contexts, of = block.contexts(level, tested)
    counted, counts = block.counts(level)
    at = np.flatnonzero(block.marks(level, counted)[tested])
    at = at[gaining(counts[tested[at]], total[at] * p[at], setting.gain)]
    seen, place = counts[tested[at]], of[at]
    figures, gains = np.zeros((3, len(contexts)), np.int64), np.zeros((2, len(contexts)))
    figures[0, of] = total
    figures[1:] = [np.bincount(place, x, len(contexts)) for x in (seen, None)]
    gains[:] = [np.bincount(place, x, len(contexts)) for x in (p[at], seen * np.log(seen / (total[at] * p[at])))]
    return block.sent(contexts, figures, level, CONTEXT, gains) + block.counted(level + 1, block.runs(tested, counted)[0])


def known(block: Block, found: dict, setting: Setting, level: int) -> tuple:
    """The block's row of ``LEVEL`` up to ``score``: what was found, at its tokens. ``found`` gives figures by (level, kind)."""
    row, figures = block.row, found.get((level, RUN), np.zeros(0, np.int32))
    taken, left = None, (None, None, None)
    if level == 1:
        taken = found[0, RUN] >> 1
        base = np.log10((taken + 0.5) / (setting.n + 0.5 * (setting.v + 1)))
        base = block.by_text(base[block.tokens])
        of_text = (block.by_text(taken[block.tokens] > 0), base, base)
        places = often = block.followers()
    else:
        tested, old, total = block.tested(level - 1, setting)
        counted, counts = block.counts(level - 1)
        places, often = block.runs(tested, counted)
        of = block.contexts(level - 1, tested)[1]
        kept = found.get((level - 1, CONTEXT), np.zeros(0, np.int32))[of]
        if level == 2:
            taken = np.zeros(len(block.hashes), np.int64)
            taken[block.tokens[tested - 1]] = kept
        # what states change
        tested, old, total, kept = (x[kept > 0] for x in (tested, old, total, kept))
        p = stepped(old, counts[tested], total, kept, setting)
        text = np.searchsorted(block.starts, tested, "right") - 1
        of_text = (row["known"], row["base"], np.array(row["score"]) + np.bincount(text, np.log10(p) - np.log10(old), len(block.sizes)))
        if level >= SPARSE:
            total = counts[tested - 1]
            deeper = total >= LEAST
            left = (packed_counts(np.diff(tested[deeper], prepend=0)), packed(p[deeper]), packed_counts(total[deeper]))
    runs, of = np.unique(block.keys(places, level + 1), return_inverse=True)
    counts = block.spread(often, np.ones(len(often), np.int32 if figures.dtype == np.int32 else np.int64))
    counts[places] = (figures >> 1)[of]
    one = np.zeros(len(runs), np.int64)
    one[of] = places  # any token of a run
    marks = block.spread(one[(figures & 1) > 0], True)
    where = None
    if level >= SPARSE:
        often = often[counts[often] > 0]
        counts, marks, where = counts[often], marks[often], packed_counts(np.diff(often, prepend=0))
    marks = zstandard.ZstdCompressor(level=1).compress(np.packbits(marks).tobytes())
    return row["block"], packed_counts(counts), marks, None if taken is None else packed_counts(taken), where, *left, *of_text


def _batch(rows: list[tuple], schema: T.StructType, kind=pa.RecordBatch):
    schema = to_arrow_schema(schema)
    columns = zip(*rows) if rows else [[] for _ in schema]
    return kind.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def sending(rows: DataFrame, parts: int, rows_of) -> DataFrame:
    """Rows of ``SENT`` that ``rows_of`` makes of each block."""
    def run(row: pa.Table) -> pa.Table:
        return _batch(rows_of(Block(row.to_pylist()[0], parts)), SENT, pa.Table)

    return rows.groupBy("block").applyInArrow(run, SENT)


def placed(rows: DataFrame, found: DataFrame, setting: Setting, level: int) -> DataFrame:
    """Rows of ``LEVEL``; ``rows`` are blocks with the levels so far."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        figures, right = {}, right.sort_by("part").to_pylist()
        for r in right:
            figures.setdefault((r["level"], r["kind"]), []).append(unpacked_counts(r["figures"]))
        figures = {at: np.concatenate(x) for at, x in figures.items()}
        states = sum(r["n"] for r in right if r["kind"] == CONTEXT)
        return _batch([(*known(Block(left.to_pylist()[0], setting.parts), figures, setting, level), states)], LEVEL, pa.Table)

    return rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, LEVEL)


def summed(sent: DataFrame, gain: float) -> DataFrame:
    """Rows of ``FOUND``: for each run of a block twice its count in all training texts, and 1 more in the first block
    that has it; for each context the sum of its kept continuations if it is a state."""
    def figures(rows: list[dict]) -> Iterator[tuple]:
        level, kind = rows[0]["level"], rows[0]["kind"]
        keys = [np.cumsum(unpacked(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        keys, of = np.unique(np.concatenate(keys), return_inverse=True)
        first = np.empty(len(keys), np.int64)
        first[of[::-1]] = np.arange(len(of))[::-1]
        counts = np.concatenate([unpacked_counts(r["counts"]).reshape(1 if kind == RUN else 3, -1) for r in rows], axis=1)
        if kind == RUN:
            seen = np.bincount(of, counts[0], len(keys)).astype(np.int64)
            new = seen >= (LEAST if level else 1)
            out = np.where(new, seen * 2, 0)[of]
            out[first] += new
        else:
            gains = np.zeros((2, len(of)))
            gains[:, counts[2] > 0] = np.concatenate([unpacked(r["gains"], np.float64).reshape(2, -1) for r in rows], axis=1)
            whole = counts[0][first]
            taken, n, expected, gained = (np.bincount(of, x, len(keys)) for x in (*counts[1:], *gains))
            rest = np.maximum(whole - taken, 0.5)
            divergence = gained + rest * np.log(rest / whole / np.maximum(1 - expected, 1e-12))
            new = (n > 0) & (divergence > gain * n)
            out = np.where(new, taken, 0).astype(np.int64)[of]
        at_first = np.zeros(len(out), bool)
        at_first[first[new]] = True
        for r, own, n in zip(rows, np.split(out, ends), np.split(at_first, ends)):
            yield r["block"], r["part"], level, kind, packed_counts(own), int(n.sum())

    def run(rows: pa.Table) -> pa.Table:
        rows, out = sorted(rows.to_pylist(), key=lambda r: (r["level"], r["kind"], r["block"])), []
        for _, same in groupby(rows, key=lambda r: (r["level"], r["kind"])):
            out += figures(list(same))
        return _batch(out, FOUND, pa.Table)

    return sent.groupBy("part").applyInArrow(run, FOUND)


def score(docs: DataFrame, folds: int = 5, held: int = 1, block_bytes: int = 4_000_000, gain: float = 6.0, mu: float = 20.0,
          order: int | None = None) -> DataFrame:
    """Rows of ``SCORE`` for all documents; learns from those outside fold ``held``.

    ``order`` ends the growth at contexts of so many words (default: the
    divergence test alone does).
    """
    spark, size = docs.sparkSession, docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a few blocks each: fewer files; a task still holds one at a time
    buckets = min(size // (8 * block_bytes) + spark.sparkContext.defaultParallelism, 100_000)

    def kept(df: DataFrame, name: str) -> DataFrame:
        # written where it lies: a task has whole blocks
        path = scratch_path(spark, name)
        return write_bucketed(df, path, os.path.basename(path).replace("-", "_"), ["block"], buckets, placed=True)

    rows = kept(blocks(docs, block_bytes, folds, held), "lm-blocks")
    n, tokens = rows.agg(F.coalesce(F.sum("n_train"), F.lit(0)),
                         F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)), F.lit(0))).first()
    parts, so_far = tokens // RANGE + 1, rows.drop("doc_ids", "n_train")
    found = staged(summed(sending(so_far, parts, first_sent), gain), "lm-found")
    v = found.where(f"level = 0 AND kind = {RUN}").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    setting, level = Setting(n, v, gain, mu, parts), 1
    now = kept(placed(so_far, found, setting, level), "lm-level")
    while order is None or level <= order:
        # a level from SPARSE on says all that the next one needs
        own = ("counts", "marks", "places", "tested", "p", "totals") if level >= SPARSE else ("counts", "marks", "taken")
        before = so_far if level < SPARSE else rows.drop("doc_ids", "n_train")
        so_far = before.drop("known", "base", "score").join(
            now.select("block", "known", "base", "score", *(F.col(c).alias(f"{c}_{level}") for c in own)), "block")
        sent = sending(so_far.drop("known", "base", "score"), parts, partial(next_sent, setting=setting, level=level))
        so_far, level = so_far.drop(f"marks_{level}"), level + 1
        now = kept(placed(so_far, summed(sent, gain), setting, level), "lm-level")
        if now.where("n > 0").isEmpty():
            break
    texts = F.arrays_zip("doc_ids", "held_out", "sizes", "known", "base", "score")
    out = rows.join(now, "block").select(F.explode(texts).alias("t"))
    return out.select(F.col("t.doc_ids").alias("doc_id"), F.col("t.held_out"), F.col("t.sizes").cast("long").alias("n_tokens"),
                      F.col("t.known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                      F.col("t.base").alias("base_score"), F.col("t.score"))
