"""Benchmark decontamination by pigeonhole edit matching.

A test item may differ from its copy in a text by ``k`` edits (``error_rate``
of its length). It is cut into k + 1 pieces; k edits cannot touch them all, so
every match holds one piece unchanged. Exact piece hits come from one
Aho-Corasick pass over the text; each hit fixes where the item would have to
lie, and the stretch around it is verified with Myers' bit-parallel distance.

Texts and items are compared in lower case with runs of white space as one
space; places are counted in that form. Items are the stated query set: they
are taken in blocks of at most ``block_chars`` characters, each block sent to
all tasks and matched against every whole text; nothing is shuffled.

Defined results: null or empty texts match nothing, items that are empty after
normalising match nothing; of several matches of an item in a text the one
with the least distance, then the first, is reported; repeated items and
repeated documents are reported row by row; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MATCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()),
    T.StructField("distance", T.IntegerType()), T.StructField("match_start", T.LongType()),
    T.StructField("match_end", T.LongType()),
])


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(start, piece): ``k`` + 1 pieces of nearly equal length (fewer if the item is shorter)."""
    n = min(k + 1, len(item))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(peq: dict[str, int], m: int, text: str, k: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of a pattern inside ``text`` with at most ``k`` edits."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        if score <= k and (best is None or score < best[0]):
            best = (score, j)
        ph, mh = ph << 1 & full, mh << 1 & full  # a match may begin anywhere in the text
        pv, mv = mh | ~(xv | ph) & full, ph & xv
    return best


class Matcher:
    """A block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        self.items, found = [], {}
        for item_id, raw in items:
            text = normal(raw)
            if not text:
                continue
            k, number = int(len(text) * error_rate), len(self.items)
            self.items.append((item_id, len(text), k, masks(text), masks(text[::-1])))
            for start, piece in pieces(text, k):
                found.setdefault(piece, []).append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def search(self, raw: str | None) -> list[tuple]:
        """(item id, distance, start, end) of every item's best match."""
        text = normal(raw)
        if not text or not self.items:
            return []
        hits: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for number, start in places:
                hits.setdefault(number, []).append(end + 1 - size - start)
        out = []
        for number, starts in hits.items():
            item_id, m, k, peq, reverse = self.items[number]
            starts.sort()
            best, i = None, 0
            while i < len(starts):
                j = i  # hits that would put the item at nearly the same place are verified together
                while j + 1 < len(starts) and starts[j + 1] - starts[j] <= 2 * k + 1 and starts[j + 1] - starts[i] <= m:
                    j += 1
                low, high = max(0, starts[i] - k), starts[j] + m + k
                got = myers(peq, m, text[low:high], k)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], low + got[1])
                i = j + 1
            if best:
                # the same search backwards from the end gives the start
                tail = text[max(0, best[1] - m - k) : best[1]][::-1]
                back = myers(reverse, m, tail, best[0])
                out.append((item_id, best[0], best[1] - (back[1] if back else m), best[1]))
        return out


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items, collected block by block; a block is bounded by ``block_chars`` or one longer item."""
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // block_chars))
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    for i in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r["item_id"], r["text"]) for r in block.collect()]


def matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.06, block_chars: int = 8_000_000) -> DataFrame:
    """Rows (doc_id, item_id, distance, match_start, match_end) of every document and item that match."""
    out = None
    for block in item_blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, error_rate)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            for batch in batches:
                rows = [(doc, *m) for doc, text in zip(*(c.to_pylist() for c in batch.columns)) for m in matcher.search(text)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=MATCH.names)

        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MATCH)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.06, block_chars: int = 8_000_000) -> DataFrame:
    """The documents in which no item matches, all columns kept: a filter, in one pass per block."""
    for block in item_blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        at = docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch], shared=shared, at=at) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, error_rate)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.search(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
