"""Near-duplicate passages across documents by compact windows.

Texts are sequences of shingles (runs of five words). For each of a few hash
functions every subsequence of at least ``least`` shingles has a minimum; all
subsequences that share their minimum at place c form one compact window
(l, c, r), given by the Cartesian tree over the hashes: l and r reach to the
next smaller values. Only the minima of runs of exactly ``least`` shingles can
be such places, which a sliding minimum finds without walking the whole tree.

A window's signature is its min-hash, so two similar sequences share it for
each hash function with a chance of their Jaccard similarity, wherever a word
was inserted, deleted or replaced. Documents with the same text are settled
first: all but the one with the smallest id are passages as a whole.

1. Equal signatures are linked to the earliest document that has them: first
   inside a task's block, then, one window per block and signature, across
   blocks, so a passage in a third of all documents costs one row per block.
   Links of a pair of documents by two hash functions or more are joined as
   intervals on nearly the same diagonal and verified on the documents'
   shingles: the stretch in which at least 8/9 of them agree in order (a
   Jaccard similarity of 0.8).
2. The earliest holder of a signature can hold a part of a passage only, while
   a later one holds the whole. In a run of ``least`` shingles that another
   document has, the min-hash of every function is linked. So runs with links
   of all functions of which nothing came, in both documents of a link, are
   looked up once more as a whole: documents that hold a passage word for word
   meet there, whatever others hold parts of it. These links are verified alike.

A passage with changed words is lost only where earlier holders of parts of it
leave no two functions to one earlier holder of the whole.

Defined results: null, empty and short texts have no passages; repeats inside
one document or between rows with one id are not reported; rows with a null
id take no part; ties go to the lowest place; an empty table gives no rows;
extra columns are left out by ``passages`` and kept by ``cut``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import GOLDEN, SHINGLE, WORD, WordHashes, mix, seeded, shingles, small, staged

HASHES = 7
BAND = 16
AGREE = 8 / 9

REACH = (1 << 16) - 1

# ``place`` is k << 60 | c << 32 | (c - l) << 16 | (r - c) of hash function k. Reaches beyond 2 * least (a passage that
# goes on has further windows there) and beyond REACH are cut: rows stay narrow, and so do the stretches to look at
WINDOWS = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("place", T.LongType()),
    T.StructField("ref", T.LongType()), T.StructField("ref_c", T.IntegerType()),
])
RUNS = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("at", T.IntegerType())])
PASSAGE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start_word", T.IntegerType()),
    T.StructField("end_word", T.IntegerType()), T.StructField("ref_doc_id", T.LongType()),
    T.StructField("ref_start_word", T.IntegerType()), T.StructField("n_agreeing", T.IntegerType()),
])


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values: of prefix and suffix minima inside blocks of that width."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    grid = padded.reshape(-1, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def cartesian(values: list[int], places: list[int], begin: list[int], end: list[int]) -> tuple[list[int], list[int]]:
    """Left and right reach of every place: up to the next smaller value, inside its text."""
    left, right, stack = list(begin), list(end), []
    for i, value in enumerate(values):
        if stack and begin[stack[-1]] != begin[i]:
            stack.clear()
        while stack and values[stack[-1]] > value:
            right[stack.pop()] = places[i] - 1
        if stack:
            left[i] = places[stack[-1]] + 1
        stack.append(i)
    return left, right


def compact_windows(tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int, least: int):
    """(places, left, right, text number) of the windows of texts laid end to end."""
    bits = max(1, int(len(tokens)).bit_length())
    keyed = mix(tokens ^ seeded(1000 + seed)) >> np.uint64(bits) << np.uint64(bits) | np.arange(len(tokens), dtype=np.uint64)
    lowest = sliding_minimum(keyed, least)
    text = np.repeat(np.arange(len(sizes)), sizes)
    inside = text[: len(lowest)] == text[least - 1 :]
    chosen = np.unique((lowest[inside] & np.uint64((1 << bits) - 1)).astype(np.int64))
    owner = text[chosen]
    begin, end = starts[owner], starts[owner] + sizes[owner] - 1
    left, right = cartesian(keyed[chosen].tolist(), chosen.tolist(), begin.tolist(), end.tolist())
    return chosen, np.array(left, np.int64), np.array(right, np.int64), owner


def windows(docs: DataFrame, least: int, block_words: int) -> DataFrame:
    """Rows of ``WINDOWS``: one per signature and block (``ref`` null), and links inside the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        ids, parts, filled = [], [], 0

        def flush():
            sizes = np.array([len(p) for p in parts], np.int64)
            starts, tokens, doc = np.cumsum(sizes) - sizes, np.concatenate(parts), np.array(ids, np.int64)
            if len(tokens) < least:
                return
            for k in range(HASHES):
                at, l, r, text = compact_windows(tokens, starts, sizes, k, least)
                if not len(at):
                    continue
                key = mix(tokens[at] * np.uint64(GOLDEN) ^ seeded(2000 + k)).view(np.int64)
                own = doc[text]
                order = np.lexsort((at, own, key))
                new = np.ones(len(order), bool)
                new[1:] = key[order[1:]] != key[order[:-1]]
                first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
                # windows of a new key, and links to its first document
                linked = ~new & (own[first] != own[order])
                o, f = np.concatenate([order[new], order[linked]]), np.concatenate([order[new], first[linked]])
                is_link = np.arange(len(o)) >= new.sum()
                c = at[o] - starts[text[o]]
                most = min(REACH, 2 * least)
                place = k << 60 | c << 32 | np.minimum(at[o] - l[o], most) << 16 | np.minimum(r[o] - at[o], most)
                # a link needs no partner any more, so its row may go anywhere
                spread = mix(key[o].view(np.uint64) + at[o].astype(np.uint64)).view(np.int64)
                whole = pa.RecordBatch.from_arrays([
                    pa.array(np.where(is_link, spread, key[o])), pa.array(own[o]), pa.array(place),
                    pa.array(own[f], pa.int64(), mask=~is_link), pa.array(at[f] - starts[text[f]], pa.int32(), mask=~is_link)],
                    names=WINDOWS.names)
                for i in range(0, len(o), 100_000):
                    yield whole.slice(i, 100_000)

        for batch in batches:
            for doc, text in zip(*(x.to_pylist() for x in batch.columns)):
                tokens = shingles(hashes.array(text))
                if len(tokens) < least:
                    continue
                if parts and filled + len(tokens) > block_words:
                    yield from flush()
                    ids, parts, filled = [], [], 0
                ids.append(doc)
                parts.append(tokens)
                filled += len(tokens)
        if parts:
            yield from flush()

    return docs.mapInArrow(run, WINDOWS)


def links(found: DataFrame) -> DataFrame:
    """Rows (doc, ref, anchors, hashes) of documents that share signatures of so many functions; anchors are (k, c, l, r, ref_c)."""
    c, left, right = (F.shiftright("place", 32).bitwiseAND(F.lit((1 << 28) - 1)), F.shiftright("place", 16).bitwiseAND(F.lit(REACH)),
                      F.col("place").bitwiseAND(F.lit(REACH)))
    group = Window.partitionBy("key").orderBy(F.col("ref").isNotNull(), "doc", "place")
    first = F.first(F.struct("doc", c.alias("c"))).over(group.rowsBetween(Window.unboundedPreceding, 0))
    met = found.withColumn("first", first).where("ref IS NOT NULL OR first.doc <> doc")
    anchor = F.struct(F.shiftright("place", 60).cast("int").alias("k"), c.cast("int").alias("c"), (c - left).cast("int").alias("l"), (c + right).cast("int").alias("r"),
                      F.coalesce("ref_c", F.col("first.c").cast("int")).alias("ref_c"))
    return met.select("doc", F.coalesce("ref", "first.doc").alias("ref"), anchor.alias("anchor")).groupBy("doc", "ref").agg(
        F.collect_set("anchor").alias("anchors")).withColumn("hashes", F.size(F.array_distinct("anchors.k")))


def agreement(own: np.ndarray, other: np.ndarray, shift: int, low: int, high: int) -> np.ndarray:
    """For places low..high of ``own``: whether the shingle stands near the same place, shifted, in ``other``."""
    place = np.arange(low, high + 1)
    mine = own[low : high + 1]
    straight = place - shift
    out = np.zeros(len(mine), bool)
    valid = (straight >= 0) & (straight < len(other))
    out[valid] = other[straight[valid]] == mine[valid]
    if out.all():
        return out
    from_, to = max(0, low - shift - BAND), max(0, high - shift + BAND + 1)
    near = other[from_:to]
    if not len(near):
        return out
    order = np.argsort(near, kind="stable")
    ranked = near[order]
    for side in ("left", "right"):  # the first and the last place of the shingle
        at = np.searchsorted(ranked, mine, side) - (side == "right")
        at = np.clip(at, 0, len(near) - 1)
        out |= (ranked[at] == mine) & (np.abs(order[at] + from_ - straight) <= BAND)
    return out


def longest(agree: np.ndarray, gain: np.ndarray) -> tuple[int, int]:
    """The longest stretch (first, end), ends agreeing, with enough agreement as a whole."""
    places = np.flatnonzero(agree)
    before, after = np.minimum.accumulate(gain[places]), gain[places + 1] + 1e-9
    start = places[np.minimum(np.searchsorted(-before, -after), len(places) - 1)]
    best = int(np.argmax(places - start))
    return int(start[best]), int(places[best]) + 1


def stretches(agree: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Disjoint stretches (first, last), ends agreeing, of at least ``least`` places with enough agreement."""
    out, todo = [], [(0, len(agree))]
    gain = np.concatenate([[0.0], np.cumsum(np.where(agree, 1 - AGREE, -AGREE))])
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        part = gain[a : b + 1]
        lowest = np.minimum.accumulate(part)
        last = int(np.argmax(part - lowest))
        if part[last] - lowest[last] <= 0:
            continue
        first = int(np.flatnonzero(part[: last + 1] == lowest[last])[-1])
        if last - first < least:  # a changed word in the middle costs more than a short half gains
            first, last = longest(agree[a:b], part)
            if last - first < least:
                continue
        out.append((a + first, a + last - 1))
        todo += [(a, a + first), (a + last, b)]
    return sorted(out)


def verify(own: np.ndarray, other: np.ndarray, anchors: list[tuple], least: int) -> list[tuple]:
    """(start, end, ref start, agreeing) in shingle places; anchors are (c, l, r, ref_c) of one pair."""
    out = []
    anchors = sorted(anchors, key=lambda a: (a[0] - a[3], a[0]))
    i = 0
    while i < len(anchors):
        j = i
        while j + 1 < len(anchors) and (anchors[j + 1][0] - anchors[j + 1][3]) - (anchors[j][0] - anchors[j][3]) <= BAND:
            j += 1
        group = anchors[i : j + 1]
        i = j + 1
        # interval join on this diagonal: windows that overlap are one stretch to look at
        merged: list[list] = []
        for low, high in sorted((a[1], a[2]) for a in group):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        shift = group[len(group) // 2][0] - group[len(group) // 2][3]
        for low, high in merged:
            low, high = max(0, low - least), min(len(own) - 1, high + least)
            agree = agreement(own, other, shift, low, high)
            if agree.sum() < AGREE * least:
                continue
            for a, b in stretches(agree, least):
                out.append((low + a, low + b, max(0, low + a - shift), int(agree[a : b + 1].sum())))
    return out


def settle_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (doc_id, n_words, first) of texts that a smaller id has too, the other documents' doc_id and text)."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    named = known.select("doc_id", "h", F.xxhash64(F.lit(1), "text").alias("g"))
    firsts = named.groupBy("h", "g").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    firsts = staged(firsts, "text-firsts")
    # words are counted in one text of each group
    ids = firsts.select(F.col("first").alias("doc_id"), "h")
    sizes = known.join(small(ids), ["doc_id", "h"], "left_semi").select(
        F.col("doc_id").alias("first"), "h", F.regexp_count("text", F.lit(WORD)).alias("n_words")).distinct()
    copies = staged(named.join(small(firsts), ["h", "g"]).where("doc_id <> first").join(sizes, ["first", "h"]).select(
        "doc_id", "h", "n_words", "first").distinct(), "text-copies")
    # an id can also stand at another text: only the copy's rows go
    rest = known.join(small(copies.select("doc_id", "h").distinct()), ["doc_id", "h"], "left_anti")
    return copies, rest.select("doc_id", "text")


def _shingled(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, tokens): 32 bits of each shingle, once a document."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("tokens", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            made = [(shingles(hashes.array(t)) >> np.uint64(32)).astype("<u4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _sliced(tokens: Column, low: Column, high: Column) -> Column:
    """Places low..high of packed shingles."""
    return F.substring(tokens, (low * 4 + 1).cast("int"), ((high - low + 1) * 4).cast("int"))


def _verified(pairs: DataFrame, tokens: DataFrame, least: int) -> DataFrame:
    """Rows of ``PASSAGE`` of the pairs (doc, ref, anchors) that hold on the shingles.

    Only the stretches around the anchors travel: of long documents with a
    link or two a fraction.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
        for batch in (large.slice(i, 256) for large in batches for i in range(0, large.num_rows, 256)):
            out = []
            for doc, ref, anchors, low, own, ref_low, other in zip(*(c.to_pylist() for c in batch.columns)):
                own, other = np.frombuffer(own, "<u4"), np.frombuffer(other, "<u4")
                spans = [(a["c"] - low, a["l"] - low, a["r"] - low, a["ref_c"] - ref_low) for a in anchors]
                for a, b, at, agreeing in verify(own, other, spans, least):
                    out.append((doc, low + a, low + b + SHINGLE, ref, ref_low + at, agreeing))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=PASSAGE.names)

    margin, zero = least + 2 * BAND, F.lit(0)
    ends = {
        "low": F.array_min("anchors.l"), "high": F.array_max("anchors.r"),
        "ref_low": F.array_min(F.transform("anchors", lambda a: a["ref_c"] - a["c"] + a["l"])),
        "ref_high": F.array_max(F.transform("anchors", lambda a: a["ref_c"] - a["c"] + a["r"])),
    }
    ends = {k: F.greatest(v - margin, zero) if k.endswith("low") else v + margin for k, v in ends.items()}
    own = tokens.select(F.col("doc_id").alias("doc"), "tokens")
    other = tokens.select(F.col("doc_id").alias("ref"), "tokens")
    both = pairs.withColumns(ends).join(own, "doc").withColumn("own", _sliced(F.col("tokens"), F.col("low"), F.col("high"))).drop("tokens")
    both = both.join(other, "ref").withColumn("other", _sliced(F.col("tokens"), F.col("ref_low"), F.col("ref_high")))
    return both.select("doc", "ref", "anchors", "low", "own", "ref_low", "other").mapInArrow(run, PASSAGE)


def run_hashes(tokens: np.ndarray, least: int) -> np.ndarray:
    """A 64-bit hash of each run of ``least`` shingles: differences of a running polynomial sum."""
    base = np.uint64(GOLDEN)
    inverse = np.uint64(pow(GOLDEN, -1, 1 << 64))
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(tokens), base, np.uint64)])
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(tokens), inverse, np.uint64)])
    sums = np.r_[np.uint64(0), np.cumsum(mix(tokens.astype(np.uint64)) * powers[:-1])]
    return mix((sums[least:] - sums[:-least]) * back[: len(sums) - least])


def open_runs(anchors: list[tuple[int, int]], settled: list[tuple[int, int]], length: int, least: int, functions: int = HASHES) -> np.ndarray:
    """Starts of runs that hold a place of every hash function and do not lie inside a settled stretch (first, end).

    ``anchors`` are (function, place) pairs.
    """
    last = length - least
    held = np.zeros(max(0, last + 1), np.int64)
    for k in range(functions):
        wanted = np.zeros(len(held) + 1, np.int64)
        for c in (c for f, c in anchors if f == k):
            low, high = max(0, c - least + 1), min(last, c)
            if low <= high:
                wanted[low] += 1
                wanted[high + 1] -= 1
        held += np.cumsum(wanted[:-1]) > 0
    chosen = held == functions
    for first, end in settled:
        chosen[max(0, first) : max(0, end - least + 1)] = False
    return np.flatnonzero(chosen)


def _tokens_of(docs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """``_shingled`` of the documents that pairs (doc, ref) name, written once."""
    needed = staged(pairs.select(F.col("doc").alias("doc_id")).union(pairs.select("ref")).distinct(), f"{name}-ids")
    return staged(_shingled(docs.join(small(needed), "doc_id", "left_semi").select("doc_id", "text")), name)


def second_passages(docs: DataFrame, pairs: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """Rows of ``PASSAGE`` where nothing came of shared signatures: documents that share a whole run."""
    settled = found.select(F.col("doc_id").alias("doc"), F.col("ref_doc_id").alias("ref")).distinct()
    failed = pairs.join(settled, ["doc", "ref"], "left_anti")
    places = pairs.select("doc", F.explode("anchors").alias("a")).select("doc", "a.k", "a.c").union(
        failed.select("ref", F.explode("anchors").alias("a")).select("ref", "a.k", "a.ref_c"))
    # a run needs a place of every function: most documents do not have them at all
    places = places.groupBy("doc").agg(F.collect_set(F.struct("k", "c")).alias("at")).where(
        F.size(F.array_distinct("at.k")) == HASHES)
    spans = found.groupBy(F.col("doc_id").alias("doc")).agg(F.collect_set(F.struct(
        F.col("start_word").alias("a"), (F.col("end_word") - SHINGLE + 1).alias("b"))).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (large.slice(i, 512) for large in batches for i in range(0, large.num_rows, 512)):
            for doc, at, spans, packed in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(packed, "<u4")
                starts = open_runs([(a["k"], a["c"]) for a in at], [(s["a"], s["b"]) for s in spans or ()], len(own), least)
                if len(starts):
                    # a run that a document repeats counts at its first place
                    keys, places = np.unique(run_hashes(own, least)[starts].view(np.int64), return_index=True)
                    starts = starts[places]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), doc)),
                                                      pa.array(starts.astype(np.int32))], names=RUNS.names)

    places = staged(places.join(spans, "doc", "left"), "passage-places")
    tokens = _shingled(docs.join(small(places.select(F.col("doc").alias("doc_id"))), "doc_id", "left_semi").select("doc_id", "text"))
    given = places.join(tokens.withColumnRenamed("doc_id", "doc"), "doc")
    runs = given.select("doc", "at", "spans", "tokens").mapInArrow(run, RUNS)
    group = Window.partitionBy("key").orderBy("doc", "at")
    first = F.first(F.struct("doc", "at")).over(group.rowsBetween(Window.unboundedPreceding, 0))
    met = runs.withColumn("first", first).where("first.doc <> doc")
    # runs one after the other are one link
    shift = F.col("at") - F.col("first.at")
    joined = met.groupBy("doc", F.col("first.doc").alias("ref"), shift.alias("shift")).agg(F.min("at").alias("low"), F.max("at").alias("high"))
    anchor = F.struct(F.col("low").alias("c"), F.col("low").alias("l"), (F.col("high") + least - 1).cast("int").alias("r"),
                      (F.col("low") - F.col("shift")).cast("int").alias("ref_c"))
    again = staged(joined.groupBy("doc", "ref").agg(F.collect_list(anchor).alias("anchors")), "passage-second")
    return _verified(again, _tokens_of(docs, again, "passage-second-tokens"), least)


def passages(docs: DataFrame, min_words: int = 50, block_words: int = 1_000_000) -> DataFrame:
    """Rows of ``PASSAGE``: passages of at least ``min_words`` words that an earlier document (by id) has too."""
    least = min_words - SHINGLE + 1
    copies, rest = settle_copies(docs)
    pairs = staged(links(windows(rest, least, block_words)), "passage-pairs")
    likely = pairs.where("hashes > 1").drop("hashes")
    tokens = _tokens_of(rest, likely, "passage-tokens")
    found = staged(_verified(likely, tokens, least), "passage-found")
    more = second_passages(rest, pairs.drop("hashes"), found, least)
    whole = copies.where(F.col("n_words") >= min_words).select(
        "doc_id", F.lit(0).alias("start_word"), F.col("n_words").alias("end_word"), F.col("first").alias("ref_doc_id"),
        F.lit(0).alias("ref_start_word"), (F.col("n_words") - SHINGLE + 1).cast("int").alias("n_agreeing"))
    return found.unionByName(more).unionByName(whole).distinct()


_WORDS = re.compile(WORD)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without words start..end (exclusive) of each span and the white space behind them."""
    words = [m.start() for m in _WORDS.finditer(text)] + [len(text)]
    out, at = [], 0
    for start, end in sorted(spans):
        begin, stop = words[min(start, len(words) - 1)], words[min(end, len(words) - 1)]
        if stop > at:
            out.append(text[at : max(at, begin)])
            at = stop
    out.append(text[at:])
    return "".join(out)


def cut(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the passages taken out of ``text``; ``n_chars``, where there is one, follows."""
    spans = staged(found.groupBy(F.col("doc_id").alias("__doc")).agg(
        F.collect_set(F.struct("start_word", "end_word")).alias("__spans")), "passage-spans")
    joined = docs.join(small(spans), F.col("doc_id").cast("long") == F.col("__doc"), "left").drop("__doc")
    at, counted = docs.columns.index("text"), "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:-1])
            spans = batch.column(batch.num_columns - 1).to_pylist()
            texts = [without(t, [(s["start_word"], s["end_word"]) for s in own]) if own and t else t
                     for t, own in zip(columns[at].to_pylist(), spans)]
            if counted:
                i = docs_columns.index("n_chars")
                old = columns[i].to_pylist()
                columns[i] = pa.array([len(t) if own and t is not None else n for t, own, n in zip(texts, spans, old)], columns[i].type)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    return joined.select(*docs.columns, "__spans").mapInArrow(run, docs.schema)
