"""Similarity join of word n-gram sets (Jaccard) by chosen paths.

Texts are sets of shingles (runs of five words). In every run each set picks
some of its shingles by a shared random function, with probability
1 / (threshold * size): similar sets tend to pick a common one. Sets that
picked the same shingle form a bucket. Small buckets are compared by brute
force; larger ones are split again by further shingles picked under the path
so far, and so on. Runs are repeated until the target recall: ``runs_for``
computes the chance that a pair at the threshold stays together for several
splits, and from it the number of runs that make missing it unlikely enough.
A bucket that is not split costs one pick, so few runs do for all sets; those
of a bucket that is split go on with as many as the depth of the split asks for.
A group of near copies picks mostly the same shingles, so by chance few runs can
leave all of it with one or two, which many of its pairs do not share: a set that
has picked fewer than ``LEAST`` goes on with runs of their own until it has.
Shingles that many texts share (a common line or passage) would gather
dissimilar sets in one bucket. ``frequent`` lists them from a sample, and a set
of which they are a small part picks among its other shingles only, with a chance
that is higher by as much as the frequent ones can hold of a link (``limits``):
similar sets pick a common one as likely as before, whatever the list holds.
Splitting parts the dissimilar sets of a large bucket that are left; in a dense
group of near copies every part is about as large as the whole. So a large
bucket is split only if its pairs stay together in so few parts on average,
which sketches tell, that this outweighs the further runs (the choice changes
the work; a pair in a bucket that is not split is never missed); else, up to
``LARGE`` times ``BUCKET``, and at the deepest level, it is dealt in parts, and
each two parts are a tile compared by matrix products: no pair is lost, and its
sets need no further runs.

Texts with equal sets are one class member with a number of copies, so copies
are never compared or expanded. A pair that meets in several buckets counts in
the smallest one only, which the two sets' lists of buckets tell. A bottom
sketch of each set rejects pairs that are far below the threshold; the rest are
verified on the whole sets, which are read again from the texts for these only. Links leave a task as sums per set
and as local components, never as pairs.

Defined results: texts without words (or null) have no links and are classes
of their own; texts of fewer than five words are one shingle; repeated rows
are copies; rows with a null id count like others (class ids ignore them unless
a class has no other id).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import GOLDEN, WordHashes, in_groups, mix, seeded, shingles, small, staged
from .components import components

SKETCH = 32
BUCKET = 512
LARGE = 4  # buckets up to so many times ``BUCKET`` are dealt in parts without a look at their density
DEPTH = 6
LEAST, FURTHER = 5, 24  # picks of a set at least, and at most so many further runs for them
SKETCH_SLACK = 0.45
# frequent shingles: of about so many texts, those in so many of them, at most so many; read of each text at most
SAMPLE, SEEN, FREQUENT, OF_TEXT = 5_000, 8, 100_000, 4_096


def runs_for(recall: float, depth: int = DEPTH) -> int:
    """Runs until any pair at the threshold, split ``depth`` times, is missed with at most 1 - recall.

    The common paths of two sets branch like a Poisson process whose mean is
    their shared part over the threshold times the larger size: at the
    threshold 1 if one set holds the other, more if the sizes are closer.
    """
    meets = 1.0
    for _ in range(depth):
        meets = 1 - math.exp(-meets)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meets)))


def runs_of(recall: float) -> list[int]:
    """Runs for sets whose buckets end at depth 1, 2, ..., ``DEPTH``; the first for every set; each may miss half of 1 - recall."""
    runs = [runs_for((1 + recall) / 2, depth) for depth in range(1, DEPTH + 1)]
    return np.maximum.accumulate(runs).tolist()


def token_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    return np.unique(shingles(hashes.array(text)))


def signature(tokens: np.ndarray) -> bytes | None:
    """128 bits that stand for the set."""
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def frequent(docs: DataFrame) -> np.ndarray:
    """Shingles (ascending) that many texts share, by a sample of bounded size. The list decides on the work, not on the links."""
    schema = T.StructType([T.StructField("token", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known, made, held = WordHashes(), set(), [], 0

        def counted():
            values, n = np.unique(np.concatenate(made), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=schema.names)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = token_set(text, hashes)
                if (sig := signature(tokens)) is None or sig in known:  # copies count once in a task
                    continue
                known.add(sig)
                made.append(tokens[:OF_TEXT])
                held += len(made[-1])
                if held > 1_000_000:
                    yield counted()
                    made, held = [], 0
        if made:
            yield counted()

    every = math.ceil(docs.count() / SAMPLE) or 1
    least = max(SEEN, BUCKET // (4 * every))
    sample = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).mapInArrow(run, schema)
    seen = sample.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    found = seen.orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").collect()
    return np.sort(np.array([r.token for r in found], np.int64).view(np.uint64))


def limits(tokens: np.ndarray, threshold: float, hot: np.ndarray | None = None) -> np.ndarray | np.uint64:
    """Up to which draw a set picks each of its shingles, ``hot`` being the frequent ones.

    A set x with h of them, at most ``most`` of its size, picks the others with
    probability 1 / (threshold * size - h). Two linked sets, both like this,
    share threshold * size of the larger at least, at most h of these frequent:
    so the mean number of common picks stays 1 or more, as with 1 /
    (threshold * size) for all shingles, by which the rest go. If y has more
    than ``most``, each x linked to it has more than ``some`` (the least share
    when the two differ in shingles of x only, or in frequent ones of y only);
    such sets pick frequent ones too, so the pair meets as without a list.
    """
    def limit(chance):
        return np.uint64(min(int(chance * 2.0**64), 2**64 - 1))

    size = len(tokens)
    plain = limit(min(1.0, 1 / (threshold * size)))
    if hot is None or not len(hot):
        return plain
    is_hot = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens
    n = int(is_hot.sum())
    most = 0.875 * threshold
    some = min(threshold * most, (most - 1 + threshold) / threshold) - 1e-9
    if n == 0 or n > most * size:
        return plain
    rest = limit(min(1.0, 1 / (threshold * size - n)))
    return np.where(is_hot, plain if n > some * size else np.uint64(0), rest)


def picked(tokens: np.ndarray, path: np.uint64, threshold: float, limit: np.ndarray | np.uint64 | None = None) -> np.ndarray:
    """Child paths that a set takes below ``path``: one for each token it picks there (``limit``: from ``limits``)."""
    draws = mix(tokens ^ path)
    own = draws[draws <= (limits(tokens, threshold) if limit is None else limit)]
    return mix(own * np.uint64(GOLDEN) + path)


def first_paths(tokens: np.ndarray, runs: int, threshold: float, limit: np.ndarray | np.uint64) -> np.ndarray:
    """Paths that a set takes in so many runs, and in further ones (seeds that no split uses) while it has fewer than ``LEAST``."""
    paths = [picked(tokens, seeded(r), threshold, limit) for r in range(runs)]
    for r in range(FURTHER):
        if sum(map(len, paths)) >= LEAST:
            break
        paths.append(picked(tokens, seeded(1_000 + r), threshold, limit))
    return np.concatenate(paths)


def describe(docs: DataFrame, runs: int, threshold: float, hot: np.ndarray | None = None) -> DataFrame:
    """(doc_id, sig, size, sketch, paths) of every document; ``hot`` are frequent shingles."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("sig", T.BinaryType()), T.StructField("size", T.IntegerType()),
        T.StructField("sketch", T.BinaryType()), T.StructField("paths", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
        for batch in batches:
            out = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = token_set(text, hashes)
                if len(tokens):
                    sketch = (tokens[:SKETCH] >> np.uint64(16)).tobytes()
                    paths = first_paths(tokens, runs, threshold, limits(tokens, threshold, hot)).view(np.int64)
                    out.append((doc, signature(tokens), len(tokens), sketch, paths))
                else:
                    out.append((doc, None, 0, b"", np.zeros(0, np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=schema.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sig, tokens) of the ``wanted`` (rep, sig), read from the representatives' texts."""
    schema = T.StructType([T.StructField("sig", T.BinaryType()), T.StructField("tokens", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            made = [token_set(t, hashes) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([signature(t) for t in made], pa.binary()),
                                              pa.array([t.tobytes() for t in made], pa.binary())], names=schema.names)

    reps = small(staged(wanted.select("rep").distinct(), "join-reps"))
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = texts.join(reps, texts["doc_id"].eqNullSafe(reps["rep"]), "left_semi").select("text").mapInArrow(run, schema)
    return found.where("sig IS NOT NULL").dropDuplicates(["sig"])


def buckets(docs: DataFrame, reps: DataFrame, threshold: float, runs: list[int], hot: np.ndarray | None = None) -> DataFrame:
    """(tile, path, part, sig): buckets in tiles of bounded size; a pair of a bucket is together in exactly one tile.

    A bucket of 2 to ``BUCKET`` sets is one tile. One above ``LARGE`` times
    that is split as long as that pays; else it is dealt in parts: one tile for
    each part and for each two of them. ``runs`` are those that ``runs_of`` gives for every depth:
    a set of a bucket split at depth d gets as many as d + 1 asks for. Sets that
    meet in a split bucket get all of these together.
    """
    child = T.StructType([T.StructField("sig", T.BinaryType()), T.StructField("path", T.LongType())])
    whole, dealt, sets = [], [], None

    def paths_below(starts):
        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sigs, paths = [], []
                for sig, path, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                    own = np.frombuffer(tokens, np.uint64)
                    limit = limits(own, threshold, hot)
                    for start in starts(path):
                        below = picked(own, start, threshold, limit)
                        sigs.extend([sig] * len(below))
                        paths.append(below.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.binary()),
                                                  pa.array(np.concatenate(paths) if paths else [], pa.int64())], names=child.names)

        return split

    def met(level: DataFrame) -> DataFrame:
        """Rows (path, sig, n) of the larger buckets; the others are tiles."""
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = staged(level.join(sizes, "path").select("path", "sig", "n"), "join-level")
        whole.append(rows.where(F.col("n") <= BUCKET))
        return rows.where(F.col("n") > BUCKET)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shared part of the sketches of neighbours in a batch, summed for each bucket."""
        for batch in batches:
            order = np.argsort(batch.column(0).to_numpy(), kind="stable")
            paths, sketches = batch.column(0).to_numpy()[order], batch.column(1).take(pa.array(order)).to_pylist()
            sums: dict[int, list] = {}
            for i in np.flatnonzero(paths[1:] == paths[:-1]):
                one, other = (set(np.frombuffer(x, np.uint64).tolist()) for x in sketches[i : i + 2])
                into = sums.setdefault(int(paths[i]), [0.0, 0])
                into[0] += len(one & other) / max(len(one), len(other))
                into[1] += 1
            yield pa.RecordBatch.from_pydict({"path": pa.array(list(sums), pa.int64()),
                                              "both": pa.array([x for x, _ in sums.values()], pa.float64()),
                                              "n": pa.array([n for _, n in sums.values()], pa.int64())})

    shared = T.StructType([T.StructField("path", T.LongType()), T.StructField("both", T.DoubleType()), T.StructField("n", T.LongType())])

    def split(large: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
        """(sig, path) below the buckets where splitting pays, and the sets of these; the others are dealt in parts."""
        pays = runs[depth - 1] / runs[depth]  # fewer parts in which a pair meets, but more runs in which it does
        sums = large.join(reps.select("sig", "sketch"), "sig").select("path", "sketch").mapInArrow(alike, shared)
        # the share that two sets have in common, over the threshold: parts in which a pair stays together
        sizes = large.groupBy("path").agg(F.first("n").alias("n"))
        mean = sums.groupBy("path").agg((F.sum("both") / F.sum("n")).alias("both"))
        unsplit = sizes.join(mean, "path", "left").where((F.col("n") <= LARGE * BUCKET) | (F.col("both") >= pays * threshold))
        dense = small(staged(unsplit.select("path"), "join-dense"))
        dealt.append(large.join(dense, "path", "left_semi"))
        go_on = staged(large.join(dense, "path", "left_anti").select("sig", "path"), "join-split")
        rows = go_on.join(sets, "sig").select("sig", "path", "tokens")
        return rows.mapInArrow(paths_below(lambda path: [np.int64(path).view(np.uint64)]), child), go_on.select("sig").distinct()

    level, of_depth, done = reps.select("sig", F.explode("paths").alias("path")), {}, runs[0]
    for stage in range(1, DEPTH + 1):
        # runs for every set, then, for sets of buckets split so deep, as many more as that depth asks for
        if stage > 1:
            again = of_depth.get(stage - 1)
            if again is None:
                break
            roots = [seeded(r) for r in range(done, runs[stage - 1])]
            done = max(done, runs[stage - 1])
            if not roots:
                continue
            more = sets.join(reduce(DataFrame.unionByName, again).distinct(), "sig", "left_semi")
            level = more.select("sig", F.lit(0).cast("long").alias("path"), "tokens").mapInArrow(paths_below(lambda _, r=roots: r), child)
        for depth in range(1, DEPTH + 1):
            large = met(level)
            if large.isEmpty():
                break
            if depth == DEPTH:
                dealt.append(large)
                break
            if sets is None:
                sets = staged(sets_of(docs, large.select("sig").distinct().join(reps.select("sig", "rep"), "sig")), "join-sets")
            level, own = split(large, depth)
            if own.isEmpty():
                break
            for d in range(1, depth + 1):
                of_depth.setdefault(d, []).append(own)

    out = reduce(DataFrame.unionByName, whole).select(F.col("path").alias("tile"), "path", F.lit(0).alias("part"), "sig")
    if not dealt:
        return out
    parts = F.ceil(F.col("n") / (BUCKET // 2)).cast("int")
    own = F.pmod(F.xxhash64("sig", "path"), parts).cast("int")
    tiled = reduce(DataFrame.unionByName, dealt).withColumns({"parts": parts, "part": own})
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = F.xxhash64("path", F.least("part", "other"), F.greatest("part", "other"))
    return out.unionByName(tiled.select(tile.alias("tile"), "path", "part", "sig"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all intersections, by products of membership matrices of some columns at a time."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    total = np.zeros((n, n), np.float32)
    for a in range(0, len(values), 4096):
        i, j = np.searchsorted(place, [a, a + 4096])
        member = np.zeros((n, 4096), np.float32)
        member[owner[i:j], place[i:j] - a] = 1
        total += member @ member.T
    return total.astype(np.int64)


def _own(rows: list[dict], close: np.ndarray) -> np.ndarray:
    """Of the close pairs (i < j) of a tile, those that count here.

    In a tile of two parts these are pairs across them; and pairs for which
    this bucket is the smallest they share.
    """
    part = np.array([r["part"] for r in rows])
    close = np.triu(close, 1)
    if part.min() != part.max():
        close &= np.not_equal.outer(part, part)
    if not close.any():
        return close
    path = rows[0]["path"]
    smaller = [np.array([p for p in r["all_paths"] if p < path], np.int64) for r in rows]
    return close & (overlaps(smaller) == 0)


def _size_fits(sizes: np.ndarray, threshold: float) -> np.ndarray:
    return np.minimum.outer(sizes, sizes) >= threshold * np.maximum.outer(sizes, sizes)


def candidates(members: DataFrame, threshold: float) -> DataFrame:
    """(tile, path, part, sig): members of a tile that may have a partner there, judged by sketches."""
    schema = T.StructType([T.StructField("tile", T.LongType()), T.StructField("path", T.LongType()),
                           T.StructField("part", T.IntegerType()), T.StructField("sig", T.BinaryType())])

    def compare(rows: list[dict]) -> Iterator[tuple]:
        if len(rows) < 2:
            return
        sketches = [np.frombuffer(r["sketch"], np.uint64) for r in rows]
        sizes = np.array([r["size"] for r in rows])
        least = np.minimum(SKETCH, np.minimum.outer(sizes, sizes)) * SKETCH_SLACK
        close = (overlaps(sketches) >= least) & _size_fits(sizes, threshold)
        near = _own(rows, close)
        for i in np.flatnonzero(near.any(0) | near.any(1)):
            yield tuple(rows[i][c] for c in schema.names)

    return in_groups(members, "tile", compare, schema)


def verified(members: DataFrame, threshold: float) -> DataFrame:
    """(sig, links, root): for each member of a tile the copies it is linked to, and its local component."""
    schema = T.StructType([T.StructField("sig", T.BinaryType()), T.StructField("links", T.LongType()),
                           T.StructField("root", T.BinaryType())])

    def compare(rows: list[dict]) -> Iterator[tuple]:
        if len(rows) < 2:
            return
        sets = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
        both, sizes = overlaps(sets), np.array([len(s) for s in sets])
        union = np.add.outer(sizes, sizes) - both
        linked = _own(rows, both >= threshold * union)
        linked |= linked.T
        copies = np.array([r["copies"] for r in rows], np.int64)
        root = list(range(len(rows)))
        for i in range(len(rows)):  # the smallest member reached
            todo = [i] if root[i] == i else []
            while todo:
                for j in np.flatnonzero(linked[todo.pop()]):
                    if j > i and root[j] == j:
                        root[j] = i
                        todo.append(j)
        for i in np.flatnonzero(linked.any(0)):
            yield rows[i]["sig"], int(copies[linked[i]].sum()), rows[root[i]]["sig"]

    return in_groups(members, "tile", compare, schema)


def join(docs: DataFrame, threshold: float = 0.8, recall: float = 0.99) -> DataFrame:
    """Rows (doc_id, class_id, n_links, sig, root), one per document.

    ``class_id`` is the smallest id of the documents connected by links;
    ``n_links`` the number of other documents with a Jaccard similarity of at
    least ``threshold``; ``root`` tells classes apart where ids repeat.
    """
    runs = runs_of(recall)
    hot = frequent(docs)
    described = staged(describe(docs, runs[0], threshold, hot), "join-sets")
    reps = staged(described.where("sig IS NOT NULL").groupBy("sig").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"),
        F.first("sketch").alias("sketch"), F.first("paths").alias("paths")), "join-classes")
    dealt = staged(buckets(docs, reps, threshold, runs, hot).distinct(), "join-buckets")
    known = dealt.groupBy("sig").agg(F.collect_set("path").alias("all_paths"))  # of buckets, not of their tiles
    traits = reps.select("sig", "size", "sketch").join(known, "sig")
    near = staged(candidates(dealt.join(traits, "sig"), threshold), "join-candidates")
    sets = sets_of(docs, near.select("sig").distinct().join(reps.select("sig", "rep"), "sig"))
    whole = reps.select("sig", "copies").join(known, "sig").join(sets, "sig")
    links = staged(verified(near.join(whole, "sig"), threshold), "join-links")
    degree = links.groupBy("sig").agg(F.sum("links").alias("links"))
    root = components(links.select("sig", "root")).withColumnRenamed("node", "sig")
    of_set = (reps.select("sig", "rep", "copies").join(degree, "sig", "left").join(root, "sig", "left")
              .withColumn("root", F.coalesce("root", "sig")))
    first = of_set.groupBy("root").agg(F.min("rep").alias("class_id"))
    of_set = of_set.join(first, "root").select("sig", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return described.select("doc_id", "sig").join(of_set, "sig", "left").select(
        "doc_id", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "sig", "root")
