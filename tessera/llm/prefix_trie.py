r"""Conversation prefix trie: z-fast tries of the tasks, merged by prefix digests.

A conversation is its sequence of turns (role, text); the node of a prefix is
known by a 128-bit digest chained over its turns. Every task keeps a z-fast
trie of the conversations it reads:

* a compacted node (where conversations part or end) stands in a hash table
  under the digest at its handle, the two-fattest depth of its edge: the depth
  above its parent's, up to its own, that is divisible by the highest power of
  two;
* a conversation's exit node is found by fat binary search: a look-up at the
  two-fattest depth of the range that is left either moves the lower bound to
  the node found or the upper bound below that depth, so a conversation of
  length L needs log L look-ups;
* conversations come in batches, copies within a batch are inserted once; a
  new conversation splits at most one edge and adds at most one leaf;
* at the end sums are pushed up the compacted nodes, and every edge is expanded
  to its depths: one row a node, however many conversations share it.

Tasks' rows meet by digest with partial sums (a third of all conversations
below one node is one row a task). Subtree figures need no second structure:
the smallest conversation of a node, its ``first``, is the first of a whole
suffix of its own path, so ``exit_words``, the words of the prefix that it
shares with smaller conversations, says how far it repeats them. A second pass through
tries sums ``exit_words`` and the childless nodes owned over the members of
every node; of the words saved below a node, a member other than the first
saves its ``exit_words`` less the words above the node.

A conversation's turns pass one task as a sorted stream of narrow rows (turn,
digest, number of words; texts stay behind) and are cut into segments of
``SEGMENT`` turns, each a string of the trie that hangs at its start; a task
holds a segment and ``BLOCK`` turns of trie at most. Ids that end at a node
are joined to lists of at most 65,536 before they meet and are hashed as a
stream.

Defined results: null role or text counts as empty; turns are taken by turn
number (null first), ties by the digest of role and text, so repeated rows all
stay; rows without a conversation id belong to no conversation and are left
out; an empty table has no nodes, not even the root; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

SEGMENT = 4096
BLOCK = 200_000
WIDTH = 16
ROOT = bytes(WIDTH)
SHARED, HEADS = 20, 4

PATHS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("start_key", T.BinaryType()), T.StructField("start_words", T.LongType()),
    T.StructField("keys", T.BinaryType()), T.StructField("words", T.BinaryType()),
    T.StructField("end_key", T.BinaryType()), T.StructField("end_words", T.LongType()),
])
NODES = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("parent", T.BinaryType()),
    T.StructField("depth", T.LongType()), T.StructField("words", T.LongType()), T.StructField("above", T.LongType()),
    T.StructField("first", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
])
_KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, _KINDS[f.dataType.typeName()]) for f in schema])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# ------------------------------------------------------------------ sequences

def heads(conv_id: int) -> int:
    """How many turns a conversation takes over from the first of its block."""
    return zlib.crc32(str(conv_id).encode()) % HEADS


def paths(conversations: DataFrame, shared: int = 1, segment: int = SEGMENT) -> DataFrame:
    """Rows of ``PATHS``: conversations of (conv_id, turn, role, text) as digests of their prefixes, in segments.

    With ``shared`` above 1, conversations of the same block of ids (the
    multiples of ``shared`` begin one) are rebuilt: the first ``heads`` turns
    are those of the block's first id (as many as it has), the rest their own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    conv = F.col("conv_id").cast("long")
    turns = conversations.where("conv_id IS NOT NULL").select(
        (conv - F.pmod(conv, F.lit(shared))).alias("block"), conv.alias("conv_id"), "turn",
        F.unhex(F.md5(named)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    ordered = turns.repartition("block").sortWithinPartitions("block", "conv_id", F.asc_nulls_first("turn"), "digest")
    schema = _arrow(PATHS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, lent, lent_block, own, skip = [], None, [], None, None, 0
        for batch in batches:
            for conv_id, digest, words in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != now:
                    if own:
                        out.append(own.close())
                    now, own = conv_id, _Walk(conv_id, segment)
                    if conv_id % shared == 0:
                        lent, lent_block, skip = [], conv_id, 0
                    else:
                        skip = heads(conv_id)
                        for turn in lent[:skip] if lent_block == conv_id - conv_id % shared else ():
                            own.add(*turn, out)
                if conv_id == lent_block and len(lent) < HEADS:
                    lent.append((digest, words))
                if skip:
                    skip -= 1
                else:
                    own.add(digest, words, out)
                if len(out) >= 2000:
                    yield _batch(out, schema)
                    out = []
        if own:
            out.append(own.close())
        if out:
            yield _batch(out, schema)

    return ordered.select("conv_id", "digest", "words").mapInArrow(run, PATHS)


class _Walk:
    """The path of one conversation, turn by turn; full segments go to ``out``."""

    def __init__(self, conv_id: int, segment: int):
        self.conv_id, self.segment, self.key, self.depth, self.total = conv_id, segment, ROOT, 0, 0
        self._begin()

    def _begin(self):
        self.start, self.keys, self.words = (self.depth, self.key, self.total), [], []

    def add(self, digest: bytes, words: int, out: list) -> None:
        if len(self.keys) == self.segment:
            out.append(self._row(None, None))
            self._begin()
        self.key = xxhash.xxh3_128_digest(self.key + digest)
        self.depth += 1
        self.total += words
        self.keys.append(self.key)
        self.words.append(words)

    def close(self) -> tuple:
        return self._row(self.key, self.total)

    def _row(self, end_key, end_words) -> tuple:
        return (self.conv_id, *self.start, b"".join(self.keys), np.array(self.words, "<i8").tobytes(), end_key, end_words)


# ------------------------------------------------------------------ the trie of a task

def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the highest power of two."""
    return high & -(1 << (low ^ high).bit_length() - 1)


class Node:
    __slots__ = ("depth", "path", "seen", "parent", "children", "first", "a", "b")

    def __init__(self, depth: int, path: list[bytes], seen: list[int]):
        # ``path`` and ``seen`` (words up to each depth, from 0) are those of any sequence through the node
        self.depth, self.path, self.seen, self.parent = depth, path, seen, None
        self.children: dict[bytes, Node] = {}
        self.first, self.a, self.b = None, 0, 0

    def take(self, first: int, a: int, b: int) -> None:
        self.first = first if self.first is None else min(self.first, first)
        self.a += a
        self.b += b


class ZFastTrie:
    """Compacted trie of digest sequences (a sequence holds the digest of each of its prefixes)."""

    def __init__(self):
        self.root = Node(0, [], [0])
        self.handles: dict[bytes, Node] = {}
        self.nodes = [self.root]

    def locate(self, path: list[bytes]) -> tuple[Node, int]:
        """(exit node, length of the common prefix of ``path`` and its extent), by fat binary search."""
        low, high, at = 0, len(path), self.root
        while low < high:
            f = two_fattest(low, high)
            found = self.handles.get(path[f - 1])
            if found is None:
                high = f - 1
            elif found.depth <= len(path) and path[found.depth - 1] == found.path[found.depth - 1]:
                low, at = found.depth, found
            else:
                return found, self._common(path, found, f)
        if at.depth < len(path) and (below := at.children.get(path[at.depth])):
            return below, self._common(path, below, at.depth + 1)
        return at, at.depth

    @staticmethod
    def _common(path: list[bytes], node: Node, known: int) -> int:
        """Length of the common prefix, ``known`` at least, by binary search over prefix digests."""
        low, high = known, min(len(path), node.depth)
        while low < high:
            middle = (low + high + 1) // 2
            if path[middle - 1] == node.path[middle - 1]:
                low = middle
            else:
                high = middle - 1
        return low

    def _hang(self, node: Node, parent: Node) -> None:
        """Put ``node`` below ``parent`` and under its handle."""
        node.parent = parent
        parent.children[node.path[parent.depth]] = node
        self.handles[node.path[two_fattest(parent.depth, node.depth) - 1]] = node

    def insert(self, path: list[bytes], words: list[int]) -> tuple[Node, int]:
        """(node where ``path`` ends, number of turns that the trie now holds more)."""
        at, common = self.locate(path)
        if common < at.depth:
            upper = at.parent
            del self.handles[at.path[two_fattest(upper.depth, at.depth) - 1]]
            fork = Node(common, at.path, at.seen)
            self.nodes.append(fork)
            self._hang(fork, upper)
            self._hang(at, fork)
            at = fork
        if common == len(path):
            return at, 0
        leaf = Node(len(path), path, [0, *accumulate(words)])
        self.nodes.append(leaf)
        self._hang(leaf, at)
        return leaf, len(path)

    def expand(self, start: int, start_key: bytes, start_words: int) -> Iterator[tuple]:
        """Rows of ``NODES``, one a depth of every edge; sums are pushed up first."""
        for node in sorted(self.nodes[1:], key=lambda n: -n.depth):
            node.parent.take(node.first, node.a, node.b)
        if start == 0:
            yield ROOT, None, 0, 0, 0, self.root.first, self.root.a, self.root.b
        for node in self.nodes[1:]:
            path, seen = node.path, node.seen
            for d in range(node.parent.depth, node.depth):
                yield (path[d], path[d - 1] if d else start_key, start + d + 1, seen[d + 1] - seen[d],
                       start_words + seen[d], node.first, node.a, node.b)


def in_tries(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of ``NODES`` from segments with values: the tasks' tries, expanded.

    ``rows`` has the columns of ``PATHS`` and the values ``a`` and ``b``;
    ``first`` is the smallest conversation through a node, ``a`` and ``b`` are
    sums over all of them. A node comes once for each trie that has it.
    """
    schema = _arrow(NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[bytes, tuple[ZFastTrie, int, int]] = {}
        held = 0

        def flush():
            out = []
            for start_key, (trie, start, start_words) in tries.items():
                for row in trie.expand(start, start_key, start_words):
                    out.append(row)
                    if len(out) == 10_000:
                        yield _batch(out, schema)
                        out = []
            if out:
                yield _batch(out, schema)
            tries.clear()

        for batch in batches:
            together: dict[tuple[bytes, bytes], list] = {}  # copies within the batch are one insertion
            for conv_id, start, start_key, start_words, keys, words, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                same = together.setdefault((start_key, keys[-WIDTH:]), [conv_id, 0, 0, start, start_words, keys, words])
                same[0] = min(same[0], conv_id)
                same[1] += a
                same[2] += b
            for (start_key, _), (first, a, b, start, start_words, keys, words) in together.items():
                if start_key not in tries:
                    tries[start_key] = (ZFastTrie(), start, start_words)
                path = [keys[i : i + WIDTH] for i in range(0, len(keys), WIDTH)]
                end, more = tries[start_key][0].insert(path, np.frombuffer(words, "<i8").tolist())
                end.take(first, a, b)
                held += more
                if held > block:
                    yield from flush()
                    held = 0
        yield from flush()

    return rows.select("conv_id", "start", "start_key", "start_words", "keys", "words",
                       F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(run, NODES)


# ------------------------------------------------------------------ the whole trie

def ends(walked: DataFrame) -> DataFrame:
    """Rows (key, ends_sha256): digest of the ids that end at a node, ascending, comma-joined."""
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    lists = walked.where("end_key IS NOT NULL").groupBy(
        F.col("end_key").alias("key"), F.shiftright("conv_id", 16).alias("range")).agg(ids)
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key == now:
                    state.update(b"," + text.encode())
                    continue
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256(text.encode())
            if out:
                yield _batch(out, _arrow(schema))
                out = []
        if now is not None:
            yield _batch([(now, state.hexdigest())], _arrow(schema))

    ordered = lists.repartition("key").sortWithinPartitions("key", "range")
    return ordered.select("key", "ids").mapInArrow(run, schema)


def trie(conversations: DataFrame, shared: int = 1, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """One row a node of the trie of all conversations.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves (childless nodes of the subtree),
    saved_tokens (over the subtree, the words of a node's last turn for every
    member but one), ends_sha256, and the node's digests ``key`` and ``parent``.
    """
    walked = staged(paths(conversations, shared, segment), "trie-paths")
    ident = ["key", "parent", "depth", "words", "above"]

    members = in_tries(walked.withColumns({"a": F.lit(1), "b": F.lit(0)}), block)
    nodes = staged(members.groupBy(*ident).agg(F.min("first").alias("first"), F.sum("a").alias("n_convs")), "trie-nodes")

    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # the nodes of one first are the end of its own path: their top is where it leaves smaller conversations
    own = F.min("above").over(Window.partitionBy("first"))
    owned = staged(counted.withColumn("exit_words", own), "trie-owned")

    exits = owned.groupBy(F.col("first").alias("conv_id")).agg(
        F.min("exit_words").alias("exit_words"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    values = walked.where("end_key IS NOT NULL").select("conv_id", F.col("end_words").alias("total")).join(
        exits, "conv_id", "left").select("conv_id", F.coalesce("exit_words", "total").alias("a"), F.coalesce("leaf", F.lit(0)).alias("b"))
    below = in_tries(walked.join(values, "conv_id"), block).groupBy("key").agg(
        F.sum("a").alias("shared_words"), F.sum("b").alias("n_leaves"))

    full = owned.join(below, "key").join(ends(walked), "key", "left")
    parents = nodes.select(F.col("key").alias("parent"), F.col("first").alias("parent_conv_id"))
    saved = F.col("shared_words") - F.col("exit_words") - (F.col("n_convs") - 1) * F.col("above")
    return full.join(parents, "parent", "left").select(
        F.col("first").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        "key", "parent")
