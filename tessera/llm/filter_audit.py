r"""Filter interaction audit: contingency tensors of failures, contracted for every order of the filters.

Five filters look at every text once; a document is then only its pattern of
failures, one bit a filter. Documents are counted by part and pattern (with
those that a label marks), so whatever the corpus holds, a part is a tensor of
2x2x2x2x2 counts. What an order of filters does at a step is a contraction of
that tensor: along each axis a selector takes pass, fail or all of it (earlier
filters: pass; this one: fail or pass; later ones: all). One einsum over all
orders and steps gives one measure.

The filters (words are runs without ASCII white space):

* A ``short``: fewer than 100 words
* B ``repetitive``: distinct words are less than 80 % of the words
* C ``capitals``: A-Z are more than 10 % of the code points
* D ``symbols``: holds one of ``#$%&*|``
* E ``repeated``: the text of a document with a smaller id, anywhere in the table

E needs no group in one place: equal texts fail A to D alike, so documents are
first counted by (text digest, part, labels, id), then by (text digest, part,
labels) with the smallest id and its rows, all by partial aggregates, and only
these sums meet by digest.

Defined results: a null text is empty; a null part is the empty string; a null
id is not smaller than any id and has no smaller one, so such a row passes E
and makes none fail; rows that share an id and a text are counted each and
fail E alike; several label rows of an id count as marked if one is; null
labels mark nothing; an empty table gives no rows; other columns are not read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

FILTERS = "ABCDE"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SPACE = r"[\x20\x09-\x0D]+"
ALL, PASS, FAIL = (1, 1), (1, 0), (0, 1)

AUDIT = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
    T.StructField("step", T.IntegerType()), *(T.StructField(m, T.LongType()) for m in MEASURES),
])


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at one text: A 1, B 2, C 4, D 8."""
    words = F.array_remove(F.split(text, SPACE), "")
    # the array of words is used twice but built once: it is the argument of a lambda
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    of_words = F.transform(F.array(counts), lambda c: (c["n"] < 100).cast("int") + F.when(c["d"] * 100 < c["n"] * 80, 2).otherwise(0))[0]
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") * 100 > F.length(text).cast("long") * 10
    return of_words + F.when(capitals, 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One narrow row a document: doc_id, part, digest of the text, bits of A to D, good and toxic (0 or 1)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"),
                         F.unhex(F.sha2(text, 256)).alias("digest"), text_failures(text).alias("bits"))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    zero = F.lit(0)
    return narrow.join(marked, "doc_id", "left").withColumns(
        {"good": F.coalesce("good", zero), "toxic": F.coalesce("toxic", zero)})


def contingency(rows: DataFrame) -> DataFrame:
    """Rows (part, pattern, n, n_good, n_toxic): documents by part and pattern of the five failures."""
    kind = ["digest", "part", "bits", "good", "toxic"]
    ids = rows.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    known = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows"))
    kinds = ids.groupBy(*kind).agg(F.sum("rows").alias("n"), F.min(known).alias("first"),
                                   F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(0)).alias("unknown"))
    # kinds of a digest are few (labels and parts): a list of sums, not of documents
    texts = kinds.groupBy("digest").agg(F.min("first.doc_id").alias("smallest"),
                                        F.collect_list(F.struct("part", "bits", "good", "toxic", "n", "first", "unknown")).alias("kinds"))
    kind_rows = texts.select("smallest", F.inline("kinds"))
    passes = F.col("unknown") + F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.rows")).otherwise(0)
    split = kind_rows.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("bits").alias("pattern"), passes.alias("n")),
        F.struct((F.col("bits") + 16).alias("pattern"), (F.col("n") - passes).alias("n")))))
    n = F.col("n")
    return split.groupBy("part", "pattern").agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("n_good"),
                                                F.sum(n * F.col("toxic")).alias("n_toxic"))


def orders(k: int) -> list[tuple[int, ...]]:
    return list(permutations(range(k)))


def selectors(k: int, before: tuple, here: tuple, after: tuple) -> list[np.ndarray]:
    """For each axis its selector at every (order, step): what earlier, this and later filters take."""
    taken = np.empty((k, len(orders(k)), k, 2), np.int64)
    for i, order in enumerate(orders(k)):
        for step in range(k):
            for place, axis in enumerate(order):
                taken[axis, i, step] = before if place < step else here if place == step else after
    return list(taken.reshape(k, -1, 2))


def contract(tensor: np.ndarray, chosen: list[np.ndarray]) -> np.ndarray:
    """(parts, orders x steps) of a (parts, 2, 2, ...) tensor: einsum with one selector an axis."""
    k = len(chosen)
    axes = "abcdefgh"[:k]
    return np.einsum(f"p{axes},{','.join('s' + a for a in axes)}->ps", tensor, *chosen, optimize="greedy")


def measures(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """All measures, each (parts, orders, steps), of tensors of shape (parts, 2, 2, ...)."""
    k = n.ndim - 1
    shape = (len(n), len(orders(k)), k)
    removing = selectors(k, PASS, FAIL, ALL)
    removed = contract(n, removing).reshape(shape)
    failing = contract(n, selectors(k, ALL, FAIL, ALL)).reshape(shape)
    order = np.array(orders(k))
    by_filter = np.stack([(removed * (order == f)).sum(axis=(1, 2)) for f in range(k)], axis=1)
    found = {
        "kept": contract(n, selectors(k, PASS, PASS, ALL)), "removed": removed, "redundant": failing - removed,
        "unique_fails": contract(n, selectors(k, PASS, FAIL, PASS)), "good_lost": contract(good, removing),
        "toxic_lost": contract(toxic, removing), "shapley": by_filter[:, order],
    }
    return {name: v.reshape(shape) for name, v in found.items()}


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the ``MEASURES``.

    ``docs`` has doc_id, text and lang (the part), ``labels`` doc_id, quality
    and toxic. Parts are spread over the tasks; a part is at most 32 rows.
    """
    k = len(FILTERS)
    cells = F.collect_list(F.struct("pattern", "n", "n_good", "n_toxic")).alias("cells")
    # the few rows of sums are written once, so that a lost task of the contraction re-reads them
    tensors = staged(contingency(failures(docs, labels)), "audit-counts").groupBy("part").agg(cells)
    names = ["".join(FILTERS[f] for f in order) for order in orders(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                some = batch.slice(start, 64)
                # the highest bit is the first axis of the reshaped tensor: put A first
                flat = np.zeros((3, some.num_rows, 2**k), np.int64)
                for p, rows in enumerate(some.column(1).to_pylist()):
                    for cell in rows:
                        flat[:, p, cell["pattern"]] += (cell["n"], cell["n_good"], cell["n_toxic"])
                shaped = flat.reshape(3, some.num_rows, *([2] * k)).transpose(0, 1, *range(k + 1, 1, -1))
                made = measures(*shaped)
                each = len(names) * k
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.array(some.column(0).to_pylist(), object), each), pa.string()),
                    pa.array(np.tile(np.repeat(np.array(names, object), k), some.num_rows), pa.string()),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), some.num_rows * len(names))),
                    *(pa.array(made[m].reshape(-1), pa.int64()) for m in MEASURES)], names=AUDIT.names)

    return tensors.mapInArrow(run, AUDIT)
