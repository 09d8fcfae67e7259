"""Shared helpers of the text operators: words, hashes, folds, staged tables."""

from __future__ import annotations

import os

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# fixed values: the splitting pattern of the byte-level vocabularies and the word pattern
# of the digests (everything but space, tab, line feed, vertical tab, form feed, return)
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE = 5
GOLDEN = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once (zstd Parquet) to the shared checkpoint folder and read it back.

    Cuts lineage: later jobs read files that all executors share, so a lost
    executor only re-reads them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def words(text: str | None) -> list[bytes]:
    """Words (runs without ASCII white space) of a text, A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to ``limit`` words (then forgotten and refilled)."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, text: str | None) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int) -> np.uint64:
    """A 64-bit value for a small number, to tell hash functions apart."""
    return np.uint64(xxhash.xxh3_64_intdigest(seed.to_bytes(8, "little")))


def shingles(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order; a shorter text is one run, an empty one none."""
    if len(hashes) == 0:
        return hashes
    width = min(width, len(hashes))
    out = hashes[: len(hashes) - width + 1].copy()
    for i in range(1, width):
        out *= np.uint64(GOLDEN)
        out += hashes[i : len(hashes) - width + 1 + i]
    return mix(out)


def task_number() -> int:
    """Number of the running task's partition: the same when the task is run again."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def file_bytes(path: str) -> bytes:
    """A small file (a vocabulary) of this machine, read on the driver and sent along."""
    with open(os.path.expanduser(path), "rb") as f:
        return f.read()


BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a staged, narrow table) marked for broadcast if its counted rows are at most ``limit``.

    Beyond that it is left alone and a shuffle join takes over.
    """
    return F.broadcast(df) if df.count() <= limit else df


def in_groups(df: DataFrame, key: str, run, schema) -> DataFrame:
    """``run(rows)`` for the rows (dicts) of every value of ``key``; yields tuples of ``schema``.

    Groups must be bounded by the caller. Rows are dealt out by the key and
    streamed in order, so a task holds one group and one batch.
    """
    import pyarrow as pa

    arrow = pa.schema([(f.name, _ARROW[f.dataType.typeName()]) for f in schema])

    def task(batches):
        now, rows, out = None, [], []

        def flush():
            cut = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
            out.clear()
            return cut

        for batch in batches:
            for row in batch.to_pylist():
                if rows and row[key] != now:
                    out.extend(run(rows))
                    rows = []
                    if len(out) > 5000:
                        yield flush()
                now = row[key]
                rows.append(row)
        if rows:
            out.extend(run(rows))
        if out:
            yield flush()

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(task, schema)


def _arrow_types():
    import pyarrow as pa

    return {"long": pa.int64(), "integer": pa.int32(), "binary": pa.binary(), "double": pa.float64(),
            "string": pa.string(), "boolean": pa.bool_()}


_ARROW = _arrow_types()
