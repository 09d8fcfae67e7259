"""Order-insensitive table fingerprints and row-level diffs.

A fingerprint is computed by executors and combined by aggregation; no row
hash is collected. Per row: ``xxhash64`` over the columns sorted by name,
each followed by its NULL indicator (so moving a NULL between columns changes
the hash), and a second, independent ``hash`` (Murmur3). Per table: row
count, the sums of both hashes as exact decimals, and the XOR of the 64-bit
hashes. Sums are multiset-sensitive (a duplicated row changes them, where
XOR alone would cancel pairs) and independent of row and column order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(df: DataFrame) -> tuple[Column, Column]:
    parts = [x for c in sorted(df.columns) for x in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts), F.hash(*parts)


def sha256_fingerprint(df: DataFrame, table_name: str = "table") -> DataFrame:
    """Cryptographic variant: per-row SHA-256 of the row as JSON (columns sorted by
    name; JSON omits NULL fields, so a NULL moved to another column changes it).

    The 256-bit digests are combined order-insensitively by summing their four
    64-bit chunks as exact decimals on the executors; no digest is collected.
    """
    digest = F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns)))), 256)
    chunks = [F.conv(F.substring(digest, 16 * i + 1, 16), 16, 10).cast("decimal(20,0)") for i in range(4)]
    hashed = df.select(*(c.alias(f"_c{i}") for i, c in enumerate(chunks)))
    zero = F.lit(0).cast("decimal(38,0)")
    return hashed.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.concat_ws(":", *(F.coalesce(F.sum(f"_c{i}").cast("decimal(38,0)"), zero).cast("string") for i in range(4)))
        .alias("sha256_sum"),
    ).select(F.lit(table_name).alias("table_name"), F.lit(",".join(sorted(df.columns))).alias("columns"), "*")


def portable_text(df: DataFrame) -> Column:
    """A row as text that any engine can write: values of the columns by name, joined by ``|``.

    NULL is ``\\N``; decimals are their unscaled integers, timestamps have six
    decimals, booleans are true / false.
    """
    texts = []
    for name in sorted(df.columns):
        kind, c = df.schema[name].dataType, F.col(name)
        if kind.typeName() == "decimal":
            c = (c * 10**kind.scale).cast("decimal(38,0)")
        elif kind.typeName() in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        texts.append(F.coalesce(c.cast("string"), F.lit("\\N")))
    return F.concat_ws("|", *texts)


def portable_fingerprint(df: DataFrame, table_name: str = "table") -> DataFrame:
    """SHA-256 of every row's ``portable_text``, summed by 64-bit chunks: another engine can check it."""
    digest = F.sha2(portable_text(df), 256)
    chunks = [F.conv(F.substring(digest, 16 * i + 1, 16), 16, 10).cast("decimal(20,0)") for i in range(4)]
    zero = F.lit(0).cast("decimal(38,0)")
    sums = [F.coalesce(F.sum(f"_c{i}").cast("decimal(38,0)"), zero).cast("string").alias(f"sha256_sum_{i}") for i in range(4)]
    return df.select(*(c.alias(f"_c{i}") for i, c in enumerate(chunks))).agg(F.count(F.lit(1)).alias("row_count"), *sums).select(
        F.lit(table_name).alias("table_name"), "*")


def fingerprint(df: DataFrame, table_name: str = "table") -> DataFrame:
    h64, h32 = row_hash(df)
    hashed = df.select(h64.alias("_h"), h32.alias("_g"))
    return hashed.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        # decimal sums: a long sum of hashes would overflow (ANSI error) beyond ~2^32 rows
        F.coalesce(F.sum(F.col("_g").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("hash32_sum"),
        F.coalesce(F.bit_xor("_h"), F.lit(0).cast("long")).alias("hash_xor"),
    ).select(F.lit(table_name).alias("table_name"), F.lit(",".join(sorted(df.columns))).alias("columns"), "*")


def fingerprints(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [fingerprint(df, name) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare_fingerprints(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two fingerprint sets by table name; ``equal`` when every component matches."""
    cols = ["columns", "row_count", "hash_sum", "hash32_sum", "hash_xor"]
    left = a.select("table_name", *(F.col(c).alias(f"a_{c}") for c in cols))
    right = b.select("table_name", *(F.col(c).alias(f"b_{c}") for c in cols))
    eq = F.lit(True)
    for c in cols:
        eq = eq & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return left.join(right, "table_name", "full_outer").select(
        "table_name", F.col("a_row_count").alias("rows_a"), F.col("b_row_count").alias("rows_b"), eq.alias("equal")
    )


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level diff on a grain: added, removed, changed (NULL-safe per column).

    One full outer join on the key (both sides shuffled once on it). Output:
    the key, ``change`` and the list of changed columns; unchanged rows are
    dropped.
    """
    value_cols = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*value_cols).alias("_old"), F.lit(True).alias("_in_old"))
    n = new.select(*keys, F.struct(*[c for c in value_cols if c in new.columns]).alias("_new"), F.lit(True).alias("_in_new"))
    j = o.join(n, list(keys), "full_outer")
    changed = F.filter(
        F.array(*(F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in value_cols if c in new.columns)),
        lambda x: x.isNotNull(),
    )
    change = (
        F.when(F.col("_in_old").isNull(), F.lit("added"))
        .when(F.col("_in_new").isNull(), F.lit("removed"))
        .when(F.size(changed) > 0, F.lit("changed"))
    )
    return j.select(*keys, change.alias("change"), F.array_join(F.when(change == "changed", changed), ",").alias("changed_columns")).where(
        F.col("change").isNotNull()
    )


# ------------------------------------------------------------ tree of fingerprints
FANOUT = 16


def fingerprint_tree(df: DataFrame, bucket: str = "_bucket", fanout: int = FANOUT) -> DataFrame:
    """Fingerprints of a bucketed table as a tree: rows (level, node, row_count, hash_sum, hash_xor).

    Level 0 holds the buckets; node n of the next level combines the nodes
    n * fanout .. of the one below, up to a single root. Sums and XORs combine,
    so rows are hashed once. The tree has little more rows than buckets.
    """
    h64, _ = row_hash(df.drop(bucket))
    zero = F.lit(0).cast("decimal(38,0)")
    leaves = df.select(F.col(bucket).cast("long").alias("node"), h64.alias("_h")).groupBy("node").agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")), zero).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("_h").alias("hash_xor"))
    # every bucket counts for one node of each level: one aggregate makes all upper levels
    up = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda i: F.struct(
        i.alias("level"), F.floor(F.col("node") / F.pow(F.lit(float(fanout)), i)).cast("long").alias("node")))
    return leaves.select(F.inline(up), "row_count", "hash_sum", "hash_xor").groupBy("level", "node").agg(
        F.sum("row_count").alias("row_count"), F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"))


LEVELS = 5  # a root over 16**5 buckets


def unequal_buckets(a: DataFrame, b: DataFrame, fanout: int = FANOUT) -> list[int]:
    """Buckets that differ between two trees (or exist in one only), found from the root downwards.

    Only nodes below an unequal node are compared, and each level's unequal
    nodes (at most the buckets) are listed on the driver.
    """
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("row_count", "hash_sum", "hash_xor")]
    nodes: list[int] | None = None
    for level in range(LEVELS, -1, -1):
        x, y = (t.where(F.col("level") == level) for t in (a, b))
        if nodes is not None:
            parent = F.floor(F.col("node") / fanout)
            x, y = (t.where(parent.isin(nodes)) for t in (x, y))
        pairs = x.alias("a").join(y.alias("b"), F.col("a.node") == F.col("b.node"), "full_outer")
        unequal = pairs.where(~(same[0] & same[1] & same[2])).select(F.coalesce("a.node", "b.node"))
        nodes = sorted(r[0] for r in unequal.collect())
        if not nodes:
            return []
    return nodes


def bucket_diff(old, new, keys: Sequence[str], unequal: Sequence[int], bucket: str = "_bucket") -> DataFrame:
    """``table_diff`` of two versions of a table that both read buckets by number: equal buckets are not read.

    ``old`` and ``new`` return the rows of the buckets they are given.
    """
    return table_diff(old(unequal).drop(bucket), new(unequal).drop(bucket), keys)
