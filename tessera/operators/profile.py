"""Profilers: nulls, duplicate keys, duplicate-id histograms, orphans.

Each profiler is one or two aggregate jobs whatever the number of columns
(the per-column counts are computed in one pass and unpivoted), and returns a
DataFrame; printing is the caller's business.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import union_all


def _unpivot_counts(one: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    arr = F.array(*(F.struct(F.lit(n).alias(label), F.col(f"_c{i}").alias("null_count")) for i, n in enumerate(names)))
    return one.select("row_count", F.explode(arr).alias("r")).select("r.*", "row_count")


def null_profile(df: DataFrame, table_name: str = "table") -> DataFrame:
    """(table_name, column_name, data_type, row_count, null_count) in one aggregate pass."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("row_count"), *(F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)))
    types = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(df.schema[c].dataType.simpleString()))])
    out = _unpivot_counts(one, cols, "column_name")
    return out.select(
        F.lit(table_name).alias("table_name"), "column_name", types[F.col("column_name")].alias("data_type"),
        "row_count", "null_count",
    )


def null_profiles(tables: dict[str, DataFrame], only_with_nulls: bool = False) -> DataFrame:
    out = union_all([null_profile(df, name) for name, df in tables.items()])
    return out.where(F.col("null_count") > 0) if only_with_nulls else out


def duplicate_key_groups(df: DataFrame, keys: Sequence[str], table_name: str = "table") -> DataFrame:
    """One row: key groups, duplicated groups and rows inside duplicated groups."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.count(F.lit(1)).alias("key_groups"),
        F.count_if(F.col("_n") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("long").alias("rows_in_duplicate_groups"),
    ).select(F.lit(table_name).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"), "*")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once, with the key's row count.

    The key counts come from a partially aggregated groupBy (skew-safe); the
    rows are then matched with an equi-join, which AQE splits when a key is hot.
    """
    dups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).where(F.col("key_rows") > 1)
    return df.join(dups, list(keys), "inner")


def duplicate_histogram(df: DataFrame, id_col: str, other_col: str) -> DataFrame:
    """How many ids map to 1, 2, ... distinct values of ``other_col`` (two-level aggregate)."""
    per_id = df.groupBy(id_col).agg(F.count_distinct(other_col).alias("distinct_values"))
    return per_id.groupBy("distinct_values").agg(F.count(F.lit(1)).alias("ids")).orderBy("distinct_values")


def missing_key_rows(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNull())


def orphan_values(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Distinct non-NULL child values with no parent row (anti join of two distinct sets)."""
    c = child.select(F.col(child_col).alias("value")).where(F.col("value").isNotNull()).distinct()
    p = parent.select(F.col(parent_col).alias("value")).where(F.col("value").isNotNull()).distinct()
    return c.join(p, "value", "left_anti")


def orphan_summary(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str, relation: str) -> DataFrame:
    """(relation, child_values, orphan_values) in one pass over the joined distinct sets."""
    c = child.select(F.col(child_col).alias("value")).where(F.col("value").isNotNull()).distinct()
    p = parent.select(F.col(parent_col).alias("value")).where(F.col("value").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    return c.join(p, "value", "left").agg(
        F.count(F.lit(1)).alias("child_values"), F.count_if(F.col("_hit").isNull()).alias("orphan_values")
    ).select(F.lit(relation).alias("relation"), "child_values", "orphan_values")


def orphan_report(relations: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    return union_all([orphan_summary(c, cc, p, pc, name) for name, c, cc, p, pc in relations])


def orphan_rows(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(parent_col).alias(child_col)).where(F.col(child_col).isNotNull())
    return child.where(F.col(child_col).isNotNull()).join(keys, child_col, "left_anti")


def score_distribution(df: DataFrame, score_col: str = "review_score") -> DataFrame:
    return df.groupBy(score_col).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col(score_col).asc_nulls_first())


def profile_table(df: DataFrame, table_name: str = "table") -> DataFrame:
    """Row count, column count and per-column nulls (null profile + column count)."""
    return null_profile(df, table_name).withColumn("column_count", F.lit(len(df.columns)))


def _plain(file: Column) -> Column:
    """A file's path as written, not percent-encoded, with one slash behind the scheme."""
    decoded = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([a-z0-9]+):/+", "$1:/")


def _signatures(spark: SparkSession, files: Sequence[str], fmt: str, options: dict) -> dict[str, list[str]]:
    """Files by what they say about their columns: the header line of delimited text, else the stored schema."""
    found: dict[str, list[str]] = {}
    if fmt == "csv" and str(options.get("header", "")).lower() == "true":
        lines = spark.read.text(list(files)).select(
            _plain(F.col("_metadata.file_path")).alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_at"), "value").where("_start = 0")
        # the first line of each file's first split; one short row a file
        headers = {r._file: r.line for r in lines.groupBy("_file").agg(F.min_by("value", "_at").alias("line")).collect()}
        for file in files:
            found.setdefault(headers.get(file, ""), []).append(file)
        return found
    for file in files:  # metadata only, one footer a file
        found.setdefault(spark.read.format(fmt).options(**options).load(file).schema.json(), []).append(file)
    return found


def profile_files(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    """Rows, columns and null cells per source file of one folder, each read by its own header or schema.

    The files are those that Spark's own listing of the folder gives. Files
    with the same header (or schema) are one scan that counts by
    ``_metadata.file_path``, so the plan has a branch for every signature, not
    for every file.
    """
    schema = "file_name string, row_count long, column_count int, null_cells long, file_schema string"
    listed = spark.read.format(fmt).options(**options).load(path).inputFiles()
    files = sorted(re.sub("^([a-z0-9]+):/+", r"\1:/", unquote(f)) for f in listed)
    parts = []
    for same in (_signatures(spark, files, fmt, options) if files else {}).values():
        df = spark.read.format(fmt).options(**options).load(same)
        columns = df.columns
        nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in columns), F.lit(0).cast("long"))
        counted = df.select(_plain(F.col("_metadata.file_path")).alias("_file"), nulls.alias("_nulls")).groupBy("_file").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("_nulls").alias("null_cells"))
        # a file without rows has no group; the list is one short row a file
        named = spark.createDataFrame([(f, f.rsplit("/", 1)[-1]) for f in same], "_file string, file_name string")
        described = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        zero = F.lit(0).cast("long")
        parts.append(named.join(counted, "_file", "left").select(
            "file_name", F.coalesce("row_count", zero).alias("row_count"), F.lit(len(columns)).alias("column_count"),
            F.coalesce("null_cells", zero).alias("null_cells"), F.lit(described).alias("file_schema")))
    if not parts:
        return spark.createDataFrame([], schema)
    return union_all(parts).orderBy("file_name")
