"""Incremental processing: affected partitions, late arrivals, backfill windows,
SCD1 upserts, SCD2 history, schema drift and run metrics.

Plain Parquet has no MERGE, so upserts are "union old and new, latest wins"
(one shuffle on the key) and partition rewrites use dynamic partition
overwrite (only the partitions present in the new data are replaced).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .dedupe import dedupe_latest


# ------------------------------------------------------------ partitions
def affected_partitions(batch_rows: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Distinct partition values touched by a batch (what must be rebuilt)."""
    return batch_rows.select(*partition_cols).distinct()


def restrict_to_partitions(table: DataFrame, partitions: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``table`` in the affected partitions (a semi join; partition
    pruning applies when ``table`` is a partitioned scan and the partition
    set is small enough for Catalyst to broadcast)."""
    same = [table[c].eqNullSafe(partitions[c]) for c in partition_cols]  # a NULL partition is a partition
    return table.join(partitions, same, "left_semi")


def zone_map(rows: DataFrame, key: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Smallest and largest key per file (the columns ``by``) and key bucket, and its rows with a NULL key.

    ``rows`` carries the file next to the key (e.g. ``_metadata.file_path``);
    only these columns are scanned. Rows are combined before the shuffle.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")
    return rows.groupBy(*by, bucket).agg(F.min(key).alias("low"), F.max(key).alias("high"),
                                         F.count_if(F.col(key).isNull()).alias("nulls"), F.count(F.lit(1)).alias("rows"))


def affected_files(zones: DataFrame, keys: DataFrame, key: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Distinct files (columns ``by``) of a ``zone_map`` that can hold one of the keys; no other file does.

    A zone is met if the smallest key that is not below its low end lies in
    it. Zones and keys of a bucket are sorted together and one running value
    tells that key, so nothing is paired: the cost is a sort, however many
    keys and files share a bucket. NULL is a key.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")
    wanted = keys.select(F.col(key).alias("_at"), bucket).distinct()
    kind = wanted.schema["_at"].dataType
    points = wanted.where(F.col("_at").isNotNull()).select(
        "_bucket", "_at", F.col("_at").alias("_key"), *(F.lit(None).cast(zones.schema[c].dataType).alias(c) for c in by),
        F.lit(None).cast(kind).alias("high"))
    lows = zones.where(F.col("low").isNotNull()).select(
        "_bucket", F.col("low").cast(kind).alias("_at"), F.lit(None).cast(kind).alias("_key"), *by, F.col("high").cast(kind))
    # downwards; a key that equals a low end comes before it
    down = Window.partitionBy("_bucket").orderBy(F.desc("_at"), F.desc_nulls_last("_key")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    next_key = F.last("_key", ignorenulls=True).over(down)
    met = points.unionByName(lows).withColumn("_next", next_key).where(F.col("high").isNotNull() & (F.col("_next") <= F.col("high")))
    unknown = zones.where("nulls > 0").join(wanted.where(F.col("_at").isNull()).select("_bucket"), "_bucket", "left_semi")
    return met.select(*by).unionByName(unknown.select(*by)).distinct()


# ------------------------------------------------------------ late data
def late_arrivals(df: DataFrame, event_col: str, arrival_col: str, max_delay_days: int) -> DataFrame:
    """Rows that arrived more than ``max_delay_days`` after their event time.

    Those rows land in old event-time partitions that were already
    published, so their partitions must be reprocessed.
    """
    delay = F.datediff(F.to_date(arrival_col), F.to_date(event_col))
    return df.where(F.col(event_col).isNotNull() & F.col(arrival_col).isNotNull()).withColumn(
        "delay_days", delay
    ).where(F.col("delay_days") > max_delay_days)


def late_arrival_volume(late: DataFrame, partition_col: str) -> DataFrame:
    """Late rows per event-time partition (the partitions to reprocess)."""
    return late.groupBy(partition_col).agg(F.count(F.lit(1)).alias("late_rows"), F.max("delay_days").alias("max_delay_days"))


def backfill_window(df: DataFrame, ts_col: str, days: int, end: Column | None = None) -> DataFrame:
    """Rows whose event date lies in the ``days`` days up to ``end`` (default: the latest date).

    The bound is written on the raw column so it is pushed to the scan.
    """
    end_date = end if end is not None else df.select(F.max(F.to_date(ts_col))).scalar()
    start = F.date_sub(end_date, days - 1)
    return df.where(
        (F.col(ts_col) >= start.cast("timestamp_ntz")) & (F.col(ts_col) < F.date_add(end_date, 1).cast("timestamp_ntz"))
    )


# ------------------------------------------------------------ dimensions
def scd1_upsert(current: DataFrame, updates: DataFrame, keys: Sequence[str], updated_col: str) -> DataFrame:
    """Type-1 merge: per key the greatest ``updated_col`` wins (ties broken by every column)."""
    both = current.unionByName(updates.select(*current.columns))
    return dedupe_latest(both, keys, (updated_col,))


# versions of a key from which on it is dealt out over segments
HOT_VERSIONS = 100_000


def scd2_history(versions: DataFrame, keys: Sequence[str], tracked: Sequence[str], valid_from: str,
                 segments: int | None = None, period: str | None = None, hot_versions: int = HOT_VERSIONS,
                 place: Sequence[str] = ()) -> DataFrame:
    """Type-2 history: one interval per run of identical tracked values.

    Versions are ordered by ``valid_from`` then the tracked values (a total
    order); a version equal to its predecessor (NULL-safe) extends the
    interval instead of opening one. ``valid_to`` is the next interval's
    start (NULL for the current one).

    Keys with up to ``hot_versions`` versions take one window by key, so their
    rows are shuffled once. ``place`` names columns that follow from the key
    (e.g. its bucket) to deal these rows out by, so that they lie as they will
    be written. Keys with more versions (few: counted first, from their keys
    alone) go by segments; with ``segments`` every key does.
    """
    if segments:
        return _segmented_history(versions, keys, tracked, valid_from, segments, period)
    many = versions.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_versions).select(
        *(F.col(k).alias(f"_hot_{k}") for k in keys))
    hot = materialize(many, "scd2-hot-keys")
    if hot.isEmpty():
        return _keyed_history(versions, keys, tracked, valid_from, place)
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    light = _keyed_history(versions.join(hot, same, "left_anti"), keys, tracked, valid_from, place)
    return light.unionByName(_segmented_history(versions.join(hot, same, "left_semi"), keys, tracked, valid_from, None, period))


def _keyed_history(versions: DataFrame, keys: Sequence[str], tracked: Sequence[str], valid_from: str,
                   place: Sequence[str]) -> DataFrame:
    """``scd2_history`` by one window over each key."""
    w = Window.partitionBy(*place, *keys).orderBy(*(F.col(c).asc_nulls_first() for c in (valid_from, *tracked)))
    rows = versions.select(*dict.fromkeys([*place, *keys, *tracked, valid_from]))
    rows = rows.repartition(*place) if place else rows
    same_as_lag = F.row_number().over(w) > 1
    for c in tracked:
        same_as_lag = same_as_lag & F.col(c).eqNullSafe(F.lag(c).over(w))
    starts = rows.withColumn("_same", same_as_lag).where(~F.col("_same"))
    successor = F.lead(F.struct(F.col(valid_from).alias("vf"))).over(w)  # a struct: a NULL valid_from is a start too
    return starts.withColumn("_next", successor).select(
        *keys, *tracked, F.col(valid_from).alias("valid_from"), F.col("_next.vf").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"))


def _segmented_history(versions: DataFrame, keys: Sequence[str], tracked: Sequence[str], valid_from: str,
                       segments: int | None, period: str | None) -> DataFrame:
    """``scd2_history`` of keys with very many versions.

    Skew-safe plan: rows are range-partitioned on (key, order) into
    ``segments`` balanced ranges, so one key with a large share of all
    versions spans several segments instead of one task. One windowed pass
    per (segment, key) finds the local interval starts and, for every row,
    the next local start; it is written once to the shared checkpoint
    folder and read back. What crosses segment borders (the previous segment's last version,
    the next segment's first start) is taken from a table with one row per
    (segment, key), joined back once.

    With ``period`` ("month" or "day") a segment is a period of
    ``valid_from``: rows are dealt out by (period, key), nothing is sampled.
    """
    order_cols = [valid_from, *tracked]
    sort = [F.col(c).asc_nulls_first() for c in order_cols]
    seg_keys = ["_seg", *keys]
    by_key = Window.partitionBy(*keys).orderBy("_seg")
    w = Window.partitionBy(*seg_keys).orderBy(*sort)
    # "the first start after this row", written as "the last start before it" in
    # reversed order: a growing frame Spark evaluates incrementally, where an
    # unbounded-following frame is re-evaluated for every row (quadratic in the
    # group size, which a hot key makes large)
    reverse = [F.col(c).desc_nulls_last() for c in order_cols]
    after = Window.partitionBy(*seg_keys).orderBy(*reverse).rowsBetween(Window.unboundedPreceding, -1)

    range_order = [*(F.col(k).asc_nulls_first() for k in keys), *sort]
    base = versions.select(*keys, *tracked, valid_from)
    # no explicit count: AQE may merge adjacent small ranges (segments stay ordered)
    if period:
        ranged = base.withColumn("_seg", F.coalesce(_period(F.col(valid_from), period), F.lit(-(2**31))))
    else:
        ranged = (base.repartitionByRange(segments, *range_order) if segments else base.repartitionByRange(*range_order)
                  ).withColumn("_seg", F.spark_partition_id())
    same_as_lag = F.lit(True)
    for c in tracked:
        same_as_lag = same_as_lag & F.col(c).eqNullSafe(F.lag(c).over(w))
    pass1 = ranged.select(
        "*", F.row_number().over(w).alias("_rn"), F.count(F.lit(1)).over(Window.partitionBy(*seg_keys)).alias("_n"),
        same_as_lag.alias("_same"),
    )
    # a row after the first is a start when it differs from its predecessor
    local_start = (F.col("_rn") > 1) & ~F.col("_same")
    nxt = F.when(local_start, F.struct(F.col(valid_from).alias("vf")))
    local = pass1.select(
        *keys, *tracked, valid_from, "_seg", "_rn", "_n", local_start.alias("_local_start"),
        F.last(nxt, ignorenulls=True).over(after).alias("_next_local"),
    )
    local = materialize(local, "scd2-segments")  # read by both branches below; lineage cut

    # one row per (segment, key): first and last version of the segment
    first_rows = local.where(F.col("_rn") == 1).select(
        *seg_keys, F.struct(*tracked).alias("_first_vals"), F.col(valid_from).alias("_first_vf"), "_next_local")
    last_rows = local.where(F.col("_rn") == F.col("_n")).select(
        *(F.col(c).alias(f"_l_{c}") for c in seg_keys), F.struct(*tracked).alias("_last_vals"))
    seg = first_rows.join(last_rows, [F.col(c).eqNullSafe(F.col(f"_l_{c}")) for c in seg_keys])  # NULL is a key
    prev_last = F.lag("_last_vals").over(by_key)
    first_same = F.lit(True)
    for c in tracked:
        first_same = first_same & F.col(f"_first_vals.{c}").eqNullSafe(prev_last[c])
    seg = seg.select("*", (prev_last.isNull() | ~first_same).alias("_first_is_start"))
    # the segment's first interval start (a struct, so a NULL valid_from is still "present")
    seg_first_start = F.when(F.col("_first_is_start"), F.struct(F.col("_first_vf").alias("vf"))).otherwise(F.col("_next_local"))
    seg = seg.select(*seg_keys, "_first_is_start", seg_first_start.alias("_seg_start"))
    later_segments = Window.partitionBy(*keys).orderBy(F.col("_seg").desc()).rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(*(F.col(c).alias(f"_s_{c}") for c in seg_keys), "_first_is_start",
                     F.last("_seg_start", ignorenulls=True).over(later_segments).alias("_next_seg_start"))

    starts = local.join(seg, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in seg_keys]).where(
        F.col("_local_start") | ((F.col("_rn") == 1) & F.col("_first_is_start")))
    successor = F.coalesce(F.col("_next_local"), F.col("_next_seg_start"))
    return starts.select(
        *keys, *tracked, F.col(valid_from).alias("valid_from"), successor["vf"].alias("valid_to"),
        successor.isNull().alias("is_current"),
    )


def _period(ts: Column, period: str) -> Column:
    """Number of a timestamp's month or day, ascending with time."""
    return {"month": F.year(ts) * 12 + F.month(ts), "day": F.unix_date(F.to_date(ts))}[period]


# ------------------------------------------------------------ schema drift
def schema_drift(spark: SparkSession, expected: T.StructType, actual: T.StructType) -> DataFrame:
    """Added / removed / type-changed columns; additions are compatible, the rest breaking.

    Works on schema metadata only (a handful of rows built on the driver).
    """
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    act = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for name in sorted(set(exp) | set(act)):
        if name not in act:
            rows.append((name, "removed", exp[name], None, True))
        elif name not in exp:
            rows.append((name, "added", None, act[name], False))
        elif exp[name] != act[name]:
            rows.append((name, "type_changed", exp[name], act[name], True))
    schema = "column_name string, change string, expected_type string, actual_type string, breaking boolean"
    return spark.createDataFrame(rows, schema)


def assert_compatible(drift: DataFrame) -> None:
    breaking = drift.where("breaking").select("column_name", "change").collect()
    if breaking:
        raise ValueError("breaking schema change: " + ", ".join(f"{r.column_name} {r.change}" for r in breaking))


# ------------------------------------------------------------ run metrics
def run_metrics(raw: dict[str, DataFrame], silver: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> DataFrame:
    """Per data set: raw rows, NULL-key rows, Silver rows and rows removed by dedupe.

    One aggregate per table and layer, unpivoted into a long
    (table_name, metric, value) table that a run can append to a history.
    """
    out = None
    for name, df in raw.items():
        null_key = F.lit(False)
        for c in keys[name]:
            null_key = null_key | F.col(c).isNull()
        silver_rows = silver[name].agg(F.count(F.lit(1))).scalar()  # scalar subquery
        both = df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(null_key).alias("null_key_rows")).withColumn(
            "silver_rows", silver_rows
        )
        metrics = ("raw_rows", "null_key_rows", "silver_rows")
        part = both.select(
            F.lit(name).alias("table_name"),
            F.explode(F.array(
                *(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics),
                F.struct(F.lit("duplicates_removed").alias("metric"), (F.col("raw_rows") - F.col("silver_rows")).alias("value")),
            )).alias("m"),
        ).select("table_name", "m.*")
        out = part if out is None else out.unionByName(part)
    return out
