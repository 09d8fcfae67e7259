"""Incremental Bronze ingestion with Structured Streaming.

A file source with a declared schema is appended to a Bronze folder with
``trigger(availableNow=True)``: every run processes exactly the files that
arrived since the last run (tracked in the checkpoint), then stops. Each
micro-batch stamps its rows with the run's batch id and ingestion time.
Bronze is the replay source, so it keeps every row however late it arrives;
re-sent rows are removed when Silver is built (``replay_safe``: one row per
key). ``dedupe_within_watermark`` is for downstream streams that may forget
rows older than the watermark; it is never applied on the way into Bronze.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import dedupe_latest


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        # a stream has a fixed schema: check every file's header against it so a
        # reordered or renamed column fails the stream instead of being misread
        reader = reader.option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def stamp_stream(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id)).withColumn("ingestion_ts", F.current_timestamp())


def dedupe_within_watermark(df: DataFrame, event_col: str, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """Replay-safe dedupe: one row per key among rows within ``delay`` of the watermark.

    Watermarks need a zoned timestamp: a TIMESTAMP_NTZ event column is
    watermarked through a cast copy (session time zone), dropped afterwards.
    """
    if isinstance(df.schema[event_col].dataType, T.TimestampNTZType):
        wm = "_event_time"
        df = df.withColumn(wm, F.col(event_col).cast("timestamp"))
        return df.withWatermark(wm, delay).dropDuplicatesWithinWatermark(list(keys)).drop(wm)
    return df.withWatermark(event_col, delay).dropDuplicatesWithinWatermark(list(keys))


def append_stream(df: DataFrame, bronze_path: str, checkpoint: str, partition_cols: Sequence[str] = ()) -> None:
    """Run one availableNow append to Parquet and wait for it to finish."""
    writer = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    query = writer.start(bronze_path)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def ingest_bronze(spark: SparkSession, source: str, schema: T.StructType, bronze_path: str, checkpoint: str,
                  batch_id: str, fmt: str = "parquet", **options) -> None:
    """source files -> stamped Bronze append, every row kept."""
    append_stream(stamp_stream(read_stream(spark, source, schema, fmt, **options), batch_id), bronze_path, checkpoint)


def replay_safe(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key of a Bronze table: the latest ingested (rows with a NULL key stay as one key)."""
    return dedupe_latest(bronze, list(keys), ("ingestion_ts",))
