"""Streaming incremental pipeline: micro-batches of raw rows applied to a lake.

Each micro-batch of a file stream with a declared schema goes through
``plans.lake.refresh``: Silver buckets, fact partitions and dimensions that it
touches are written anew and one manifest publishes them all, so a reader sees
the lake before or after a micro-batch. The manifest keeps the number of the
last micro-batch of the stream; a retried one is recognised and skipped, which
makes the sink idempotent. The stream runs with ``trigger(availableNow=True)``:
every run processes the files that arrived since the last one, tracked in the
checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lake import LatestBy, refresh
from ..sources.versions import Lake
from .bronze_stream import read_stream


def stream_into_lake(spark: SparkSession, landing: str, schema: T.StructType, lake: Lake, name: str, taxonomy: DataFrame,
                     checkpoint: str, latest_by: LatestBy | None = None, fmt: str = "csv",
                     max_files_per_trigger: int | None = None, **options) -> None:
    """Apply the landed files of data set ``name`` to the lake until all are processed."""
    stream_id = f"stream:{name}:{checkpoint}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        done = lake.snapshot().notes.get(stream_id, -1)
        if batch_id <= done or batch.isEmpty():
            return
        stamped = batch.withColumn("ingestion_ts", F.current_timestamp())
        refresh(lake, {name: stamped}, taxonomy, latest_by, **{stream_id: batch_id})

    stream = read_stream(spark, landing, schema, fmt, max_files_per_trigger, **options)
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
