"""Route late-arriving events to their own table instead of dropping them.

Structured Streaming's watermark makes stateful operators drop rows that
arrive later than the allowed delay, and offers no side output for them. For
a medallion pipeline those rows matter (they reopen already published
partitions), so this stream keeps the watermark itself, with the same
semantics: the watermark of a micro-batch is the largest event time seen in
*earlier* micro-batches minus ``delay``. Rows of the batch below it go to the
``late`` table (to drive a bounded backfill), rows without an event time to
``undated``, the others to ``on_time``: every row goes to exactly one.

State is one row (the largest event time so far), written per batch id next
to the outputs, so a retried batch reads the same previous state and writes
the same result (outputs are partitioned by batch id and replaced, not
appended twice).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bronze_stream import read_stream


def _state_before(spark: SparkSession, state_root: str, batch_id: int):
    """Largest event time of the batches before ``batch_id`` (None for the first)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(state_root)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    ids = sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root)
                 if s.isDirectory() and s.getPath().getName().startswith("batch="))
    earlier = [i for i in ids if i < batch_id]
    if not earlier:
        return None
    return spark.read.parquet(os.path.join(state_root, f"batch={earlier[-1]}")).first()["max_event"]


def route_late_events(spark: SparkSession, source: str, schema: T.StructType, event_col: str, delay_seconds: int,
                      out_root: str, checkpoint: str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                      **options) -> None:
    """Run the router with ``trigger(availableNow=True)`` until the landed files are processed."""
    state_root = os.path.join(out_root, "_state")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        previous = _state_before(spark, state_root, batch_id)
        stamped = batch.withColumn("batch_id", F.lit(batch_id))
        if previous is None:
            late_flag = F.lit(False)
        else:
            watermark = F.lit(previous).cast(batch.schema[event_col].dataType) - F.expr(f"INTERVAL {delay_seconds} SECONDS")
            late_flag = F.col(event_col) < watermark
        routed = stamped.withColumn("_late", late_flag)
        undated = F.col(event_col).isNull()
        routed = routed.withColumn("_late", F.coalesce("_late", F.lit(False)))
        for name, cond in (("on_time", ~undated & ~F.col("_late")), ("late", ~undated & F.col("_late")), ("undated", undated)):
            (routed.where(cond).drop("_late").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
             .parquet(os.path.join(out_root, name)))
        seen = batch.agg(F.max(event_col).alias("m")).first()["m"]
        new_max = seen if previous is None or (seen is not None and seen > previous) else previous
        spark.createDataFrame([(new_max,)], T.StructType([T.StructField("max_event", batch.schema[event_col].dataType)])) \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(state_root, f"batch={batch_id}"))

    stream = read_stream(spark, source, schema, fmt, max_files_per_trigger, **options)
    query = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
