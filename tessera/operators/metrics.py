"""Run metrics as a history, and their changes from run to run.

A run's metrics are long rows (table_name, metric, value). ``record`` appends
them to a history table of a lake, one run number each; ``metric_deltas``
compares every run with the one before it. Row counts and null rates of a
table are one aggregate; foreign-key failures, freshness, late rows and stored
bytes come as metrics of the same shape, so an alert is a filter on one table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quality as Q

HISTORY = "run_metrics"


def _metric(one: DataFrame, table: str, metric: str, value: Column) -> DataFrame:
    return one.select(F.lit(table).alias("table_name"), F.lit(metric).alias("metric"), value.cast("double").alias("value"))


def table_metrics(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``rows`` and ``null_rate:<column>`` (0 for an empty table) in one pass over the table."""
    columns = list(columns if columns is not None else df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)))
    rate = [F.struct(F.lit(f"null_rate:{c}").alias("metric"),
                     F.coalesce(F.try_divide(F.col(f"_n{i}").cast("double"), F.col("_rows").cast("double")), F.lit(0.0)).alias("value"))
            for i, c in enumerate(columns)]
    rows = F.struct(F.lit("rows").alias("metric"), F.col("_rows").cast("double").alias("value"))
    return one.select(F.lit(table).alias("table_name"), F.inline(F.array(rows, *rate)))


def relation_metrics(results: DataFrame) -> DataFrame:
    """Result rows of relations (``quality.ri_check_matrix``) as metrics ``orphans:<fk>`` of their facts."""
    name = F.split_part(F.col("test_name"), F.lit(" -> "), F.lit(1))
    table, fk = F.split_part(name, F.lit("."), F.lit(1)), F.split_part(name, F.lit("."), F.lit(2))
    return results.select(table.alias("table_name"), F.concat(F.lit("orphans:"), fk).alias("metric"),
                          F.col("rows_failed").cast("double").alias("value"))


def freshness_metric(df: DataFrame, table: str, ts: str, as_of: Column) -> DataFrame:
    """``age_hours`` of the newest row (NULL for an empty table)."""
    return _metric(df.agg(F.max(ts).alias("_m")), table, "age_hours", Q.age_hours(F.col("_m"), as_of))


def count_metric(df: DataFrame, table: str, metric: str) -> DataFrame:
    """The number of rows of ``df`` (e.g. late rows) as a metric."""
    return _metric(df.agg(F.count(F.lit(1)).alias("_n")), table, metric, F.col("_n"))


def stored_bytes(files: DataFrame, table: str) -> DataFrame:
    """``bytes`` of the files a table read from storage consists of."""
    each = files.select(F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_size").alias("_s")).distinct()
    return _metric(each.agg(F.coalesce(F.sum("_s"), F.lit(0)).alias("_b")), table, "bytes", F.col("_b"))


def record(change, run_id: str, metrics: DataFrame) -> None:
    """Add a run's metrics to the history of a lake (a ``sources.versions.Change``); runs are numbered as recorded."""
    rows = metrics.select(F.lit(change.base.version + 1).cast("long").alias("run_no"), F.lit(run_id).alias("run_id"),
                          "table_name", "metric", "value")
    if HISTORY in change.entries:
        change.append(HISTORY, rows)
    else:
        change.write(HISTORY, rows)


def metric_deltas(history: DataFrame) -> DataFrame:
    """Every metric of every run with the previous run's value, their difference and its percentage of that value.

    A metric that the previous run did not have has no previous value; the
    percentage is NULL where the previous value is 0 or unknown. One window
    over (table, metric): as many rows as runs.
    """
    runs = Window.partitionBy("table_name", "metric").orderBy("run_no")
    order = history.select("run_no").distinct().select(
        "run_no", F.lag("run_no").over(Window.orderBy("run_no")).alias("_before"))  # one row a run
    last, last_run = F.lag("value").over(runs), F.lag("run_no").over(runs)
    rows = history.withColumns({"_last": last, "_last_run": last_run}).join(F.broadcast(order), "run_no")
    previous = F.when(F.col("_last_run") == F.col("_before"), F.col("_last"))
    delta = F.col("value") - F.col("previous_value")
    return rows.withColumn("previous_value", previous).select(
        "run_no", "run_id", "table_name", "metric", "value", "previous_value", delta.alias("delta"),
        (F.try_divide(delta, F.col("previous_value")) * 100.0).alias("delta_pct"))
