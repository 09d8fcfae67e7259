"""Sources and sinks: raw CSV reader, Bronze append, table writes, views.

Only this module and the driver-table adapter know about paths; operators
take and return DataFrames.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Collection, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import MULTILINE_TABLES, RAW_SCHEMAS


CORRUPT = "_corrupt_record"
CODEC = "zstd"  # of written tables: about a quarter smaller than the default here


def _csv(spark: SparkSession, multiline: bool):
    return (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multiline).option("mode", "PERMISSIVE")
    )


def raw_header(spark: SparkSession, path: str, multiline: bool = False) -> list[str]:
    """Column names of the CSV header (one small read of the first line)."""
    return _csv(spark, multiline).csv(path).columns


def read_raw(spark: SparkSession, path: str, name: str, schema: T.StructType | None = None,
             multiline: bool | None = None) -> DataFrame:
    """RFC-4180 CSV with a header; the declared (all-string) columns are taken *by name*.

    The file is parsed with its own header order (so an added or reordered
    column cannot shift values into the wrong column), every file's header is
    checked against it (``enforceSchema=false``: a folder whose files disagree
    fails instead of being misread), and the declared columns are projected by
    name; a declared column the file lacks is NULL (see ``header_drift``).
    ``multiLine`` is enabled only for data sets with free text that may hold
    quoted newlines: a multiLine file is read by one task, every other file is
    split across tasks. Malformed lines do not fail the job: in PERMISSIVE
    mode their text lands in ``_corrupt_record`` (kept in Bronze) and
    ``quality.malformed_rows_rule`` counts them.
    """
    ml = name in MULTILINE_TABLES if multiline is None else multiline
    declared = schema or RAW_SCHEMAS[name]
    header = raw_header(spark, path, ml)
    file_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header]
                               + [T.StructField(CORRUPT, T.StringType(), True)])
    df = (
        _csv(spark, ml).schema(file_schema)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    cols = [F.col(c) if c in header else F.lit(None).cast("string").alias(c) for c in declared.fieldNames()]
    return df.select(*cols, CORRUPT)


def well_formed(bronze: DataFrame) -> DataFrame:
    """Bronze rows without the lines that did not parse (those stay in Bronze, as a quarantine)."""
    return bronze.where(F.col(CORRUPT).isNull()) if CORRUPT in bronze.columns else bronze


def header_drift(spark: SparkSession, path: str, name: str, schema: T.StructType | None = None,
                 multiline: bool | None = None) -> DataFrame:
    """Schema drift of a raw CSV source against its declared columns (from the header)."""
    from ..operators.incremental import schema_drift

    declared = schema or RAW_SCHEMAS[name]
    ml = name in MULTILINE_TABLES if multiline is None else multiline
    actual = T.StructType([T.StructField(c, T.StringType(), True) for c in raw_header(spark, path, ml)])
    return schema_drift(spark, declared, actual)


def new_batch() -> tuple[str, datetime]:
    """One batch id and one ingestion timestamp per run (shared by all data sets)."""
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    return f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}", now


def stamp_batch(df: DataFrame, batch_id: str, ingestion_ts: datetime) -> DataFrame:
    """Add batch metadata: the same ``batch_id`` and ``ingestion_ts`` for every row of a run."""
    return df.withColumn("batch_id", F.lit(batch_id)).withColumn(
        "ingestion_ts", F.lit(ingestion_ts).cast("timestamp")
    )


def append_bronze(df: DataFrame, path: str) -> None:
    """Append-only Bronze write (one folder per data set, Parquet)."""
    df.write.mode("append").parquet(path)


def ingest_batch(spark: SparkSession, sources: dict[str, str], bronze_root: str,
                 batch: tuple[str, datetime] | None = None, check_schema: bool = True,
                 multiline: Collection[str] = MULTILINE_TABLES) -> tuple[str, datetime]:
    """Append one run's raw CSV files to Bronze: same batch id and ingestion time for all data sets.

    With ``check_schema`` every source's header is compared with its declared
    columns first; a breaking change (a declared column missing) fails the run
    before anything is appended. Added columns are compatible (not kept).
    ``multiline`` names the data sets whose quoted values may hold line breaks.
    """
    if check_schema:
        from ..operators.incremental import assert_compatible

        for name, path in sources.items():
            assert_compatible(header_drift(spark, path, name, multiline=name in multiline))
    batch_id, ts = batch or new_batch()
    from concurrent.futures import ThreadPoolExecutor

    def append(name: str, path: str) -> None:
        raw = read_raw(spark, path, name, multiline=name in multiline)
        append_bronze(stamp_batch(raw, batch_id, ts), os.path.join(bronze_root, name))

    # independent data sets: submitted as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=4) as pool:
        for f in [pool.submit(append, name, path) for name, path in sources.items()]:
            f.result()
    return batch_id, ts


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, layer, name))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      max_records_per_file: int = 5_000_000, dynamic: bool = True, placed: bool = False) -> None:
    """Hive-partitioned Parquet write.

    ``rebalance`` (AQE) clusters rows by the partition columns so each
    partition is written by few tasks (no small-file explosion), and splits a
    skewed partition value across several tasks instead of one.
    ``partitionOverwriteMode=dynamic`` replaces only the partitions present
    in ``df``; static mode (``dynamic=False``) replaces the whole table.
    ``placed``: the rows stay where they lie (few partition values, or few tasks).
    """
    mode = "dynamic" if dynamic else "static"
    (
        (df if placed else df.hint("rebalance", *partition_cols))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", CODEC)
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, path: str, table: str, cols: Sequence[str], buckets: int, placed: bool = False) -> DataFrame:
    """Write ``df`` bucketed (and sorted) by ``cols`` as an external catalog table; return the table.

    Tables bucketed by the same key into the same number of buckets join and
    aggregate on that key without a shuffle. The preceding ``repartition``
    uses the same hash as bucketing, so every task writes exactly one bucket
    file (no buckets x tasks small files). ``placed``: the rows were dealt out
    by it already.
    """
    (
        (df if placed else df.repartition(buckets, *cols))
        .write.mode("overwrite").format("parquet").option("path", path).option("compression", CODEC)
        .bucketBy(buckets, *cols).sortBy(*cols)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)
