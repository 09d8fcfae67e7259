"""Session helpers.

Library code never creates a session: callers pass ``spark``. These helpers
exist for tests, the bench and the driver contract, and for reading shared
settings (the checkpoint folder) from a session that a cluster configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on. ANSI mode stays on (Spark 4 default): bad
# values are handled with try_* functions and counted by DQ rules instead.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session for tests and the bench (never used by operators)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        # catalog tables (bucketed Silver) of local runs live in a fresh folder, not the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tessera-warehouse-"))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_FALLBACK: dict = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the platform and only read here.
    Where it is unset (local tests), a fresh local folder is used for this
    session; the core setting itself cannot be changed at runtime, so it is
    left alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if id(spark) not in _FALLBACK:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _FALLBACK[id(spark)] = tempfile.mkdtemp(prefix="tessera-ckpt-")
    return _FALLBACK[id(spark)]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, shuffle files go as soon as the query that made them ends, not when the driver next collects garbage.

    For jobs that write table after table and read what was written: none of their
    queries is run twice. The session's own setting is restored at the end.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (consumers read the written rows, nothing is
    recomputed, a lost executor only re-reads files) and, unlike an eager
    ``checkpoint()``, computes the rows in a single job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
