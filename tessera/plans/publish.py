"""Publish Gold behind the data-quality gate, and idempotency checks.

Order: write every table to a run-specific staging folder -> read back what
was written (this also cuts the lineage: checks do not recompute the build)
-> run the DQ suite on it and store the report -> publish by renaming a new
one-line pointer file into place. Readers resolve the last pointer, so a failed
run is never visible and a pointer is never missing or half-written.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import star as K
from ..operators.fingerprint import compare_fingerprints, fingerprints
from ..operators.star import PARTITIONS
from ..operators.violations import gold_violations
from ..sources.io import new_batch, write_bucketed, write_partitioned, write_table
from ..sources.versions import Files, Lake
from .lazy import LazyTables

POINTER = "_current"
SCHEMA_SUFFIX = "._schema"


def _bucket_table(folder: str, name: str) -> str:
    return "tessera_" + re.sub(r"[^0-9a-zA-Z]", "_", "_".join(folder.rstrip("/").split("/")[-2:]) + "_" + name)


def _stage_one(spark: SparkSession, name: str, df: DataFrame, folder: str, bucket=None, placed: Sequence[str] = ()) -> DataFrame:
    path = os.path.join(folder, name)
    if bucket is not None:
        cols, n, *lies = bucket
        return write_bucketed(df, path, _bucket_table(folder, name), cols, n, *lies).select(*df.columns)
    if name in PARTITIONS:
        write_partitioned(df, path, PARTITIONS[name], placed=name in placed)
        # keep the declared schema next to the table so readers need no inference
        spark.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(
            path + SCHEMA_SUFFIX)
    else:
        write_table(df, path)
    # read back with the declared schema: partition values are not type-inferred
    # from folder names (a state code "01" stays a string), and the declared
    # column order is restored (partition columns would come back last)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def stage_tables(spark: SparkSession, tables: dict[str, DataFrame], folder: str,
                 parallel: int = 4, buckets: dict | None = None, placed: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Write independent tables (facts partitioned) and return them read back.

    The writes are submitted as concurrent Spark jobs from driver threads, so
    small tables do not leave executors idle while a large one finishes.
    Partitioned tables among ``placed`` are written where their rows lie.
    """
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {name: pool.submit(_stage_one, spark, name, df, folder, (buckets or {}).get(name), placed)
                   for name, df in tables.items()}
        return {name: f.result() for name, f in futures.items()}


DIMENSIONS = ("dim_customer", "dim_seller", "dim_product", "dim_date")
FACTS = ("fact_order_item", "fact_payment", "fact_review")


ORDER_LEVEL = ("orders", "order_items", "order_payments", "order_reviews")


def stage_layers(spark: SparkSession, silver, folder: str, order_buckets: int | None = None,
                 placed: bool = False) -> dict[str, DataFrame]:
    """Materialise the medallion once per layer: Silver, then dimensions, then facts.

    Each layer is written and read back before the next is defined, so every
    table is computed exactly once (no lineage is recomputed by later
    tables or checks) and a lost executor only re-runs the current layer.

    ``order_buckets``: write the order-level Silver tables (orders, items,
    payments, reviews) bucketed by ``order_id`` into that many buckets. At
    scale, where ``orders`` cannot be broadcast, every fact then joins on
    ``order_id`` (and the review fan-out aggregates) without shuffling either
    side. Leave it unset where the tables are small enough to broadcast, and
    where a single order can hold a large share of the (deduplicated) items:
    a bucket keeps all rows of a key together and AQE cannot split a bucketed
    scan, whereas unbucketed sort-merge joins get AQE's skew splitting.
    ``placed``: these tables' rows were dealt out that way before their dedupe.
    """
    _, star = stage_dimensions(spark, silver, folder, order_buckets, placed)
    facts = stage_tables(spark, {n: star[n] for n in FACTS}, os.path.join(folder, "gold"),
                         placed=K.BY_YEAR if order_buckets else ())
    return {**{n: star[n] for n in DIMENSIONS}, **facts}


def stage_dimensions(spark: SparkSession, silver, folder: str, order_buckets: int | None = None,
                     placed: bool = False, products_aside: bool = False) -> tuple[dict[str, DataFrame], LazyTables]:
    """Silver and dimensions written and read back: (Silver, the star on them, its facts defined but not written).

    With ``order_buckets`` the orders are also kept with their customer's key,
    in the same buckets: one join to the customers serves all facts. So are,
    with ``products_aside``, the orders' products with their keys, unless these
    can be broadcast.
    """
    from .pipeline import build_star

    buckets = {n: (["order_id"], order_buckets, placed) for n in ORDER_LEVEL} if order_buckets else None
    written_silver = stage_tables(spark, dict(silver.items()), os.path.join(folder, "silver"), buckets=buckets)
    star = build_star(written_silver)
    dims = stage_tables(spark, {n: star[n] for n in DIMENSIONS}, os.path.join(folder, "gold"))
    fact_sources, keyed = written_silver, {}
    if order_buckets:
        keyed["orders_keyed"] = K.keyed_orders(written_silver["orders"], dims["dim_customer"], order_buckets)
        lake = Lake(spark, folder)
        if products_aside and lake.input_bytes(dims["dim_product"]) > lake.broadcast_limit():
            keyed["order_products"] = K.products_of_orders(written_silver["order_items"], dims["dim_product"], order_buckets)
        keyed = stage_tables(spark, keyed, os.path.join(folder, "gold"), buckets={n: (["order_id"], order_buckets, True) for n in keyed})
        fact_sources = {**written_silver, "orders": keyed["orders_keyed"]}
    star_on_dims = build_star(fact_sources, bool(order_buckets), keyed.get("order_products"))  # facts join the written dimensions
    for n, df in dims.items():
        star_on_dims.provide(n, df)
    return written_silver, star_on_dims


def unstage(spark: SparkSession, folder: str) -> None:
    """Delete what ``stage_layers`` or ``stage_dimensions`` wrote into a scratch folder."""
    for layer, names in (("silver", ORDER_LEVEL), ("gold", ("orders_keyed", "order_products"))):
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {_bucket_table(os.path.join(folder, layer), name)}")
    Files(spark, folder).delete(folder)


def publish_gold(spark: SparkSession, silver, root: str, fresh_df: DataFrame, fresh_ts: str,
                 as_of: Column | None = None, run_id: str | None = None,
                 order_buckets: int | None = None, max_unresolved_pct: float | None = None,
                 source_checks: DataFrame | None = None) -> DataFrame:
    """Stage Silver and Gold, check what was written, then publish.

    Two reports are stored with the run: the 16-check suite (returned) and
    the build checks: nine RI relations, key collisions, unresolved foreign
    keys (tolerated up to ``max_unresolved_pct``; None only reports them) and
    ``source_checks`` (result rows about the raw feeds, see ``bronze_checks``).
    Raises QualityGateError (and publishes nothing) when a check fails.
    """
    run_id = run_id or new_batch()[0]
    folder = os.path.join(root, "runs", run_id)
    written = stage_layers(spark, silver, folder, order_buckets)
    report = Q.dq_report(written, fresh_df, fresh_ts, as_of if as_of is not None else F.current_timestamp())
    report_path = os.path.join(folder, "_dq_report")
    write_table(report.coalesce(1), report_path)
    stored = spark.read.parquet(report_path)
    build = Q.build_checks(written, max_unresolved_pct)
    build = build if source_checks is None else build.unionByName(source_checks)
    build_path = os.path.join(folder, "_build_checks")
    write_table(build.coalesce(1), build_path)
    try:
        Q.assert_passed(stored.select("test_name", "rows_failed", "passed").unionByName(
            spark.read.parquet(build_path).select("test_name", "rows_failed", "passed")))
    except Q.QualityGateError:
        # a refused run keeps its tables, its reports and the rows that failed
        write_table(gold_violations(written, fresh_df, fresh_ts, as_of if as_of is not None else F.current_timestamp()),
                    os.path.join(folder, "_violations"))
        raise
    switch_pointer(spark, root, run_id)
    return stored


def switch_pointer(spark: SparkSession, root: str, run_id: str) -> None:
    """Name the published run in a new pointer file, renamed into place whole; the last file counts."""
    files = Files(spark, root)
    folder = os.path.join(root, POINTER)
    numbers = [int(n) for n in files.names(folder) if n.isdigit()]
    files.claim(os.path.join(folder, ".pointers"))  # the folder exists from here on
    files.write(os.path.join(folder, f"{max(numbers, default=0) + 1:08d}"), run_id)


def bronze_checks(bronze: dict[str, DataFrame], as_of: Column, accepted: Sequence[str] = ()) -> DataFrame:
    """Result rows about the raw feeds of a run.

    Per data set: lines in quarantine (they did not parse and never reach
    Silver) of any batch that is not among the ``accepted`` ones, rows whose
    current version holds a value that does not convert, and the age of the
    newest batch. So every run reports a quarantine until it is emptied or
    accepted.
    """
    from ..operators.silver import current_failed_casts
    from ..sources.io import well_formed
    from ..sources.schemas import SILVER_SPECS

    parts = []
    for name, raw in bronze.items():
        open_lines = raw.where(~F.col("batch_id").isin(list(accepted))) if accepted else raw
        parts.append(Q.malformed_rows_rule(open_lines, f"{name}: lines parse or are accepted"))
        parts.append(Q.result(current_failed_casts(well_formed(raw), SILVER_SPECS[name]), f"{name}: values convert",
                              None, "failed", "rows"))
        parts.append(Q.freshness_rule(raw, "ingestion_ts", as_of, f"{name}: ingestion is fresh"))
    return Q.union_all(parts)


def quarantine(bronze: dict[str, DataFrame]) -> DataFrame:
    """Lines that did not parse: (table_name, batch_id, line), for whoever repairs or accepts them."""
    from ..sources.io import CORRUPT

    return Q.union_all([raw.where(F.col(CORRUPT).isNotNull()).select(
        F.lit(name).alias("table_name"), "batch_id", F.col(CORRUPT).alias("line")) for name, raw in bronze.items()])


def current_run(spark: SparkSession, root: str) -> str:
    files = Files(spark, root)
    folder = os.path.join(root, POINTER)
    return files.read(os.path.join(folder, max(n for n in files.names(folder) if n.isdigit())))


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the published run (partitioned tables with their stored schema)."""
    from pyspark.sql.types import StructType

    path = os.path.join(root, "runs", current_run(spark, root), "gold", name)
    if name in PARTITIONS:
        schema = StructType.fromJson(json.loads(spark.read.text(path + SCHEMA_SUFFIX).first()[0]))
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return spark.read.parquet(path)


def idempotency_check(first: dict[str, DataFrame] | DataFrame, second: dict[str, DataFrame] | DataFrame) -> DataFrame:
    """Fingerprints of two builds of the same tables, compared per table (a build is its tables, or their fingerprints)."""
    return compare_fingerprints(*(b if isinstance(b, DataFrame) else fingerprints(b) for b in (first, second)))
