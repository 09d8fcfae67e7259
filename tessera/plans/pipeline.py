"""Pipeline plans: Silver -> Gold star, publish with a DQ gate, row counts."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import star as K
from ..sources.schemas import MULTILINE_TABLES
from .lazy import LazyTables

GOLD_TABLES = ("dim_customer", "dim_seller", "dim_product", "dim_date", "fact_order_item", "fact_payment", "fact_review")


def build_star(silver, dealt: bool = False, products: DataFrame | None = None) -> LazyTables:
    """Gold tables from Silver tables, each defined on first access (nothing runs until an action).

    ``dealt``: the Silver tables about orders are bucketed by order_id; then ``products`` can be those of
    ``star.products_of_orders`` in the same buckets.
    """
    g: LazyTables

    def b(fn):
        return lambda: fn()

    g = LazyTables({
        "dim_customer": b(lambda: K.dim_customer(silver["customers"])),
        "dim_seller": b(lambda: K.dim_seller(silver["sellers"])),
        "dim_product": b(lambda: K.dim_product(silver["products"])),
        "dim_date": b(lambda: K.dim_date(silver["orders"], silver["order_reviews"])),
        "fact_order_item": b(lambda: K.fact_order_item(
            silver["orders"], silver["order_items"], g["dim_customer"], g["dim_seller"], g["dim_product"], products)),
        "fact_payment": b(lambda: K.fact_payment(silver["order_payments"], silver["orders"], g["dim_customer"])),
        "fact_review": b(lambda: K.fact_review(
            silver["order_reviews"], silver["orders"], silver["order_items"], g["dim_customer"], g["dim_product"], dealt,
            products)),
    })
    return g


def driver_star(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The Gold star over the benchmark tables, defined once per session and state of the folder's files."""
    from ..sources.driver_tables import cached, silver_tables

    return cached("star", spark, sf_dir, lambda: build_star(silver_tables(spark, sf_dir)))


def row_count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table, as one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def silver_from_bronze(spark: SparkSession, bronze_root: str, taxonomy: DataFrame, geolocation: bool = False) -> LazyTables:
    """Silver tables (latest ingestion wins) from Bronze folders written by ``sources.io.ingest_batch``.

    ``geolocation`` tells whether that (optional) data set was ingested.
    """
    import os

    from ..operators import silver as S
    from ..sources.io import well_formed

    def bronze(name: str) -> DataFrame:
        return well_formed(spark.read.parquet(os.path.join(bronze_root, name)))

    extra = {"geolocation": lambda: S.silver_geolocation(bronze("geolocation"))} if geolocation else {}
    return LazyTables(extra | {
        "customers": lambda: S.silver_customers(bronze("customers")),
        "sellers": lambda: S.silver_sellers(bronze("sellers")),
        "products": lambda: S.silver_products(bronze("products"), taxonomy),
        "orders": lambda: S.silver_orders(bronze("orders")),
        "order_items": lambda: S.silver_order_items(bronze("order_items")),
        "order_payments": lambda: S.silver_order_payments(bronze("order_payments")),
        "order_reviews": lambda: S.silver_order_reviews(bronze("order_reviews")),
    })


def csv_pipeline(spark: SparkSession, sources: dict[str, str], taxonomy_csv: str | None, lake_root: str,
                 as_of=None, run_id: str | None = None, order_buckets: int | None = None,
                 max_unresolved_pct: float | None = 5.0, accepted_batches: Sequence[str] = (),
                 multiline: Collection[str] = MULTILINE_TABLES) -> DataFrame:
    """Raw CSV files -> Bronze (append, one batch) -> Silver -> Gold, published behind the DQ gate.

    ``sources`` maps data-set names (customers, orders, order_items,
    order_payments, order_reviews, products, sellers, geolocation) to CSV
    files or folders. ``taxonomy_csv=None`` uses the marketplace taxonomy
    shipped in ``sources.taxonomy_data``. Freshness is checked on every feed's
    ingestion time; lines that do not parse stay in Bronze, and such lines
    (but for those of ``accepted_batches``), values that do not convert, or more
    than ``max_unresolved_pct`` percent of unresolved foreign keys stop the
    publication. ``multiline`` names the data sets whose quoted values may hold
    line breaks (such a file is read by one task). Returns the
    stored DQ report; raises QualityGateError (nothing published) when a
    check fails.
    """
    import os

    from ..operators.taxonomy import load_taxonomy
    from ..sources.io import ingest_batch
    from .publish import bronze_checks, publish_gold

    bronze_root = os.path.join(lake_root, "bronze")
    ingest_batch(spark, sources, bronze_root, multiline=multiline)
    if taxonomy_csv is None:
        from ..sources.taxonomy_data import marketplace_taxonomy

        taxonomy = marketplace_taxonomy(spark)
    else:
        taxonomy = load_taxonomy(spark, taxonomy_csv)
    silver = silver_from_bronze(spark, bronze_root, taxonomy, geolocation="geolocation" in sources)
    bronze = {name: spark.read.parquet(os.path.join(bronze_root, name)) for name in sources}
    checks = bronze_checks(bronze, as_of if as_of is not None else F.current_timestamp(), accepted_batches)
    fresh = spark.read.parquet(os.path.join(bronze_root, "customers"))
    return publish_gold(spark, silver, lake_root, fresh, "ingestion_ts", as_of, run_id, order_buckets,
                        max_unresolved_pct, checks)
