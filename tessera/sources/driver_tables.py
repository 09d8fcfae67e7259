"""Mapping of the benchmark's TPC-H-like Parquet tables onto the marketplace model.

Each function returns a *raw* table with the marketplace column names (typed
as the Parquet source types them) so the same Silver operators run on it as on
CSV Bronze. Only columns are renamed and derived; no row is added, dropped or
sampled.

| model table    | source                 | mapping                                                        |
|----------------|------------------------|----------------------------------------------------------------|
| customers      | customer join nation   | customer_id=c_custkey, unique id=c_name, state=n_name          |
| sellers        | supplier join nation   | seller_id=s_suppkey, state=n_name                              |
| products       | part                   | product_id=p_partkey, category=p_type, name length=len(p_name) |
| orders         | orders                 | purchased_at=o_orderdate, estimate=o_orderdate + 30 days       |
| order_items    | lineitem               | item id=l_linenumber, delivered_at=l_shipdate (per item),      |
|                |                        | price=l_extendedprice, freight=l_extendedprice*l_tax           |
| order_payments | orders                 | one payment per order: sequential 1, value=o_totalprice        |
| order_reviews  | orders                 | review_id=o_orderkey, score=first character of priority        |

The (l_orderkey, l_linenumber) key repeats in lineitem: the Silver dedupe keeps
the latest delivery (l_shipdate), ties broken by every other column.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import silver as S
from ..operators.taxonomy import taxonomy_from_rows
from ..plans.lazy import LazyTables

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Category taxonomy for the driver's part types. PROMO is
# deliberately absent so the coverage rule has real failures.
DRIVER_TAXONOMY = (
    ("SMALL", "Small", "Sized"),
    ("MEDIUM", "Medium", "Sized"),
    ("LARGE", "Large", "Sized"),
    ("STANDARD", "Standard", "Core"),
    ("ECONOMY", "Economy", "Core"),
)

EST_DELIVERY_DAYS = 30
ITEM_LATEST_BY = ("delivered_at",)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _null(t: str):
    return F.lit(None).cast(t)


def raw_customers(spark, sf_dir) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        _null("string").alias("customer_zip_code_prefix"),
        _null("string").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def raw_sellers(spark, sf_dir) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("seller_id"),
        _null("string").alias("seller_zip_code_prefix"),
        _null("string").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def raw_products(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        *(_null("int").alias(c) for c in (
            "product_description_lenght", "product_photos_qty", "product_weight_g",
            "product_length_cm", "product_height_cm", "product_width_cm",
        )),
    )


def raw_orders(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("purchased_at"),
        _null("timestamp_ntz").alias("approved_at"),
        _null("timestamp_ntz").alias("carrier_handoff_at"),
        _null("timestamp_ntz").alias("delivered_at"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {EST_DELIVERY_DAYS} DAYS")).alias("est_delivery_date"),
    )


def raw_order_items(spark, sf_dir) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _null("timestamp_ntz").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("item_price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_cost"),
        F.col("l_shipdate").alias("delivered_at"),
    )


def raw_order_payments(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        _null("string").alias("payment_type"),
        _null("int").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )


def raw_order_reviews(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).alias("review_score"),
        _null("string").alias("review_comment_title"),
        _null("string").alias("review_comment_message"),
        F.col("o_orderdate").alias("review_creation_date"),
        _null("timestamp_ntz").alias("review_answer_timestamp"),
    )


def taxonomy(spark) -> DataFrame:
    return taxonomy_from_rows(spark, DRIVER_TAXONOMY)


def raw_taxonomy(spark) -> DataFrame:
    from ..sources.schemas import RAW_SCHEMAS

    return spark.createDataFrame(list(DRIVER_TAXONOMY), RAW_SCHEMAS["taxonomy"])


RAW = {
    "customers": raw_customers,
    "sellers": raw_sellers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
}


_CACHE: dict = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and modification times of a folder's entries and of the files of its table folders."""
    from .versions import Files

    files = Files(spark, sf_dir)
    return tuple(sorted(entry for name in files.names(sf_dir) for entry in files.state(os.path.join(sf_dir, name))))


def cached(kind: str, spark: SparkSession, sf_dir: str, make):
    """``make()``, made again when the session or the files of ``sf_dir`` have changed."""
    key = (kind, id(spark), spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    if key not in _CACHE:
        if len(_CACHE) > 16:
            _CACHE.clear()
        _CACHE[key] = make()
    return _CACHE[key]


def raw_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """Raw tables, each defined on first access; one definition per session and folder."""
    return cached("raw", spark, sf_dir, lambda: LazyTables(
        {name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in RAW.items()}))


def build_silver(spark: SparkSession, raw, order_buckets: int | None = None) -> LazyTables:
    """Silver tables of the driver mapping from (any version of) the raw tables.

    ``order_buckets``: the tables about orders are dealt out by order_id into so many partitions.
    """
    place = (order_buckets, "order_id") if order_buckets else None
    return LazyTables({
        "customers": lambda: S.silver_customers(raw["customers"]),
        "sellers": lambda: S.silver_sellers(raw["sellers"]),
        "products": lambda: S.silver_products(raw["products"], taxonomy(spark)),
        "orders": lambda: S.silver_orders(raw["orders"], place=place),
        "order_items": lambda: S.silver_order_items(raw["order_items"], latest_by=ITEM_LATEST_BY, place=place),
        "order_payments": lambda: S.silver_order_payments(raw["order_payments"], place=place),
        "order_reviews": lambda: S.silver_order_reviews(raw["order_reviews"], place=place),
    })


# lines of an order from which on it must not be one task's; source bytes of a bucket
HOT_LINES = 100_000
BUCKET_BYTES = 32 << 20


def order_buckets(spark: SparkSession, sf_dir: str, hot_lines: int = HOT_LINES) -> int | None:
    """Buckets to keep the tables about orders in, by the size of their source; None if an order is hot.

    A bucket holds all rows of its orders, so it suits orders of few raw lines
    (counted here, from their keys alone).
    """
    from .versions import Files

    lines = raw_tables(spark, sf_dir)["order_items"].groupBy("order_id").count()
    if not lines.where(F.col("count") > hot_lines).isEmpty():
        return None
    state = Files(spark, sf_dir).state(os.path.join(sf_dir, "lineitem.parquet"))
    return max(8, -(-sum(size for _, size, _ in state) // BUCKET_BYTES))


def silver_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    return cached("silver", spark, sf_dir, lambda: build_silver(spark, raw_tables(spark, sf_dir)))


# Freshness of the driver feeds is judged at a fixed instant so results are
# reproducible; production callers pass current_timestamp().
FRESHNESS_AS_OF = "2024-01-31 12:00:00"


def feed_times(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str]]:
    """(table, event-time column) of each time-stamped source feed."""
    return {
        "events": (read(spark, sf_dir, "events"), "ts"),
        "orders": (read(spark, sf_dir, "orders"), "o_orderdate"),
        "lineitem": (read(spark, sf_dir, "lineitem"), "l_shipdate"),
    }
