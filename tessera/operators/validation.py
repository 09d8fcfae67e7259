"""Layer validation reports (Silver tables, summary marts).

Each report is a long table (check_type, subject, value) assembled from
single-pass aggregates: row counts, duplicated key groups, orphan values,
NULL keys, delivery splits and money totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import orphan_summary
from .quality import union_all


def _row(df: DataFrame, check: str, subject: str, value) -> DataFrame:
    return df.select(F.lit(check).alias("check_type"), F.lit(subject).alias("subject"), value.cast("double").alias("value"))


def _rows(one: DataFrame, check: str, subjects: dict[str, str]) -> DataFrame:
    """Report rows of several columns (column -> subject) of a one-row aggregate, which is computed once."""
    return one.select(F.lit(check).alias("check_type"), F.inline(F.array(*(
        F.struct(F.lit(subject).alias("subject"), F.col(c).cast("double").alias("value")) for c, subject in subjects.items()))))


def row_count(df: DataFrame, subject: str) -> DataFrame:
    return _row(df.agg(F.count(F.lit(1)).alias("n")), "row_count", subject, F.col("n"))


def duplicate_groups(df: DataFrame, keys: Sequence[str], subject: str) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _row(counts.agg(F.count_if(F.col("_n") > 1).alias("d")), "duplicate_key_groups", subject, F.col("d"))


def null_keys(df: DataFrame, cols: Sequence[str], table: str) -> DataFrame:
    one = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    return _rows(one, "null_key_rows", {c: f"{table}.{c}" for c in cols})


def silver_validation(silver, relations) -> DataFrame:
    """Row counts, duplicate keys and orphan values of the Silver layer."""
    keys = {
        "customers": ["customer_id"], "products": ["product_id"], "sellers": ["seller_id"], "orders": ["order_id"],
        "order_items": ["order_id", "order_item_id"], "order_payments": ["order_id", "payment_sequential"],
    }
    parts = [row_count(silver[n], n) for n in silver]
    parts += [duplicate_groups(silver[n], k, f"{n}({', '.join(k)})") for n, k in keys.items()]
    for name, child, cc, parent, pc in relations:
        s = orphan_summary(child, cc, parent, pc, name)
        parts.append(_row(s, "orphan_values", name, F.col("orphan_values")))
    return union_all(parts)


MART_GRAINS = {
    "mart_sales": ["order_id", "order_item_id"],
    "mart_delivery_performance": ["order_id"],
    "mart_customer_summary": ["customer_unique_id"],
    "mart_product_performance": ["product_id", "product_category_name"],
    "mart_seller_performance": ["seller_id", "seller_city", "seller_state"],
}
MART_KEYS = {
    "mart_sales": ["order_id", "order_item_id", "product_id", "seller_id"],
    "mart_delivery_performance": ["order_id"],
    "mart_customer_summary": ["customer_unique_id"],
    "mart_product_performance": ["product_id"],
    "mart_seller_performance": ["seller_id"],
}


def mart_validation(marts: dict[str, DataFrame]) -> DataFrame:
    """Row counts, grain checks, NULL keys, delivery splits and money totals of the marts."""
    parts = [row_count(df, n) for n, df in marts.items()]
    parts += [duplicate_groups(marts[n], g, n) for n, g in MART_GRAINS.items()]
    parts += [null_keys(marts[n], k, n) for n, k in MART_KEYS.items()]
    d = marts["mart_delivery_performance"]
    split = d.agg(
        F.count_if(F.col("delivered_on_time")).alias("on_time"),
        F.count_if(~F.col("delivered_on_time")).alias("late"),
        F.count_if(F.col("delivered_on_time").isNull()).alias("undelivered"),
        F.count_if(F.col("delivery_delay_days") > 0).alias("delayed"),
    )
    parts.append(_rows(split, "delivery_split", {c: c for c in ("on_time", "late", "undelivered", "delayed")}))
    s = marts["mart_sales"]
    money = s.agg(F.sum("item_price").alias("item_price"), F.sum("freight_cost").alias("freight_cost"))
    parts.append(_rows(money, "money_total", {c: c for c in ("item_price", "freight_cost")}))
    # the order-level payment total repeats on every item row: count it once per order
    pay = s.groupBy("order_id").agg(F.max("total_payment_value").alias("t")).agg(F.sum("t").alias("t"))
    parts.append(_row(pay, "money_total", "total_payment_value", F.col("t")))
    return union_all(parts)
