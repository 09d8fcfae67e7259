"""Gold star schema: four dimensions and three facts.

Dimensions take deduplicated Silver tables (one row per natural key) and add a
deterministic 64-bit surrogate key. Facts resolve natural keys to surrogate
keys with left joins, so an unresolved key stays visible as NULL. Join
strategy is left to Catalyst/AQE: small dimensions are broadcast because their
measured size is under the broadcast threshold, large ones are sort-merge
joined, and AQE splits skewed join partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_key, surrogate_key

ORDER_CONTEXT = ("customer_id", "order_status", "purchased_at", "approved_at", "carrier_handoff_at", "delivered_at", "est_delivery_date")

FACT_ORDER_ITEM_COLUMNS = (
    "order_id", "order_item_id", "customer_key", "seller_key", "product_key", "purchase_date_key",
    "purchase_year", "seller_state", "order_status", "purchased_at", "approved_at", "carrier_handoff_at",
    "delivered_at", "est_delivery_date", "shipping_limit_date", "item_price", "freight_cost",
)
FACT_PAYMENT_COLUMNS = (
    "order_id", "payment_sequential", "customer_key", "payment_date_key", "payment_year", "payment_type",
    "payment_installments", "payment_value",
)
FACT_REVIEW_COLUMNS = (
    "review_id", "order_id", "customer_key", "product_key", "review_date_key", "review_year", "review_score",
    "review_creation_date", "review_answer_timestamp", "normalized_category", "category_family",
)
PARTITIONS = {
    "fact_order_item": ("purchase_year", "seller_state"),
    "fact_payment": ("payment_year",),
    "fact_review": ("review_year",),
}
BY_YEAR = ("fact_payment", "fact_review")  # so few folders that every task may write into all of them


def add_surrogate_key(df: DataFrame, natural_key: str, key: str) -> DataFrame:
    return df.withColumn(key, surrogate_key(F.col(natural_key)))


def dim_customer(customers: DataFrame) -> DataFrame:
    return add_surrogate_key(customers, "customer_id", "customer_key").select(
        "customer_key", "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return add_surrogate_key(sellers, "seller_id", "seller_key").select(
        "seller_key", "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"
    )


def dim_product(products: DataFrame) -> DataFrame:
    cols = [c for c in products.columns]
    return add_surrogate_key(products, "product_id", "product_key").select("product_key", *cols)


def dim_date(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Calendar rows for every date seen in purchases or review creations."""
    dates = (
        orders.select(F.to_date("purchased_at").alias("date"))
        .unionByName(reviews.select(F.to_date("review_creation_date").alias("date")))
        .where(F.col("date").isNotNull())
        .distinct()
    )
    d = F.col("date")
    return dates.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
    )


def _order_context(orders: DataFrame, lines: DataFrame, wanted: Sequence[str], more: Sequence[str] = ()) -> tuple[DataFrame, list]:
    """Order columns for a line-level table (and columns ``more`` as they are); a column the lines carry themselves wins."""
    cols = [c for c in wanted if c in orders.columns]
    ctx = orders.select("order_id", *more, *(F.col(c).alias(f"_o_{c}") for c in cols))
    resolved = [
        (F.coalesce(F.col(c), F.col(f"_o_{c}")) if c in lines.columns else F.col(f"_o_{c}")).alias(c) for c in cols
    ]
    return ctx, resolved


def keyed_orders(orders: DataFrame, dim_cust: DataFrame, parts: int) -> DataFrame:
    """Orders that lie by order_id in so many ``parts``, with their ``customer_key``: ids alone travel to the customers and back."""
    keys = with_customer_key(orders.select("order_id", "customer_id"), dim_cust).select("order_id", "customer_key")
    return orders.join(keys.repartition(parts, "order_id"), "order_id", "left")


def with_customer_key(orders: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Orders with their ``customer_key``."""
    return orders.join(dim_cust.select("customer_key", "customer_id"), "customer_id", "left").select(*orders.columns, "customer_key")


def _customer_of_orders(orders: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """(order_id, customer_key): resolved where an order is one narrow row, not once for each of its lines."""
    if "customer_key" in orders.columns:
        return orders.select("order_id", "customer_key")
    return orders.select("order_id", "customer_id").join(
        dim_cust.select("customer_key", "customer_id"), "customer_id", "left").select("order_id", "customer_key")


def _with_customer(lines: DataFrame, orders: DataFrame, dim_cust: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Lines with their order's columns ``wanted`` and ``customer_key``.

    Lines that name a customer themselves are resolved one by one, as their
    value wins over the order's.
    """
    keep = [c for c in lines.columns if c not in wanted]
    if "customer_id" in lines.columns or "customer_id" not in orders.columns:
        ctx, resolved = _order_context(orders, lines, wanted)
        return lines.join(ctx, "order_id", "left").select(*keep, *resolved).join(
            dim_cust.select("customer_key", "customer_id"), "customer_id", "left")
    cols = [c for c in ("order_id", *wanted) if c in orders.columns]
    known = (orders.select(*cols, "customer_key") if "customer_key" in orders.columns
             else with_customer_key(orders.select(*cols), dim_cust))
    ctx, resolved = _order_context(known, lines, [c for c in wanted if c != "customer_id"], ("customer_key",))
    return lines.join(ctx, "order_id", "left").select(*keep, "customer_key", *resolved)


def fact_order_item(orders, order_items, dim_cust, dim_sell, dim_prod, products: DataFrame | None = None) -> DataFrame:
    """Grain (order_id, order_item_id); partitioned by (purchase_year, seller_state).

    ``products``: from ``products_of_orders``; whole lines then stay where their order lies.
    """
    lines = _with_customer(order_items, orders, dim_cust, ORDER_CONTEXT)
    if products is None:
        lines = lines.join(dim_prod.select("product_key", "product_id"), "product_id", "left")
    else:
        placed = lines.where(F.col("order_id").isNotNull()).join(products, "order_id", "left").select(
            *lines.columns, F.col("_products")[F.col("product_id")]["product_key"].alias("product_key"))
        loose = lines.where(F.col("order_id").isNull()).join(dim_prod.select("product_key", "product_id"), "product_id", "left")
        lines = placed.unionByName(loose)
    out = (
        lines.join(dim_sell.select("seller_key", "seller_id", "seller_state"), "seller_id", "left")
        .withColumn("purchase_date_key", date_key(F.col("purchased_at")))
        .withColumn("purchase_year", F.year("purchased_at"))
    )
    return out.select(*FACT_ORDER_ITEM_COLUMNS)


def fact_payment(payments, orders, dim_cust) -> DataFrame:
    """Grain (order_id, payment_sequential); the date is the order's purchase date."""
    out = (
        _with_customer(payments, orders, dim_cust, ("customer_id", "purchased_at"))
        .withColumn("payment_date_key", date_key(F.col("purchased_at")))
        .withColumn("payment_year", F.year("purchased_at"))
    )
    return out.select(*FACT_PAYMENT_COLUMNS)


def _resolved_products(ids: DataFrame, dim_prod: DataFrame) -> DataFrame:
    return ids.join(dim_prod.select("product_id", "product_key", "normalized_category", "category_family"), "product_id", "left")


def products_of_orders(order_items: DataFrame, dim_prod: DataFrame, parts: int) -> DataFrame:
    """An order's products: (order_id, ``_products``: id -> key and categories, ``_unnamed``: whether a line names none).

    For items that lie by order_id in so many ``parts``, none of them with very
    many lines; so does the result. Only ids travel to the products and back,
    once for all facts. Items without an order are left out.
    """
    ids = order_items.where(F.col("order_id").isNotNull()).select("order_id", "product_id").distinct()
    entry = F.struct("product_id", F.struct("product_key", "normalized_category", "category_family"))
    return _resolved_products(ids, dim_prod).repartition(parts, "order_id").groupBy("order_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("product_id").isNotNull(), entry))).alias("_products"),
        F.max(F.col("product_id").isNull()).alias("_unnamed"))


def order_products(order_items: DataFrame, dim_prod: DataFrame, dealt: bool = False, products: DataFrame | None = None) -> DataFrame:
    """Distinct (order_id, product_key) with the product's category columns (``dealt``: a set of them per order).

    Resolving product ids to keys before the distinct makes the review fan-out
    unique on (review_id, order_id, product_key) by construction, so the fact
    needs no second dedupe shuffle. Lines are dealt out by order_id alone, as
    the join to the reviews needs them, so the distinct adds no shuffle of its own.
    ``products`` (from ``products_of_orders``) lie so already.

    ``dealt``: the items are bucketed by order_id and no order has very many. An
    order's products are then one set, gathered where the items lie.
    """
    if products is not None:
        all_of = F.map_values("_products")
        with_none = F.concat(all_of, F.array(F.lit(None)))
        return products.select("order_id", F.explode(F.when(F.col("_unnamed"), with_none).otherwise(all_of)).alias("_product")).select(
            "order_id", "_product.*").distinct()
    lines = _resolved_products(order_items.select("order_id", "product_id"), dim_prod).select(
        "order_id", "product_key", "normalized_category", "category_family")
    if not dealt:
        return lines.repartition("order_id").distinct()
    product = F.struct("product_key", "normalized_category", "category_family")
    return lines.groupBy("order_id").agg(F.collect_set(product).alias("_products"))


def fact_review(reviews, orders, order_items, dim_cust, dim_prod, dealt: bool = False, products: DataFrame | None = None) -> DataFrame:
    """One row per review x distinct product of its order (orders without items: one row, NULL product).

    The two order_id joins run back to back so both reuse one hash partitioning
    of the reviews on order_id.
    """
    out = reviews.join(_customer_of_orders(orders, dim_cust), "order_id", "left").join(
        order_products(order_items, dim_prod, dealt, products), "order_id", "left")
    if dealt and products is None:
        out = out.select("*", F.explode_outer("_products").alias("_product")).select(
            *(c for c in out.columns if c != "_products"), "_product.*")
    out = (
        out.withColumn("review_date_key", date_key(F.col("review_creation_date")))
        .withColumn("review_year", F.year("review_creation_date"))
    )
    return out.select(*FACT_REVIEW_COLUMNS)
