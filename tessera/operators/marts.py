"""Summary marts at user-facing grains.

The grains and the columns named by the validation contract are kept
(sales: order item; delivery: order; customer: customer_unique_id; product:
(product_id, product_category_name); seller: (seller_id, seller_city,
seller_state)). The measures of the customer, product and seller marts are
our choice: orders, units, value and lateness.

Every mart is a join of pre-aggregated sides: order-level totals are
aggregated before they are joined to item rows, so no item row is
multiplied by payments. An item whose customer, product or seller is unknown
counts towards the member without those attributes (its id kept, where it has
one): the marts' revenue is the items' revenue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_late


def order_payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("total_payment_value"))


def mart_sales(order_items: DataFrame, payments: DataFrame) -> DataFrame:
    """Grain (order_id, order_item_id); the order's payment total repeated on each item row."""
    return order_items.select("order_id", "order_item_id", "product_id", "seller_id", "item_price", "freight_cost").join(
        order_payment_totals(payments), "order_id", "left"
    )


def order_deliveries(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Order-level delivery time: the order's own, else its last item delivery."""
    if "delivered_at" in order_items.columns:
        last = order_items.groupBy("order_id").agg(F.max("delivered_at").alias("_item_delivered"))
        o = orders.join(last, "order_id", "left").withColumn(
            "delivered_at", F.coalesce(F.col("delivered_at"), F.col("_item_delivered"))
        ).drop("_item_delivered")
        return o
    return orders


def mart_delivery_performance(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Grain order_id: status, on-time flag (NULL while undelivered), delay in days."""
    o = order_deliveries(orders, order_items)
    delivered = F.col("delivered_at").isNotNull() & F.col("est_delivery_date").isNotNull()
    return o.select(
        "order_id", "order_status", "delivered_at", "est_delivery_date",
        F.when(delivered, ~is_late(F.col("delivered_at"), F.col("est_delivery_date"))).alias("delivered_on_time"),
        F.when(delivered, F.datediff(F.to_date("delivered_at"), F.to_date("est_delivery_date"))).alias("delivery_delay_days"),
    )


def _item_facts(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    o = order_deliveries(orders, order_items).select(
        "order_id", "customer_id", F.col("delivered_at").alias("_order_delivered"), "est_delivery_date", "purchased_at"
    )
    delivered = F.col("delivered_at") if "delivered_at" in order_items.columns else F.lit(None).cast("timestamp_ntz")
    items = order_items.select("order_id", "product_id", "seller_id", "item_price", "freight_cost", delivered.alias("_item_delivered"))
    return items.join(o, "order_id", "left").withColumn(
        "_delivered", F.coalesce(F.col("_item_delivered"), F.col("_order_delivered"))
    )


def _measures():
    late = F.col("_delivered").isNotNull() & F.col("est_delivery_date").isNotNull() & is_late(
        F.col("_delivered"), F.col("est_delivery_date"))
    return [
        F.count_distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("units"),
        F.sum("item_price").cast("double").alias("item_revenue"),
        F.sum("freight_cost").cast("double").alias("freight_cost"),
        F.count_if(F.col("_delivered").isNotNull() & F.col("est_delivery_date").isNotNull()).alias("delivered_items"),
        F.count_if(late).alias("late_items"),
    ]


def mart_customer_summary(customers: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Grain customer_unique_id: orders, units, revenue, first/last purchase, lateness."""
    f = _item_facts(order_items, orders).join(customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
    return f.groupBy("customer_unique_id").agg(
        *_measures(), F.min("purchased_at").alias("first_purchase_at"), F.max("purchased_at").alias("last_purchase_at")
    )


def mart_product_performance(products: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Grain (product_id, product_category_name): sales volume, value and lateness."""
    f = _item_facts(order_items, orders).join(products.select("product_id", "product_category_name"), "product_id", "left")
    return f.groupBy("product_id", "product_category_name").agg(*_measures())


def mart_seller_performance(sellers: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Grain (seller_id, seller_city, seller_state): sales volume, value and lateness."""
    f = _item_facts(order_items, orders).join(
        sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "left"
    )
    return f.groupBy("seller_id", "seller_city", "seller_state").agg(*_measures())
