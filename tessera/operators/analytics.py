"""Analytical queries over the Gold star (late deliveries, lag, MoM, anomalies, ranking).

Results are full DataFrames sorted for presentation; a caller that shows the
top rows adds ``limit`` (Spark then plans TakeOrderedAndProject). Sort keys
end with the grain columns so ties have one order.

Percentages and rounded ratios are computed exactly on integers (cents,
counts) with ``functions.columns.pct`` / ``ratio2``; money is summed as
decimal and reported as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.columns import is_late, pct, ratio2
from ..session import materialize
from .quantiles import exact_percentile

RECENT_DAYS = 90
MIN_GROUP_ITEMS = 5
P95_ACCURACY = 10_000  # Spark's default; only used by method="approx"


def _cents(c):
    return (c * 100).cast("long")


def late_delivery_rate(foi: DataFrame, dim_seller: DataFrame, dim_product: DataFrame,
                       recent_days: int = RECENT_DAYS, min_items: int = MIN_GROUP_ITEMS) -> DataFrame:
    """Late-delivery rate by seller x category family over the last ``recent_days``.

    The window is ``purchase date >= max purchase date - recent_days`` (both
    ends inclusive: recent_days + 1 calendar dates). The cutoff is a scalar
    subquery; the range is written on the raw timestamp so it reaches the scan,
    and ``purchase_year >= year(cutoff)`` prunes year partitions of a
    published fact.
    """
    # to_date is monotone, so max(to_date(t)) = to_date(max(t)): one conversion, not one per row
    cutoff = foi.select(F.date_sub(F.to_date(F.max("purchased_at")), recent_days)).scalar()
    recent = foi.where(
        (F.col("purchase_year") >= F.year(cutoff))
        & (F.col("purchased_at") >= cutoff.cast("timestamp_ntz"))
        & F.col("delivered_at").isNotNull()
        & F.col("est_delivery_date").isNotNull()
    ).select("seller_key", "product_key", is_late(F.col("delivered_at"), F.col("est_delivery_date")).alias("_late"))
    grouped = (
        recent.join(dim_seller.select("seller_key", "seller_id"), "seller_key")
        .join(dim_product.select("product_key", "category_family").where(F.col("category_family").isNotNull()), "product_key")
        .groupBy("seller_id", "category_family")
        .agg(F.count(F.lit(1)).alias("delivered_items"), F.count_if("_late").alias("late_items"))
        .where(F.col("delivered_items") >= min_items)
    )
    return grouped.select(
        "seller_id", "category_family", "delivered_items", "late_items",
        pct(F.col("late_items"), F.col("delivered_items")).alias("late_delivery_rate_pct"),
    ).orderBy(F.col("late_delivery_rate_pct").desc(), F.col("delivered_items").desc(), "seller_id", "category_family")


def delivery_lag_by_state(foi: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Average purchase->delivery calendar days per customer state (per item)."""
    lag = F.datediff(F.to_date("delivered_at"), F.to_date("purchased_at"))
    grouped = (
        foi.where(F.col("purchased_at").isNotNull() & F.col("delivered_at").isNotNull())
        .select("customer_key", lag.alias("_days"))
        .join(dim_customer.select("customer_key", "customer_state"), "customer_key")
        .groupBy("customer_state")
        .agg(F.sum("_days").alias("_sum"), F.count(F.lit(1)).alias("delivered_items"))
    )
    return grouped.select(
        "customer_state",
        ratio2(F.col("_sum"), F.col("delivered_items")).alias("average_purchase_to_delivery_days"),
        "delivered_items",
    ).orderBy(F.col("average_purchase_to_delivery_days").desc(), "customer_state")


def negative_review_mom(fact_review: DataFrame, strict_calendar: bool = False) -> DataFrame:
    """Month-over-month change of negative reviews (score <= 2) per category family.

    Distinct review ids are counted (a review fans out to every product of its
    order). "Previous month" is the previous month present for the family
    (LAG over rows); with ``strict_calendar`` it must be the calendar month
    before, otherwise the row has no previous value. Rows need previous > 0.
    The LAG runs on the monthly aggregate (months x families rows), not on
    review rows.
    """
    month = F.to_date(F.date_trunc("month", F.col("review_creation_date")))
    monthly = (
        fact_review.where(F.col("review_score").isNotNull() & F.col("category_family").isNotNull())
        .groupBy(month.alias("review_month"), "category_family")
        .agg(F.count_distinct(F.when(F.col("review_score") <= 2, F.col("review_id"))).alias("negative_reviews"))
    )
    w = Window.partitionBy("category_family").orderBy(F.col("review_month").asc_nulls_first())
    prev = F.lag("negative_reviews").over(w)
    if strict_calendar:
        prev_month = F.lag("review_month").over(w)
        prev = F.when(prev_month == F.add_months(F.col("review_month"), -1), prev)
    with_prev = monthly.withColumn("previous_month_negative_reviews", prev)
    change = F.col("negative_reviews") - F.col("previous_month_negative_reviews")
    return (
        with_prev.where(F.col("previous_month_negative_reviews") > 0)
        .select(
            "review_month", "category_family", "negative_reviews", "previous_month_negative_reviews",
            change.alias("absolute_change"),
            pct(change, F.col("previous_month_negative_reviews")).alias("mom_change_pct"),
        )
        .orderBy(F.col("mom_change_pct").desc(), "review_month", "category_family")
    )


def order_category_values(foi: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Value (item price + freight) per order x category family, in cents."""
    return (
        foi.select("order_id", "product_key", (F.col("item_price") + F.col("freight_cost")).alias("_v"))
        .join(dim_product.select("product_key", "category_family").where(F.col("category_family").isNotNull()), "product_key")
        .groupBy("order_id", "category_family")
        .agg(_cents(F.sum("_v")).alias("value_cents"))
    )


def order_value_anomalies(foi: DataFrame, dim_product: DataFrame, quantile: float = 0.95,
                          method: str = "exact", accuracy: int = P95_ACCURACY) -> DataFrame:
    """Order x family values strictly above the family's p95.

    ``method="exact"`` (default): the discrete percentile (value at rank
    ceil(0.95 n)) found inside the bracket of a sketch
    (``quantiles.exact_percentile``): exact at any scale.
    ``method="approx"``: ``percentile_approx`` with ``accuracy`` (a mergeable
    sketch; exact only while a family has fewer than about ``accuracy``
    values, and its memory grows with the accuracy).
    The p95 side has one row per family.
    """
    ocv = order_category_values(foi, dim_product)
    if method == "exact":
        # written once: the sketch, the count and the comparison below read the values
        ocv = materialize(ocv, "order-values")
        p95 = exact_percentile(ocv, ["category_family"], "value_cents", quantile, alias="p95_cents")
    else:
        p95 = ocv.groupBy("category_family").agg(
            F.percentile_approx("value_cents", quantile, accuracy).alias("p95_cents")
        )
    return (
        ocv.join(p95, "category_family")
        .where(F.col("value_cents") > F.col("p95_cents"))
        .select(
            "order_id", "category_family",
            (F.col("value_cents") / F.lit(100.0)).alias("order_category_value"),
            (F.col("p95_cents") / F.lit(100.0)).alias("category_p95_value"),
            ratio2(F.col("value_cents"), F.col("p95_cents")).alias("multiple_of_category_p95"),
        )
        .orderBy(F.col("multiple_of_category_p95").desc(), "order_id", "category_family")
    )


def category_value_ranking(foi: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Distinct orders, units, revenue, freight and total value per category family."""
    grouped = (
        foi.select("order_id", "product_key", "item_price", "freight_cost")
        .join(dim_product.select("product_key", "category_family").where(F.col("category_family").isNotNull()), "product_key")
        .groupBy("category_family")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count(F.lit(1)).alias("units_sold"),
            F.sum("item_price").alias("_rev"),
            F.sum("freight_cost").alias("_fr"),
            F.sum(F.col("item_price") + F.col("freight_cost")).alias("_tot"),
        )
    )
    return grouped.select(
        "category_family", "orders", "units_sold",
        F.col("_rev").cast("double").alias("item_revenue"),
        F.col("_fr").cast("double").alias("freight_cost"),
        F.col("_tot").cast("double").alias("total_value"),
    ).orderBy(F.col("total_value").desc(), "category_family")
