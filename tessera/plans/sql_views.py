"""SQL surface: Gold tables as temp views plus the five analyses as Spark SQL.

For users who query the star with ``spark.sql``. The statements are ours and
follow the DataFrame operators in ``operators.analytics`` (same semantics:
inclusive 90-day window on the raw timestamp, distinct review ids, LAG over
present months, exact discrete p95, exact HALF_UP rounding, total orders on
ties). Each entry is one statement; nothing is parsed here. Note: SQL
``percentile_disc`` buffers the values of a group in one aggregate; for very
large groups use ``operators.analytics.order_value_anomalies``, whose exact
p95 works on range segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.io import register_views


def _pct(a: str, b: str, scale: int = 100) -> str:
    x = f"(abs(CAST({a} AS DECIMAL(38,0))) * {200 * scale} + CAST({b} AS DECIMAL(38,0)))"
    y = f"(CAST({b} AS DECIMAL(38,0)) * 2)"
    return (f"CASE WHEN {b} > 0 THEN CAST((CASE WHEN {a} < 0 THEN -1 ELSE 1 END) * "
            f"CAST(({x} - {x} % {y}) / {y} AS BIGINT) AS DOUBLE) / 100.0D END")


ANALYSIS_SQL = {
    "late_delivery_rate": f"""
        WITH cutoff AS (SELECT date_sub(max(to_date(purchased_at)), 90) AS d FROM fact_order_item),
        recent AS (
          SELECT f.seller_key, f.product_key, f.delivered_at > f.est_delivery_date AS late
          FROM fact_order_item f
          WHERE f.purchase_year >= year((SELECT d FROM cutoff))
            AND f.purchased_at >= CAST((SELECT d FROM cutoff) AS TIMESTAMP_NTZ)
            AND f.delivered_at IS NOT NULL AND f.est_delivery_date IS NOT NULL)
        SELECT seller_id, category_family, delivered_items, late_items,
               {_pct('late_items', 'delivered_items')} AS late_delivery_rate_pct
        FROM (
          SELECT s.seller_id, p.category_family, count(*) AS delivered_items, count_if(r.late) AS late_items
          FROM recent r JOIN dim_seller s ON r.seller_key = s.seller_key
          JOIN dim_product p ON r.product_key = p.product_key
          WHERE p.category_family IS NOT NULL
          GROUP BY s.seller_id, p.category_family
          HAVING count(*) >= 5) g
        ORDER BY late_delivery_rate_pct DESC, delivered_items DESC, seller_id, category_family""",
    "delivery_lag_by_state": f"""
        SELECT customer_state, {_pct('s', 'delivered_items', 1)} AS average_purchase_to_delivery_days, delivered_items
        FROM (
          SELECT c.customer_state, sum(datediff(to_date(f.delivered_at), to_date(f.purchased_at))) AS s,
                 count(*) AS delivered_items
          FROM fact_order_item f JOIN dim_customer c ON f.customer_key = c.customer_key
          WHERE f.purchased_at IS NOT NULL AND f.delivered_at IS NOT NULL
          GROUP BY c.customer_state) g
        ORDER BY average_purchase_to_delivery_days DESC, customer_state""",
    "negative_review_mom": f"""
        WITH monthly AS (
          SELECT to_date(date_trunc('month', review_creation_date)) AS review_month, category_family,
                 count(DISTINCT CASE WHEN review_score <= 2 THEN review_id END) AS negative_reviews
          FROM fact_review
          WHERE review_score IS NOT NULL AND category_family IS NOT NULL
          GROUP BY 1, 2),
        prev AS (
          SELECT *, lag(negative_reviews) OVER (PARTITION BY category_family ORDER BY review_month)
                    AS previous_month_negative_reviews
          FROM monthly)
        SELECT review_month, category_family, negative_reviews, previous_month_negative_reviews,
               negative_reviews - previous_month_negative_reviews AS absolute_change,
               {_pct('(negative_reviews - previous_month_negative_reviews)', 'previous_month_negative_reviews')}
                 AS mom_change_pct
        FROM prev WHERE previous_month_negative_reviews > 0
        ORDER BY mom_change_pct DESC, review_month, category_family""",
    "order_value_anomalies": f"""
        WITH ocv AS (
          SELECT f.order_id, p.category_family, CAST(sum(f.item_price + f.freight_cost) * 100 AS BIGINT) AS value_cents
          FROM fact_order_item f JOIN dim_product p ON f.product_key = p.product_key
          WHERE p.category_family IS NOT NULL
          GROUP BY f.order_id, p.category_family),
        p95 AS (SELECT category_family, CAST(percentile_disc(0.95) WITHIN GROUP (ORDER BY value_cents) AS BIGINT) AS p95_cents
                FROM ocv GROUP BY category_family)
        SELECT o.order_id, o.category_family, o.value_cents / 100.0D AS order_category_value,
               q.p95_cents / 100.0D AS category_p95_value, {_pct('o.value_cents', 'q.p95_cents', 1)} AS multiple_of_category_p95
        FROM ocv o JOIN p95 q ON o.category_family = q.category_family
        WHERE o.value_cents > q.p95_cents
        ORDER BY multiple_of_category_p95 DESC, order_id, category_family""",
    "category_value_ranking": """
        SELECT p.category_family, count(DISTINCT f.order_id) AS orders, count(*) AS units_sold,
               CAST(sum(f.item_price) AS DOUBLE) AS item_revenue, CAST(sum(f.freight_cost) AS DOUBLE) AS freight_cost,
               CAST(sum(f.item_price + f.freight_cost) AS DOUBLE) AS total_value
        FROM fact_order_item f JOIN dim_product p ON f.product_key = p.product_key
        WHERE p.category_family IS NOT NULL
        GROUP BY p.category_family
        ORDER BY total_value DESC, category_family""",
}


def register_gold_views(spark: SparkSession, gold) -> list[str]:
    """Register every Gold table (a dict or lazy map of DataFrames) as a temp view."""
    return register_views(spark, {name: gold[name] for name in gold})


def run_analysis(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(ANALYSIS_SQL[name])
