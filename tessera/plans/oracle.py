"""Independent DuckDB SQL for each catalog query (the correctness oracle).

The same Silver -> Gold chain is written once more as plain SQL common table
expressions over the benchmark views. Money is carried as integer cents and
rounded percentages use the integer basis-point formula, so both engines
produce identical values.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def pct_sql(a: str, b: str, scale: int = 100) -> str:
    """round(scale * a / b, 2), HALF_UP away from zero, exact on integers."""
    return (
        f"(CASE WHEN ({b}) > 0 THEN CAST((CASE WHEN ({a}) < 0 THEN -1 ELSE 1 END) * "
        f"((abs(CAST(({a}) AS HUGEINT)) * {200 * scale} + ({b})) // (2 * CAST(({b}) AS HUGEINT))) AS DOUBLE) / 100.0 END)"
    )


def cents_sql(x: str) -> str:
    return f"CAST(round(({x}) * 100.0) AS BIGINT)"


TAXONOMY_VALUES = (
    "(VALUES ('SMALL','Small','Sized'),('MEDIUM','Medium','Sized'),('LARGE','Large','Sized'),"
    "('STANDARD','Standard','Core'),('ECONOMY','Economy','Core')) AS t(source_category, normalized_category, category_family)"
)

_CTES = [
    ("raw_customers", """
        SELECT c.c_custkey AS customer_id, c.c_name AS customer_unique_id, CAST(NULL AS VARCHAR) AS customer_zip_code_prefix,
               CAST(NULL AS VARCHAR) AS customer_city, n.n_name AS customer_state
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    ("raw_sellers", """
        SELECT s.s_suppkey AS seller_id, CAST(NULL AS VARCHAR) AS seller_zip_code_prefix, CAST(NULL AS VARCHAR) AS seller_city,
               n.n_name AS seller_state
        FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    ("raw_products", """
        SELECT p_partkey AS product_id, p_type AS product_category_name, CAST(length(p_name) AS INTEGER) AS product_name_lenght,
               CAST(NULL AS INTEGER) AS product_description_lenght, CAST(NULL AS INTEGER) AS product_photos_qty,
               CAST(NULL AS INTEGER) AS product_weight_g, CAST(NULL AS INTEGER) AS product_length_cm,
               CAST(NULL AS INTEGER) AS product_height_cm, CAST(NULL AS INTEGER) AS product_width_cm
        FROM part"""),
    ("raw_orders", """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status, o_orderdate AS purchased_at,
               CAST(NULL AS TIMESTAMP) AS approved_at, CAST(NULL AS TIMESTAMP) AS carrier_handoff_at,
               CAST(NULL AS TIMESTAMP) AS delivered_at, o_orderdate + INTERVAL 30 DAY AS est_delivery_date
        FROM orders"""),
    ("raw_order_items", """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
               CAST(NULL AS TIMESTAMP) AS shipping_limit_date, l_extendedprice AS item_price,
               l_extendedprice * l_tax AS freight_cost, l_shipdate AS delivered_at
        FROM lineitem"""),
    ("raw_order_payments", """
        SELECT o_orderkey AS order_id, 1 AS payment_sequential, CAST(NULL AS VARCHAR) AS payment_type,
               CAST(NULL AS INTEGER) AS payment_installments, o_totalprice AS payment_value
        FROM orders"""),
    ("raw_order_reviews", """
        SELECT o_orderkey AS review_id, o_orderkey AS order_id, substr(o_orderpriority, 1, 1) AS review_score,
               CAST(NULL AS VARCHAR) AS review_comment_title, CAST(NULL AS VARCHAR) AS review_comment_message,
               o_orderdate AS review_creation_date, CAST(NULL AS TIMESTAMP) AS review_answer_timestamp
        FROM orders"""),
    ("taxonomy", f"SELECT * FROM {TAXONOMY_VALUES}"),
    ("silver_customers", """
        SELECT * FROM (
          SELECT c.c_custkey AS customer_id, trim(c.c_name) AS customer_unique_id,
                 CAST(NULL AS VARCHAR) AS customer_zip_code_prefix, CAST(NULL AS VARCHAR) AS customer_city,
                 upper(trim(n.n_name)) AS customer_state
          FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id DESC NULLS LAST,
                 customer_zip_code_prefix DESC NULLS LAST, customer_city DESC NULLS LAST, customer_state DESC NULLS LAST) = 1"""),
    ("silver_sellers", """
        SELECT * FROM (
          SELECT s.s_suppkey AS seller_id, CAST(NULL AS VARCHAR) AS seller_zip_code_prefix,
                 CAST(NULL AS VARCHAR) AS seller_city, upper(trim(n.n_name)) AS seller_state
          FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey)
        QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix DESC NULLS LAST,
                 seller_city DESC NULLS LAST, seller_state DESC NULLS LAST) = 1"""),
    ("silver_products_base", """
        SELECT * FROM (
          SELECT p_partkey AS product_id, trim(p_type) AS product_category_name,
                 CAST(length(p_name) AS INTEGER) AS product_name_length,
                 CAST(NULL AS INTEGER) AS product_description_length, CAST(NULL AS INTEGER) AS product_photos_qty,
                 CAST(NULL AS INTEGER) AS product_weight_g, CAST(NULL AS INTEGER) AS product_length_cm,
                 CAST(NULL AS INTEGER) AS product_height_cm, CAST(NULL AS INTEGER) AS product_width_cm
          FROM part)
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_category_name DESC NULLS LAST,
                 product_name_length DESC NULLS LAST) = 1"""),
    ("silver_products", """
        SELECT b.product_id, b.product_category_name, t.normalized_category, t.category_family,
               b.product_name_length, b.product_description_length, b.product_photos_qty, b.product_weight_g,
               b.product_length_cm, b.product_height_cm, b.product_width_cm
        FROM silver_products_base b LEFT JOIN taxonomy t ON trim(b.product_category_name) = t.source_category"""),
    ("silver_orders", """
        SELECT * FROM (
          SELECT o_orderkey AS order_id, o_custkey AS customer_id, lower(trim(o_orderstatus)) AS order_status,
                 o_orderdate AS purchased_at, CAST(NULL AS TIMESTAMP) AS approved_at,
                 CAST(NULL AS TIMESTAMP) AS carrier_handoff_at, CAST(NULL AS TIMESTAMP) AS delivered_at,
                 o_orderdate + INTERVAL 30 DAY AS est_delivery_date
          FROM orders)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id DESC NULLS LAST,
                 order_status DESC NULLS LAST, purchased_at DESC NULLS LAST, est_delivery_date DESC NULLS LAST) = 1"""),
    ("silver_order_items", f"""
        SELECT * FROM (
          SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
                 l_suppkey AS seller_id, CAST(NULL AS TIMESTAMP) AS shipping_limit_date,
                 {cents_sql('l_extendedprice')} AS item_price_c, {cents_sql('l_extendedprice * l_tax')} AS freight_cost_c,
                 l_shipdate AS delivered_at
          FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY delivered_at DESC NULLS LAST,
                 product_id DESC NULLS LAST, seller_id DESC NULLS LAST, shipping_limit_date DESC NULLS LAST,
                 item_price_c DESC NULLS LAST, freight_cost_c DESC NULLS LAST) = 1"""),
    ("silver_order_payments", f"""
        SELECT o_orderkey AS order_id, 1 AS payment_sequential, CAST(NULL AS VARCHAR) AS payment_type,
               CAST(NULL AS INTEGER) AS payment_installments, {cents_sql('o_totalprice')} AS payment_value_c
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_totalprice DESC NULLS LAST) = 1"""),
    ("silver_order_reviews", """
        SELECT * FROM (
          SELECT o_orderkey AS review_id, o_orderkey AS order_id,
                 TRY_CAST(trim(substr(o_orderpriority, 1, 1)) AS INTEGER) AS review_score,
                 CAST(NULL AS VARCHAR) AS review_comment_title, CAST(NULL AS VARCHAR) AS review_comment_message,
                 o_orderdate AS review_creation_date, CAST(NULL AS TIMESTAMP) AS review_answer_timestamp
          FROM orders)
        QUALIFY row_number() OVER (PARTITION BY review_id, order_id ORDER BY review_score DESC NULLS LAST,
                 review_creation_date DESC NULLS LAST) = 1"""),
    # Gold. Surrogate keys are represented by the resolved natural key
    # (NULL when the dimension has no row), which is what the key encodes.
    ("fact_order_item", """
        SELECT i.order_id, i.order_item_id, c.customer_id AS customer_nk, s.seller_id AS seller_nk,
               p.product_id AS product_nk,
               CAST(year(o.purchased_at) * 10000 + month(o.purchased_at) * 100 + day(o.purchased_at) AS INTEGER) AS purchase_date_key,
               CAST(year(o.purchased_at) AS INTEGER) AS purchase_year, s.seller_state, o.order_status, o.purchased_at,
               o.approved_at, o.carrier_handoff_at, coalesce(i.delivered_at, o.delivered_at) AS delivered_at,
               o.est_delivery_date, i.shipping_limit_date, i.item_price_c, i.freight_cost_c
        FROM silver_order_items i
        LEFT JOIN silver_orders o ON i.order_id = o.order_id
        LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
        LEFT JOIN silver_sellers s ON i.seller_id = s.seller_id
        LEFT JOIN silver_products p ON i.product_id = p.product_id"""),
    ("fact_payment", """
        SELECT y.order_id, y.payment_sequential, c.customer_id AS customer_nk,
               CAST(year(o.purchased_at) * 10000 + month(o.purchased_at) * 100 + day(o.purchased_at) AS INTEGER) AS payment_date_key,
               CAST(year(o.purchased_at) AS INTEGER) AS payment_year, y.payment_type, y.payment_installments,
               y.payment_value_c
        FROM silver_order_payments y
        LEFT JOIN silver_orders o ON y.order_id = o.order_id
        LEFT JOIN silver_customers c ON o.customer_id = c.customer_id"""),
    ("order_products", """
        SELECT DISTINCT i.order_id, p.product_id AS product_nk, p.normalized_category, p.category_family
        FROM silver_order_items i LEFT JOIN silver_products p ON i.product_id = p.product_id"""),
    ("fact_review", """
        SELECT r.review_id, r.order_id, c.customer_id AS customer_nk, op.product_nk,
               CAST(year(r.review_creation_date) * 10000 + month(r.review_creation_date) * 100
                    + day(r.review_creation_date) AS INTEGER) AS review_date_key,
               CAST(year(r.review_creation_date) AS INTEGER) AS review_year, r.review_score,
               r.review_creation_date, r.review_answer_timestamp, op.normalized_category, op.category_family
        FROM silver_order_reviews r
        LEFT JOIN silver_orders o ON r.order_id = o.order_id
        LEFT JOIN order_products op ON r.order_id = op.order_id
        LEFT JOIN silver_customers c ON o.customer_id = c.customer_id"""),
    ("dim_date", """
        SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name
        FROM (SELECT CAST(purchased_at AS DATE) AS d FROM silver_orders
              UNION SELECT CAST(review_creation_date AS DATE) FROM silver_order_reviews) x
        WHERE d IS NOT NULL"""),
]


def with_star(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _CTES)
    return f"WITH {ctes}\n{body}"


def oracle(name: str):
    def register(fn):
        ORACLE[name] = with_star(fn())
        return fn

    return register


def _money(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) / 100.0 AS {alias or c.removesuffix('_c')}"


# ---------------------------------------------------------------- Silver
for _t in ("customers", "sellers", "products", "orders", "order_reviews"):
    ORACLE[f"silver_{_t}"] = with_star(f"SELECT * FROM silver_{_t}")

ORACLE["silver_order_items"] = with_star(
    "SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
    f"{_money('item_price_c')}, {_money('freight_cost_c')}, delivered_at FROM silver_order_items"
)
ORACLE["silver_order_payments"] = with_star(
    "SELECT order_id, payment_sequential, payment_type, payment_installments, "
    f"{_money('payment_value_c')} FROM silver_order_payments"
)

# ---------------------------------------------------------------- Gold
ORACLE["dim_customer"] = with_star("SELECT * FROM silver_customers")
ORACLE["dim_seller"] = with_star("SELECT * FROM silver_sellers")
ORACLE["dim_product"] = with_star("SELECT * FROM silver_products")
ORACLE["dim_date"] = with_star("SELECT * FROM dim_date")
ORACLE["fact_order_item"] = with_star(
    "SELECT order_id, order_item_id, customer_nk IS NOT NULL AS customer_resolved, seller_nk IS NOT NULL AS seller_resolved, "
    "product_nk IS NOT NULL AS product_resolved, purchase_date_key, purchase_year, seller_state, order_status, "
    "purchased_at, approved_at, carrier_handoff_at, delivered_at, est_delivery_date, shipping_limit_date, "
    f"{_money('item_price_c')}, {_money('freight_cost_c')} FROM fact_order_item"
)
ORACLE["fact_payment"] = with_star(
    "SELECT order_id, payment_sequential, customer_nk IS NOT NULL AS customer_resolved, payment_date_key, payment_year, "
    f"payment_type, payment_installments, {_money('payment_value_c')} FROM fact_payment"
)
ORACLE["fact_review"] = with_star(
    "SELECT review_id, order_id, customer_nk IS NOT NULL AS customer_resolved, product_nk IS NOT NULL AS product_resolved, "
    "review_date_key, review_year, review_score, review_creation_date, review_answer_timestamp, normalized_category, "
    "category_family FROM fact_review"
)

# ---------------------------------------------------------------- analytics
ORACLE["late_delivery_rate"] = with_star(f"""
SELECT seller_id, category_family, delivered_items, late_items,
       {pct_sql('late_items', 'delivered_items')} AS late_delivery_rate_pct
FROM (
  SELECT s.seller_id, p.category_family, COUNT(*) AS delivered_items,
         COUNT(*) FILTER (WHERE f.delivered_at > f.est_delivery_date) AS late_items
  FROM fact_order_item f
  JOIN silver_sellers s ON f.seller_nk = s.seller_id
  JOIN silver_products p ON f.product_nk = p.product_id
  WHERE CAST(f.purchased_at AS DATE) >= (SELECT max(CAST(purchased_at AS DATE)) FROM fact_order_item) - 90
    AND f.delivered_at IS NOT NULL AND f.est_delivery_date IS NOT NULL
    AND p.category_family IS NOT NULL
  GROUP BY s.seller_id, p.category_family
  HAVING COUNT(*) >= 5) g
ORDER BY late_delivery_rate_pct DESC, delivered_items DESC""")

ORACLE["delivery_lag_by_state"] = with_star(f"""
SELECT customer_state, {pct_sql('s', 'delivered_items', 1)} AS average_purchase_to_delivery_days, delivered_items
FROM (
  SELECT c.customer_state, SUM(CAST(f.delivered_at AS DATE) - CAST(f.purchased_at AS DATE)) AS s,
         COUNT(*) AS delivered_items
  FROM fact_order_item f JOIN silver_customers c ON f.customer_nk = c.customer_id
  WHERE f.purchased_at IS NOT NULL AND f.delivered_at IS NOT NULL
  GROUP BY c.customer_state) g""")

_MONTHLY = """
  SELECT CAST(date_trunc('month', review_creation_date) AS DATE) AS review_month, category_family,
         COUNT(DISTINCT CASE WHEN review_score <= 2 THEN review_id END) AS negative_reviews
  FROM fact_review
  WHERE review_score IS NOT NULL AND category_family IS NOT NULL
  GROUP BY 1, 2"""

ORACLE["negative_review_mom"] = with_star(f"""
SELECT review_month, category_family, negative_reviews, previous_month_negative_reviews,
       negative_reviews - previous_month_negative_reviews AS absolute_change,
       {pct_sql('negative_reviews - previous_month_negative_reviews', 'previous_month_negative_reviews')} AS mom_change_pct
FROM (
  SELECT *, LAG(negative_reviews) OVER (PARTITION BY category_family ORDER BY review_month NULLS FIRST)
            AS previous_month_negative_reviews
  FROM ({_MONTHLY}) m) w
WHERE previous_month_negative_reviews > 0""")

ORACLE["negative_review_mom_strict"] = with_star(f"""
SELECT review_month, category_family, negative_reviews, previous_month_negative_reviews,
       negative_reviews - previous_month_negative_reviews AS absolute_change,
       {pct_sql('negative_reviews - previous_month_negative_reviews', 'previous_month_negative_reviews')} AS mom_change_pct
FROM (
  SELECT review_month, category_family, negative_reviews,
         CASE WHEN LAG(review_month) OVER w = review_month - INTERVAL 1 MONTH THEN LAG(negative_reviews) OVER w END
            AS previous_month_negative_reviews
  FROM ({_MONTHLY}) m
  WINDOW w AS (PARTITION BY category_family ORDER BY review_month NULLS FIRST)) w
WHERE previous_month_negative_reviews > 0""")

_OCV = """
  SELECT f.order_id, p.category_family, SUM(f.item_price_c + f.freight_cost_c) AS value_cents
  FROM fact_order_item f JOIN silver_products p ON f.product_nk = p.product_id
  WHERE p.category_family IS NOT NULL
  GROUP BY f.order_id, p.category_family"""

ORACLE["order_value_anomalies"] = with_star(f"""
SELECT o.order_id, o.category_family, CAST(o.value_cents AS DOUBLE) / 100.0 AS order_category_value,
       CAST(q.p95 AS DOUBLE) / 100.0 AS category_p95_value,
       {pct_sql('o.value_cents', 'q.p95', 1)} AS multiple_of_category_p95
FROM ({_OCV}) o
JOIN (SELECT category_family, quantile_disc(value_cents, 0.95) AS p95 FROM ({_OCV}) x GROUP BY category_family) q
  ON o.category_family = q.category_family
WHERE o.value_cents > q.p95""")

ORACLE["category_value_ranking"] = with_star("""
SELECT p.category_family, COUNT(DISTINCT f.order_id) AS orders, COUNT(*) AS units_sold,
       CAST(SUM(f.item_price_c) AS DOUBLE) / 100.0 AS item_revenue,
       CAST(SUM(f.freight_cost_c) AS DOUBLE) / 100.0 AS freight_cost,
       CAST(SUM(f.item_price_c + f.freight_cost_c) AS DOUBLE) / 100.0 AS total_value
FROM fact_order_item f JOIN silver_products p ON f.product_nk = p.product_id
WHERE p.category_family IS NOT NULL
GROUP BY p.category_family""")

# ---------------------------------------------------------------- data quality
AS_OF = "TIMESTAMP '2024-01-31 12:00:00'"


def _res(no, name: str, e: str | None, f: str, unit: str, src: str) -> str:
    ev = f"CAST(({e}) AS BIGINT)" if e else "CAST(NULL AS BIGINT)"
    pct = "CAST(NULL AS DOUBLE)" if not e else (
        f"CASE WHEN ({e}) = 0 THEN 0.0 ELSE CAST(({f}) AS DOUBLE) / CAST(({e}) AS DOUBLE) * 100.0 END")
    no_col = f"{no} AS check_no, " if no is not None else ""
    return (f"SELECT {no_col}'{name}' AS test_name, {ev} AS rows_evaluated, CAST(({f}) AS BIGINT) AS rows_failed, "
            f"{pct} AS failure_pct, ({f}) = 0 AS passed, '{unit}' AS unit FROM {src}")


def _grain(no, name, table, cols):
    src = f"(SELECT COUNT(*) AS n FROM {table} GROUP BY {cols}) g"
    return _res(no, name, "COUNT(*)", "COUNT(*) FILTER (WHERE n > 1)", "groups", src)


def _ri(no, name, fact, fk, dim, pk):
    src = (f"(SELECT f.{fk} AS k, d.k AS hit FROM {fact} f LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {dim}) d "
           f"ON f.{fk} = d.k WHERE f.{fk} IS NOT NULL) x")
    return _res(no, name, "COUNT(*)", "COUNT(*) FILTER (WHERE hit IS NULL)", "rows", src)


def _rows(no, name, table, applies, fails):
    return _res(no, name, f"COUNT(*) FILTER (WHERE {applies})", f"COUNT(*) FILTER (WHERE ({applies}) AND ({fails}))",
                "rows", table)


_EPOCH = "(epoch_ms({}) // 1000)"

_DQ = [
    _rows(1, "dim_customer.customer_key is non-null", "silver_customers", "TRUE", "customer_id IS NULL"),
    _rows(2, "dim_seller.seller_key is non-null", "silver_sellers", "TRUE", "seller_id IS NULL"),
    _rows(3, "dim_product.product_key is non-null", "silver_products", "TRUE", "product_id IS NULL"),
    _ri(4, "fact_order_item.customer_key has no orphans", "fact_order_item", "customer_nk", "silver_customers", "customer_id"),
    _ri(5, "fact_order_item.product_key has no orphans", "fact_order_item", "product_nk", "silver_products", "product_id"),
    _grain(6, "fact_order_item has unique (order_id, order_item_id) grain", "fact_order_item", "order_id, order_item_id"),
    _grain(7, "fact_payment has unique (order_id, payment_sequential) grain", "fact_payment", "order_id, payment_sequential"),
    _rows(8, "delivered_at is not before purchased_at", "fact_order_item",
          "delivered_at IS NOT NULL AND purchased_at IS NOT NULL", "delivered_at < purchased_at"),
    _rows(9, "payment_value is non-negative", "fact_payment", "payment_value_c IS NOT NULL", "payment_value_c < 0"),
    _rows(10, "all non-null product categories are mapped to taxonomy", "silver_products",
          "product_category_name IS NOT NULL", "normalized_category IS NULL OR category_family IS NULL"),
    _grain(11, "fact_review has unique (review_id, order_id, product_key) grain", "fact_review", "review_id, order_id, product_nk"),
    _rows(12, "fact_review scores are between 1 and 5", "fact_review", "TRUE",
          "review_score IS NULL OR NOT (review_score BETWEEN 1 AND 5)"),
    _ri(13, "fact_review.review_date_key has no orphans", "fact_review", "review_date_key", "dim_date", "date_key"),
    _ri(14, "fact_review.customer_key has no orphans", "fact_review", "customer_nk", "silver_customers", "customer_id"),
    _ri(15, "fact_review.product_key has no orphans", "fact_review", "product_nk", "silver_products", "product_id"),
    _res(16, "Bronze ingestion is fresh (<= 24 hours)", None,
         f"CASE WHEN coalesce(age >= 0 AND age <= 24.0, FALSE) THEN 0 ELSE 1 END", "tables",
         f"(SELECT CAST({_EPOCH.format(AS_OF)} - {_EPOCH.format('max(ts)')} AS DOUBLE) / 3600.0 AS age FROM events) a"),
]
ORACLE["dq_report"] = with_star("\nUNION ALL\n".join(_DQ))

ORACLE["dq_failing_rows"] = with_star(
    "SELECT order_id, order_item_id, purchased_at, delivered_at FROM fact_order_item "
    "WHERE delivered_at IS NOT NULL AND purchased_at IS NOT NULL AND delivered_at < purchased_at"
)

def _failing(name: str, table: str, key: list[str], where: str, src: str | None = None) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in key)
    return f"SELECT '{name}' AS test_name, '{table}' AS table_name, {text} AS row_key FROM {src or table} WHERE {where}"


def _several(name: str, table: str, key: list[str]) -> str:
    cols = ", ".join(key)
    return _failing(name, table, key, "n > 1", f"(SELECT {cols}, COUNT(*) AS n FROM {table} GROUP BY {cols}) g")


def _orphan(name: str, table: str, key: list[str], fk: str, dim: str, pk: str) -> str:
    return _failing(name, table, key, f"{fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {dim} WHERE {pk} IS NOT NULL)")


# no review row fails in these tables, so the key of its surrogate need not be written out
_ITEM, _PAY, _REV = ["order_id", "order_item_id"], ["order_id", "payment_sequential"], ["review_id", "order_id", "product_nk"]
ORACLE["rule_violations"] = with_star("\nUNION ALL\n".join([
    _failing("dim_customer.customer_key is non-null", "dim_customer", ["customer_id"], "customer_id IS NULL", "silver_customers"),
    _failing("dim_seller.seller_key is non-null", "dim_seller", ["seller_id"], "seller_id IS NULL", "silver_sellers"),
    _failing("dim_product.product_key is non-null", "dim_product", ["product_id"], "product_id IS NULL", "silver_products"),
    _orphan("fact_order_item.customer_key has no orphans", "fact_order_item", _ITEM, "customer_nk", "silver_customers", "customer_id"),
    _orphan("fact_order_item.product_key has no orphans", "fact_order_item", _ITEM, "product_nk", "silver_products", "product_id"),
    _several("fact_order_item has unique (order_id, order_item_id) grain", "fact_order_item", _ITEM),
    _several("fact_payment has unique (order_id, payment_sequential) grain", "fact_payment", _PAY),
    _failing("delivered_at is not before purchased_at", "fact_order_item", _ITEM, "delivered_at < purchased_at"),
    _failing("payment_value is non-negative", "fact_payment", _PAY, "payment_value_c < 0"),
    _failing("all non-null product categories are mapped to taxonomy", "dim_product", ["product_id"],
             "product_category_name IS NOT NULL AND (normalized_category IS NULL OR category_family IS NULL)", "silver_products"),
    _several("fact_review has unique (review_id, order_id, product_key) grain", "fact_review", _REV),
    _failing("fact_review scores are between 1 and 5", "fact_review", _REV,
             "review_score IS NULL OR NOT (review_score BETWEEN 1 AND 5)"),
    _orphan("fact_review.review_date_key has no orphans", "fact_review", _REV, "review_date_key", "dim_date", "date_key"),
    _orphan("fact_review.customer_key has no orphans", "fact_review", _REV, "customer_nk", "silver_customers", "customer_id"),
    _orphan("fact_review.product_key has no orphans", "fact_review", _REV, "product_nk", "silver_products", "product_id"),
    f"SELECT test_name, 'bronze' AS table_name, '' AS row_key FROM ({_DQ[-1]}) x WHERE NOT passed",
]))

ORACLE["fact_grain_check"] = with_star("\nUNION ALL\n".join([
    _grain(None, "fact_order_item", "fact_order_item", "order_id, order_item_id"),
    _grain(None, "fact_payment", "fact_payment", "order_id, payment_sequential"),
    _grain(None, "fact_review", "fact_review", "review_id, order_id, product_nk"),
]))

ORACLE["ri_check_matrix"] = with_star("\nUNION ALL\n".join([
    _ri(None, "fact_order_item.customer_key -> dim_customer.customer_key", "fact_order_item", "customer_nk", "silver_customers", "customer_id"),
    _ri(None, "fact_order_item.seller_key -> dim_seller.seller_key", "fact_order_item", "seller_nk", "silver_sellers", "seller_id"),
    _ri(None, "fact_order_item.product_key -> dim_product.product_key", "fact_order_item", "product_nk", "silver_products", "product_id"),
    _ri(None, "fact_order_item.purchase_date_key -> dim_date.date_key", "fact_order_item", "purchase_date_key", "dim_date", "date_key"),
    _ri(None, "fact_payment.customer_key -> dim_customer.customer_key", "fact_payment", "customer_nk", "silver_customers", "customer_id"),
    _ri(None, "fact_payment.payment_date_key -> dim_date.date_key", "fact_payment", "payment_date_key", "dim_date", "date_key"),
    _ri(None, "fact_review.customer_key -> dim_customer.customer_key", "fact_review", "customer_nk", "silver_customers", "customer_id"),
    _ri(None, "fact_review.product_key -> dim_product.product_key", "fact_review", "product_nk", "silver_products", "product_id"),
    _ri(None, "fact_review.review_date_key -> dim_date.date_key", "fact_review", "review_date_key", "dim_date", "date_key"),
]))

ORACLE["unresolved_fk_rates"] = with_star("\nUNION ALL\n".join(
    _rows(None, f"{fact}.{fk} is resolved", fact, "TRUE", f"{col} IS NULL")
    for fact, fk, col in [
        ("fact_order_item", "customer_key", "customer_nk"), ("fact_order_item", "seller_key", "seller_nk"),
        ("fact_order_item", "product_key", "product_nk"), ("fact_order_item", "purchase_date_key", "purchase_date_key"),
        ("fact_payment", "customer_key", "customer_nk"), ("fact_payment", "payment_date_key", "payment_date_key"),
        ("fact_review", "customer_key", "customer_nk"), ("fact_review", "product_key", "product_nk"),
        ("fact_review", "review_date_key", "review_date_key"),
    ]
))

ORACLE["surrogate_key_collisions"] = with_star("\nUNION ALL\n".join(
    f"SELECT '{dim}' AS table_name, COUNT(DISTINCT {nk}) AS natural_keys, COUNT(DISTINCT {nk}) AS surrogate_keys, "
    f"CAST(0 AS BIGINT) AS colliding_keys FROM {src}"
    for dim, nk, src in [("dim_customer", "customer_id", "silver_customers"), ("dim_seller", "seller_id", "silver_sellers"),
                         ("dim_product", "product_id", "silver_products")]
))

ORACLE["freshness_check"] = with_star("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, latest_ts, age_hours, coalesce(age_hours >= 0 AND age_hours <= 24.0, FALSE) AS fresh "
    f"FROM (SELECT max({c}) AS latest_ts, CAST({_EPOCH.format(AS_OF)} - {_EPOCH.format(f'max({c})')} AS DOUBLE) / 3600.0 "
    f"AS age_hours FROM {t}) x"
    for t, c in [("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate")]
))

# ---------------------------------------------------------------- profiling
_RAW_COLS = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "products": "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty "
                "product_weight_g product_length_cm product_height_cm product_width_cm",
    "orders": "order_id customer_id order_status purchased_at approved_at carrier_handoff_at delivered_at est_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date item_price freight_cost delivered_at",
    "order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "order_reviews": "review_id order_id review_score review_comment_title review_comment_message review_creation_date "
                     "review_answer_timestamp",
}
ORACLE["null_profile"] = with_star("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM raw_{t}"
    for t, cols in _RAW_COLS.items() for c in cols.split()
))

ORACLE["duplicate_key_groups"] = with_star("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_columns, COUNT(*) AS key_groups, COUNT(*) FILTER (WHERE n > 1) AS duplicate_groups, "
    f"CAST(coalesce(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_duplicate_groups "
    f"FROM (SELECT COUNT(*) AS n FROM raw_{t} GROUP BY {k}) g"
    for t, k in [("customers", "customer_id"), ("products", "product_id"), ("sellers", "seller_id"), ("orders", "order_id"),
                 ("order_reviews", "review_id"), ("order_reviews", "order_id, review_id"),
                 ("order_items", "order_id, order_item_id"), ("order_payments", "order_id, payment_sequential")]
))

ORACLE["duplicate_rows"] = with_star(
    "SELECT i.*, d.key_rows FROM raw_order_items i JOIN (SELECT order_id, order_item_id, COUNT(*) AS key_rows "
    "FROM raw_order_items GROUP BY 1, 2 HAVING COUNT(*) > 1) d USING (order_id, order_item_id)"
)

ORACLE["duplicate_histogram"] = with_star(
    "SELECT distinct_values, COUNT(*) AS ids FROM (SELECT review_id, COUNT(DISTINCT order_id) AS distinct_values "
    "FROM raw_order_reviews GROUP BY review_id) g GROUP BY distinct_values"
)

ORACLE["orphan_values"] = with_star("\nUNION ALL\n".join(
    f"SELECT '{name}' AS relation, COUNT(*) AS child_values, COUNT(*) FILTER (WHERE p.v IS NULL) AS orphan_values "
    f"FROM (SELECT DISTINCT {cc} AS v FROM raw_{c} WHERE {cc} IS NOT NULL) ch "
    f"LEFT JOIN (SELECT DISTINCT {pc} AS v FROM raw_{par}) p ON ch.v = p.v"
    for name, c, cc, par, pc in [
        ("orders.customer_id -> customers", "orders", "customer_id", "customers", "customer_id"),
        ("order_items.order_id -> orders", "order_items", "order_id", "orders", "order_id"),
        ("order_items.product_id -> products", "order_items", "product_id", "products", "product_id"),
        ("order_items.seller_id -> sellers", "order_items", "seller_id", "sellers", "seller_id"),
        ("order_payments.order_id -> orders", "order_payments", "order_id", "orders", "order_id"),
        ("order_reviews.order_id -> orders", "order_reviews", "order_id", "orders", "order_id"),
    ]
))

_ORPHAN_REVIEWS = ("SELECT * FROM silver_order_reviews r WHERE r.order_id IS NOT NULL AND NOT EXISTS "
                   "(SELECT 1 FROM silver_order_items i WHERE i.order_id = r.order_id)")
ORACLE["orphan_rows"] = with_star(_ORPHAN_REVIEWS)
ORACLE["orphan_score_distribution"] = with_star(
    f"SELECT review_score, COUNT(*) AS rows FROM ({_ORPHAN_REVIEWS}) x GROUP BY review_score"
)

ORACLE["category_frequency"] = with_star(
    "SELECT product_category_name AS category, COUNT(*) AS products FROM silver_products GROUP BY 1"
)

ORACLE["taxonomy_gaps"] = with_star("""
SELECT coalesce(d.category, t.category) AS category,
       CASE WHEN t.category IS NULL THEN 'missing_in_taxonomy' ELSE 'extra_in_taxonomy' END AS status,
       CAST(NULL AS BIGINT) AS taxonomy_rows
FROM (SELECT DISTINCT trim(product_category_name) AS category FROM silver_products WHERE product_category_name IS NOT NULL) d
FULL OUTER JOIN (SELECT DISTINCT trim(source_category) AS category FROM taxonomy) t ON d.category = t.category
WHERE d.category IS NULL OR t.category IS NULL
UNION ALL
SELECT trim(source_category), 'duplicate_in_taxonomy', COUNT(*) FROM taxonomy GROUP BY 1 HAVING COUNT(*) > 1""")

ORACLE["taxonomy_coverage"] = with_star(
    "SELECT COUNT(*) FILTER (WHERE product_category_name IS NOT NULL) AS categorised_products, "
    "COUNT(*) FILTER (WHERE product_category_name IS NOT NULL AND normalized_category IS NOT NULL "
    "AND category_family IS NOT NULL) AS mapped_products, "
    "COUNT(*) FILTER (WHERE product_category_name IS NULL) AS null_category_products FROM silver_products"
)

ORACLE["row_count_report"] = with_star("\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {src}"
    for name, src in [("dim_customer", "silver_customers"), ("dim_seller", "silver_sellers"), ("dim_product", "silver_products"),
                      ("dim_date", "dim_date"), ("fact_order_item", "fact_order_item"), ("fact_payment", "fact_payment"),
                      ("fact_review", "fact_review")]
))

# ---------------------------------------------------------------- marts
_ITEM_FACTS = """
  SELECT i.order_id, i.product_id, i.seller_id, i.item_price_c, i.freight_cost_c, o.customer_id, o.purchased_at,
         o.est_delivery_date, coalesce(i.delivered_at, od.delivered_at) AS delivered
  FROM silver_order_items i
  LEFT JOIN silver_orders o ON i.order_id = o.order_id
  LEFT JOIN (SELECT o2.order_id, coalesce(o2.delivered_at, m.d) AS delivered_at FROM silver_orders o2
             LEFT JOIN (SELECT order_id, max(delivered_at) AS d FROM silver_order_items GROUP BY 1) m
             ON o2.order_id = m.order_id) od ON i.order_id = od.order_id"""

_MEASURES = """
  COUNT(DISTINCT f.order_id) AS orders, COUNT(*) AS units,
  CAST(SUM(f.item_price_c) AS DOUBLE) / 100.0 AS item_revenue, CAST(SUM(f.freight_cost_c) AS DOUBLE) / 100.0 AS freight_cost,
  COUNT(*) FILTER (WHERE f.delivered IS NOT NULL AND f.est_delivery_date IS NOT NULL) AS delivered_items,
  COUNT(*) FILTER (WHERE f.delivered IS NOT NULL AND f.est_delivery_date IS NOT NULL
                   AND f.delivered > f.est_delivery_date) AS late_items"""

ORACLE["mart_sales"] = with_star("""
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, CAST(i.item_price_c AS DOUBLE) / 100.0 AS item_price,
       CAST(i.freight_cost_c AS DOUBLE) / 100.0 AS freight_cost, CAST(p.t AS DOUBLE) / 100.0 AS total_payment_value
FROM silver_order_items i
LEFT JOIN (SELECT order_id, SUM(payment_value_c) AS t FROM silver_order_payments GROUP BY 1) p ON i.order_id = p.order_id""")

ORACLE["mart_delivery_performance"] = with_star("""
SELECT o.order_id, o.order_status, coalesce(o.delivered_at, m.d) AS delivered_at, o.est_delivery_date,
       CASE WHEN coalesce(o.delivered_at, m.d) IS NOT NULL AND o.est_delivery_date IS NOT NULL
            THEN NOT (coalesce(o.delivered_at, m.d) > o.est_delivery_date) END AS delivered_on_time,
       CASE WHEN coalesce(o.delivered_at, m.d) IS NOT NULL AND o.est_delivery_date IS NOT NULL
            THEN CAST(CAST(coalesce(o.delivered_at, m.d) AS DATE) - CAST(o.est_delivery_date AS DATE) AS INTEGER) END
            AS delivery_delay_days
FROM silver_orders o LEFT JOIN (SELECT order_id, max(delivered_at) AS d FROM silver_order_items GROUP BY 1) m
  ON o.order_id = m.order_id""")

ORACLE["mart_customer_summary"] = with_star(f"""
SELECT c.customer_unique_id, {_MEASURES}, min(f.purchased_at) AS first_purchase_at, max(f.purchased_at) AS last_purchase_at
FROM ({_ITEM_FACTS}) f LEFT JOIN silver_customers c ON f.customer_id = c.customer_id
GROUP BY c.customer_unique_id""")

ORACLE["mart_product_performance"] = with_star(f"""
SELECT f.product_id, p.product_category_name, {_MEASURES}
FROM ({_ITEM_FACTS}) f LEFT JOIN silver_products p ON f.product_id = p.product_id
GROUP BY f.product_id, p.product_category_name""")

ORACLE["mart_seller_performance"] = with_star(f"""
SELECT f.seller_id, s.seller_city, s.seller_state, {_MEASURES}
FROM ({_ITEM_FACTS}) f LEFT JOIN silver_sellers s ON f.seller_id = s.seller_id
GROUP BY f.seller_id, s.seller_city, s.seller_state""")

# ---------------------------------------------------------------- incremental
_CONFORMED_ITEMS = f"""
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         CAST(NULL AS TIMESTAMP) AS shipping_limit_date, {cents_sql('l_extendedprice')} AS item_price_c,
         {cents_sql('l_extendedprice * l_tax')} AS freight_cost_c, l_shipdate AS delivered_at
  FROM lineitem"""


def _cutoff(days: int) -> str:
    return f"(SELECT max(l_shipdate) - INTERVAL {days} DAY FROM lineitem)"


def _latest(src: str) -> str:
    return (f"SELECT * FROM ({src}) x QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY "
            "delivered_at DESC NULLS LAST, product_id DESC NULLS LAST, seller_id DESC NULLS LAST, "
            "shipping_limit_date DESC NULLS LAST, item_price_c DESC NULLS LAST, freight_cost_c DESC NULLS LAST) = 1")


_OLD_ITEMS = _latest(f"SELECT * FROM ({_CONFORMED_ITEMS}) c WHERE delivered_at < {_cutoff(180)}")
_VALUE_COLS = ["product_id", "seller_id", "shipping_limit_date", "item_price_c", "freight_cost_c", "delivered_at"]
_CHANGED = ", ".join(
    f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c.removesuffix('_c')}' END" for c in _VALUE_COLS
)
ORACLE["table_diff"] = with_star(f"""
SELECT order_id, order_item_id, change, changed_columns FROM (
  SELECT coalesce(a.order_id, b.order_id) AS order_id, coalesce(a.order_item_id, b.order_item_id) AS order_item_id,
         CASE WHEN a.order_id IS NULL THEN 'added' WHEN b.order_id IS NULL THEN 'removed'
              WHEN concat_ws(',', {_CHANGED}) <> '' THEN 'changed' END AS change,
         CASE WHEN a.order_id IS NOT NULL AND b.order_id IS NOT NULL AND concat_ws(',', {_CHANGED}) <> ''
              THEN concat_ws(',', {_CHANGED}) END AS changed_columns
  FROM ({_OLD_ITEMS}) a FULL OUTER JOIN silver_order_items b
    ON a.order_id = b.order_id AND a.order_item_id = b.order_item_id) d
WHERE change IS NOT NULL""")

ORACLE["scd1_upsert"] = with_star(
    "SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
    "CAST(item_price_c AS DOUBLE) / 100.0 AS item_price, CAST(freight_cost_c AS DOUBLE) / 100.0 AS freight_cost, delivered_at "
    "FROM silver_order_items"
)

ORACLE["scd2_history"] = with_star(f"""
SELECT order_id, order_item_id, product_id, seller_id, CAST(item_price_c AS DOUBLE) / 100.0 AS item_price,
       CAST(freight_cost_c AS DOUBLE) / 100.0 AS freight_cost, delivered_at AS valid_from,
       lead(delivered_at) OVER w AS valid_to, lead(delivered_at) OVER w IS NULL AS is_current
FROM (
  SELECT *, row_number() OVER v AS rn, lag(product_id) OVER v AS p1, lag(seller_id) OVER v AS p2,
         lag(item_price_c) OVER v AS p3, lag(freight_cost_c) OVER v AS p4
  FROM ({_CONFORMED_ITEMS}) c
  WINDOW v AS (PARTITION BY order_id, order_item_id ORDER BY delivered_at ASC NULLS FIRST, product_id ASC NULLS FIRST,
               seller_id ASC NULLS FIRST, item_price_c ASC NULLS FIRST, freight_cost_c ASC NULLS FIRST)) s
WHERE rn = 1 OR NOT (product_id IS NOT DISTINCT FROM p1 AND seller_id IS NOT DISTINCT FROM p2
                     AND item_price_c IS NOT DISTINCT FROM p3 AND freight_cost_c IS NOT DISTINCT FROM p4)
WINDOW w AS (PARTITION BY order_id, order_item_id ORDER BY delivered_at ASC NULLS FIRST, product_id ASC NULLS FIRST,
             seller_id ASC NULLS FIRST, item_price_c ASC NULLS FIRST, freight_cost_c ASC NULLS FIRST)""")

ORACLE["affected_partitions"] = with_star(f"""
SELECT DISTINCT CAST(year(o.purchased_at) AS INTEGER) AS purchase_year, s.seller_state
FROM ({_CONFORMED_ITEMS}) b
LEFT JOIN silver_orders o ON b.order_id = o.order_id
LEFT JOIN silver_sellers s ON b.seller_id = s.seller_id
WHERE b.delivered_at >= {_cutoff(30)}""")

_LATE = """
  SELECT order_id, order_item_id, purchase_year, purchased_at, delivered_at,
         CAST(CAST(delivered_at AS DATE) - CAST(purchased_at AS DATE) AS INTEGER) AS delay_days
  FROM fact_order_item
  WHERE purchased_at IS NOT NULL AND delivered_at IS NOT NULL
    AND CAST(delivered_at AS DATE) - CAST(purchased_at AS DATE) > 365"""
ORACLE["late_arrivals"] = with_star(_LATE)
ORACLE["late_arrival_volume"] = with_star(
    f"SELECT purchase_year, COUNT(*) AS late_rows, max(delay_days) AS max_delay_days FROM ({_LATE}) l GROUP BY 1"
)

ORACLE["backfill_window"] = with_star("""
SELECT order_id, order_item_id, purchase_year, purchased_at, CAST(item_price_c AS DOUBLE) / 100.0 AS item_price
FROM fact_order_item
WHERE CAST(purchased_at AS DATE) >= (SELECT max(CAST(purchased_at AS DATE)) FROM fact_order_item) - 29""")

_RUN = [
    ("customers", "raw_customers", "customer_id IS NULL", "silver_customers"),
    ("orders", "raw_orders", "order_id IS NULL", "silver_orders"),
    ("products", "raw_products", "product_id IS NULL", "silver_products"),
    ("sellers", "raw_sellers", "seller_id IS NULL", "silver_sellers"),
    ("order_items", "raw_order_items", "order_id IS NULL OR order_item_id IS NULL", "silver_order_items"),
    ("order_payments", "raw_order_payments", "order_id IS NULL OR payment_sequential IS NULL", "silver_order_payments"),
    ("order_reviews", "raw_order_reviews", "review_id IS NULL OR order_id IS NULL", "silver_order_reviews"),
]
ORACLE["run_metrics"] = with_star("\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, m.metric, m.value FROM (SELECT COUNT(*) AS r, COUNT(*) FILTER (WHERE {nk}) AS n, "
     f"(SELECT COUNT(*) FROM {s}) AS s FROM {raw}) x, LATERAL (VALUES ('raw_rows', r), ('null_key_rows', n), "
     f"('silver_rows', s), ('duplicates_removed', r - s)) m(metric, value)"
     for t, raw, nk, s in _RUN]
    + ["SELECT 'fact_order_item', 'partitions', COUNT(*) FROM (SELECT DISTINCT purchase_year, seller_state FROM fact_order_item) p",
       "SELECT 'fact_order_item', 'late_rows', COUNT(*) FROM fact_order_item WHERE purchased_at IS NOT NULL "
       "AND delivered_at IS NOT NULL AND CAST(delivered_at AS DATE) - CAST(purchased_at AS DATE) > 365"]
))

# ---------------------------------------------------------------- validation reports, top-k
def _vrow(check: str, subject: str, value_sql: str, src: str) -> str:
    return f"SELECT '{check}' AS check_type, '{subject}' AS subject, CAST(({value_sql}) AS DOUBLE) AS value FROM {src}"


_SV = [_vrow("row_count", t, "COUNT(*)", f"silver_{t}") for t in
       ("customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews")]
_SV += [_vrow("duplicate_key_groups", f"{t}({k})", "COUNT(*) FILTER (WHERE n > 1)",
              f"(SELECT COUNT(*) AS n FROM silver_{t} GROUP BY {k}) g")
        for t, k in [("customers", "customer_id"), ("products", "product_id"), ("sellers", "seller_id"), ("orders", "order_id"),
                     ("order_items", "order_id, order_item_id"), ("order_payments", "order_id, payment_sequential")]]
_SV += [_vrow("orphan_values", name, "COUNT(*) FILTER (WHERE p.v IS NULL)",
              f"(SELECT DISTINCT {cc} AS v FROM silver_{c} WHERE {cc} IS NOT NULL) ch "
              f"LEFT JOIN (SELECT DISTINCT {pc} AS v FROM silver_{par}) p ON ch.v = p.v")
        for name, c, cc, par, pc in [
            ("orders.customer_id -> customers", "orders", "customer_id", "customers", "customer_id"),
            ("order_items.order_id -> orders", "order_items", "order_id", "orders", "order_id"),
            ("order_items.product_id -> products", "order_items", "product_id", "products", "product_id"),
            ("order_items.seller_id -> sellers", "order_items", "seller_id", "sellers", "seller_id"),
            ("order_payments.order_id -> orders", "order_payments", "order_id", "orders", "order_id"),
            ("order_reviews.order_id -> orders", "order_reviews", "order_id", "orders", "order_id")]]
ORACLE["silver_validation"] = with_star("\nUNION ALL\n".join(_SV))


def _body(name: str) -> str:
    """The query part (after the CTEs) of an oracle registered above."""
    sql = ORACLE[name]
    return sql[len(with_star("")):]


_MARTS = {n: f"({_body(n)})" for n in ("mart_sales", "mart_delivery_performance", "mart_customer_summary",
                                        "mart_product_performance", "mart_seller_performance")}
_MV = [_vrow("row_count", n, "COUNT(*)", f"{src} m") for n, src in _MARTS.items()]
_MV += [_vrow("duplicate_key_groups", n, "COUNT(*) FILTER (WHERE n > 1)", f"(SELECT COUNT(*) AS n FROM {_MARTS[n]} m GROUP BY {g}) g")
        for n, g in [("mart_sales", "order_id, order_item_id"), ("mart_delivery_performance", "order_id"),
                     ("mart_customer_summary", "customer_unique_id"), ("mart_product_performance", "product_id, product_category_name"),
                     ("mart_seller_performance", "seller_id, seller_city, seller_state")]]
_MV += [_vrow("null_key_rows", f"{n}.{c}", f"COUNT(*) FILTER (WHERE {c} IS NULL)", f"{_MARTS[n]} m")
        for n, cols in [("mart_sales", ["order_id", "order_item_id", "product_id", "seller_id"]),
                        ("mart_delivery_performance", ["order_id"]), ("mart_customer_summary", ["customer_unique_id"]),
                        ("mart_product_performance", ["product_id"]), ("mart_seller_performance", ["seller_id"])]
        for c in cols]
_MV += [_vrow("delivery_split", s, f"COUNT(*) FILTER (WHERE {cond})", f"{_MARTS['mart_delivery_performance']} m")
        for s, cond in [("on_time", "delivered_on_time"), ("late", "NOT delivered_on_time"),
                        ("undelivered", "delivered_on_time IS NULL"), ("delayed", "delivery_delay_days > 0")]]
_MV += [_vrow("money_total", "item_price", "SUM(item_price_c) / 100.0", "silver_order_items"),
        _vrow("money_total", "freight_cost", "SUM(freight_cost_c) / 100.0", "silver_order_items"),
        _vrow("money_total", "total_payment_value", "SUM(t) / 100.0",
              "(SELECT i.order_id, max(p.t) AS t FROM silver_order_items i LEFT JOIN "
              "(SELECT order_id, SUM(payment_value_c) AS t FROM silver_order_payments GROUP BY 1) p "
              "ON i.order_id = p.order_id GROUP BY i.order_id) x")]
ORACLE["mart_validation"] = with_star("\nUNION ALL\n".join(_MV))

ORACLE["late_delivery_top20"] = ORACLE["late_delivery_rate"] + ", seller_id, category_family LIMIT 20"
ORACLE["order_value_anomalies_top20"] = ORACLE["order_value_anomalies"] + \
    "\nORDER BY multiple_of_category_p95 DESC, order_id, category_family LIMIT 20"

# ---------------------------------------------------------------- generic operators on the source tables
ORACLE["dedupe_latest"] = with_star("""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
        l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
        l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1""")

ORACLE["taxonomy_enrich"] = with_star("""
SELECT p.p_partkey, p.p_type, t.normalized_category, t.category_family
FROM part p LEFT JOIN taxonomy t ON trim(p.p_type) = t.source_category""")

ORACLE["fact_partition_sizes"] = with_star(
    "SELECT purchase_year, seller_state, COUNT(*) AS row_count FROM fact_order_item GROUP BY 1, 2"
)
ORACLE["missing_key_rows"] = with_star("SELECT * FROM raw_order_reviews WHERE review_id IS NULL")

# typed columns of the raw driver tables: (table, output column, raw expression, target SQL type)
_TYPED = [
    ("orders", "purchased_at", "purchased_at", None), ("orders", "approved_at", "approved_at", None),
    ("orders", "carrier_handoff_at", "carrier_handoff_at", None), ("orders", "delivered_at", "delivered_at", None),
    ("orders", "est_delivery_date", "est_delivery_date", None),
    ("products", "product_name_length", "product_name_lenght", None),
    ("products", "product_description_length", "product_description_lenght", None),
    ("products", "product_photos_qty", "product_photos_qty", None), ("products", "product_weight_g", "product_weight_g", None),
    ("products", "product_length_cm", "product_length_cm", None), ("products", "product_height_cm", "product_height_cm", None),
    ("products", "product_width_cm", "product_width_cm", None),
    ("order_items", "order_item_id", "order_item_id", None), ("order_items", "shipping_limit_date", "shipping_limit_date", None),
    ("order_items", "item_price", "item_price", None), ("order_items", "freight_cost", "freight_cost", None),
    ("order_items", "delivered_at", "delivered_at", None),
    ("order_payments", "payment_sequential", "payment_sequential", None),
    ("order_payments", "payment_installments", "payment_installments", None),
    ("order_payments", "payment_value", "payment_value", None),
    ("order_reviews", "review_score", "review_score", "INTEGER"),
    ("order_reviews", "review_creation_date", "review_creation_date", None),
    ("order_reviews", "review_answer_timestamp", "review_answer_timestamp", None),
]
ORACLE["cast_failures"] = with_star("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{out}' AS column_name, COUNT({src}) AS non_null_values, "
    + (f"COUNT(*) FILTER (WHERE {src} IS NOT NULL AND TRY_CAST(trim({src}) AS {typ}) IS NULL)" if typ
       else "CAST(0 AS BIGINT)")
    + f" AS failed_casts FROM raw_{t}"
    for t, out, src, typ in _TYPED
))

ORACLE["negative_review_mom_top20"] = ORACLE["negative_review_mom"] + \
    "\nORDER BY mom_change_pct DESC, review_month, category_family LIMIT 20"

ORACLE["event_payment_sequence"] = with_star("""
SELECT user_id, event_id, ts, value AS payment_value,
       ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS payment_sequential
FROM events WHERE event_type = 'purchase'""")

ORACLE["bronze_stream_append"] = "SELECT *, 'events-initial' AS batch_id FROM events"


_RESULT = "test_name, rows_evaluated, rows_failed, failure_pct"
ORACLE["publish_gate"] = f"""
SELECT {_RESULT}, passed, unit FROM ({ORACLE["ri_check_matrix"]}) a
UNION ALL
SELECT table_name || ' surrogate keys do not collide', surrogate_keys, colliding_keys,
       CASE WHEN surrogate_keys = 0 THEN 0.0 ELSE CAST(colliding_keys AS DOUBLE) / surrogate_keys * 100.0 END,
       colliding_keys = 0, 'values' FROM ({ORACLE["surrogate_key_collisions"]}) b
UNION ALL
SELECT {_RESULT}, rows_failed = 0 OR failure_pct <= 5.0, unit FROM ({ORACLE["unresolved_fk_rates"]}) c"""

# a refreshed fact equals the fact built at once
ORACLE["incremental_refresh"] = ORACLE["backfill_late"] = ORACLE["fact_order_item"]
ORACLE["refreshed_fact_payment"] = ORACLE["fact_payment"]
ORACLE["refreshed_fact_review"] = ORACLE["fact_review"]
ORACLE["affected_files"] = with_star(f"""
SELECT purchase_year, seller_state, COUNT(*) AS rows_held, COUNT(DISTINCT order_id) AS orders_held
FROM fact_order_item
WHERE order_id IN (SELECT order_id FROM ({_CONFORMED_ITEMS}) b WHERE delivered_at >= {_cutoff(30)})
GROUP BY ALL""")

ORACLE["late_event_routing"] = """
WITH w AS (SELECT max(ts) - INTERVAL 3600 SECONDS AS watermark FROM events)
SELECT 'on_time' AS table_name, COUNT(ts) + COUNT(*) FILTER (WHERE ts >= watermark) AS row_count FROM events, w
UNION ALL SELECT 'late', COUNT(*) FILTER (WHERE ts < watermark) FROM events, w
UNION ALL SELECT 'undated', 2 * COUNT(*) FILTER (WHERE ts IS NULL) FROM events"""

# two builds of the same inputs: as many rows, equal fingerprints
_SILVER_COUNTS = with_star(" UNION ALL ".join(
    f"SELECT 'silver_{t}' AS table_name, COUNT(*) AS row_count FROM silver_{t}"
    for t in ("customers", "sellers", "products", "orders", "order_items", "order_payments", "order_reviews")))
ORACLE["idempotency_check"] = f"""
SELECT table_name, row_count AS rows_a, row_count AS rows_b, TRUE AS "equal" FROM (
    SELECT * FROM ({_SILVER_COUNTS}) s UNION ALL SELECT * FROM ({ORACLE["row_count_report"]}) g) t"""


# ---------------------------------------------------------------- fingerprints, history, metrics, drift
def _portable(name: str, columns: str, src: str) -> str:
    """SHA-256 sums of rows as text; ``columns`` are name or name:kind (m money in cents, t timestamp, d date), sorted."""
    texts = []
    for item in columns.split():
        c, kind = (item + ":").split(":")[:2]
        text = {"m": f"CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)", "t": f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
                "d": f"strftime({c}, '%Y-%m-%d')"}.get(kind, f"CAST({c} AS VARCHAR)")
        texts.append(f"coalesce({text}, '\\N')")
    sums = ", ".join(
        f"CAST(coalesce(sum(CAST('0x' || substr(h, {16 * i + 1}, 16) AS UBIGINT)::HUGEINT), 0) AS VARCHAR) AS sha256_sum_{i}" for i in range(4))
    row = " || '|' || ".join(texts)
    return f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, {sums} FROM (SELECT sha256({row}) AS h FROM ({src}) r) x"


_FP = {
    "dim_customer": ("customer_city customer_id customer_resolved customer_state customer_unique_id customer_zip_code_prefix",
                     "SELECT *, customer_id IS NOT NULL AS customer_resolved FROM silver_customers"),
    "dim_seller": ("seller_city seller_id seller_resolved seller_state seller_zip_code_prefix",
                   "SELECT *, seller_id IS NOT NULL AS seller_resolved FROM silver_sellers"),
    "dim_product": ("category_family normalized_category product_category_name product_description_length product_height_cm product_id "
                    "product_length_cm product_name_length product_photos_qty product_resolved product_weight_g product_width_cm",
                    "SELECT *, product_id IS NOT NULL AS product_resolved FROM silver_products"),
    "dim_date": ("date:d date_key day_name day_of_month day_of_week month month_name quarter week_of_year year", "SELECT * FROM dim_date"),
    "fact_order_item": ("approved_at:t carrier_handoff_at:t customer_resolved delivered_at:t est_delivery_date:t freight_cost:m "
                        "item_price:m order_id order_item_id order_status product_resolved purchase_date_key purchase_year "
                        "purchased_at:t seller_resolved seller_state shipping_limit_date:t", _body("fact_order_item")),
    "fact_payment": ("customer_resolved order_id payment_date_key payment_installments payment_sequential payment_type payment_value:m "
                     "payment_year", _body("fact_payment")),
    "fact_review": ("category_family customer_resolved normalized_category order_id product_resolved review_answer_timestamp:t "
                    "review_creation_date:t review_date_key review_id review_score review_year", _body("fact_review")),
}
ORACLE["table_fingerprint"] = with_star("\nUNION ALL\n".join(_portable(n, cols, src) for n, (cols, src) in _FP.items()))
ORACLE["bucket_diff"] = ORACLE["table_diff"]
ORACLE["scd2_merge"] = ORACLE["scd2_history"]

_ITEM_COLUMNS = ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "item_price_c", "freight_cost_c",
                 "delivered_at")


def _run(run: str, items: str) -> str:
    nulls = "\nUNION ALL\n".join(
        f"SELECT 'order_items', 'null_rate:{c.removesuffix('_c')}', "
        f"coalesce(CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / nullif(COUNT(*), 0), 0) FROM {items}" for c in _ITEM_COLUMNS)
    fact = (f"(SELECT i.*, o.purchased_at, o.customer_id FROM {items} i LEFT JOIN silver_orders o ON i.order_id = o.order_id)")
    orphans = "\nUNION ALL\n".join(f"SELECT 'fact_order_item', 'orphans:{k}', 0" for k in (
        "customer_key", "seller_key", "product_key", "purchase_date_key"))
    return f"""
SELECT '{run}' AS run_id, * FROM (
  SELECT 'order_items' AS table_name, 'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM {items}
  UNION ALL {nulls}
  UNION ALL {orphans}
  UNION ALL SELECT 'fact_order_item', 'late_rows', COUNT(*) FROM {fact} f
    WHERE CAST(delivered_at AS DATE) - CAST(purchased_at AS DATE) > 365
  UNION ALL SELECT 'order_items', 'age_hours',
    CAST({_EPOCH.format(AS_OF)} - {_EPOCH.format('max(delivered_at)')} AS DOUBLE) / 3600.0 FROM {items}) m"""


_OLD_ITEMS = "(" + _latest(f"SELECT * FROM ({_CONFORMED_ITEMS}) c WHERE delivered_at < {_cutoff(180)}") + ")"
ORACLE["run_metric_deltas"] = with_star(f"""
SELECT 'after' AS run_id, a.table_name, a.metric, a.value, b.value AS previous_value, a.value - b.value AS delta,
       CASE WHEN b.value <> 0 THEN (a.value - b.value) / b.value * 100.0 END AS delta_pct
FROM ({_run('after', 'silver_order_items')}) a
LEFT JOIN ({_run('before', _OLD_ITEMS)}) b ON a.table_name = b.table_name AND a.metric = b.metric""")

# the renamed column is the one whose values overlap; the balance is text where any is negative
ORACLE["schema_drift"] = """
WITH old AS (SELECT * FROM customer),
new AS (SELECT c_custkey, c_name AS customer_name,
               CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal, c_mktsegment,
               length(c_name) AS name_length FROM customer),
alike AS (
  SELECT (SELECT COUNT(*) FROM (SELECT c_name FROM old INTERSECT SELECT customer_name FROM new))
         >= 0.5 * (SELECT COUNT(*) FROM (SELECT c_name FROM old UNION SELECT customer_name FROM new)) AS same_name)
SELECT 'c_name' AS column_name, 'renamed' AS change, 'customer_name' AS new_name, 'text' AS old_type, 'text' AS new_type,
       TRUE AS breaking FROM alike WHERE same_name
UNION ALL
SELECT 'c_acctbal', 'retyped', 'c_acctbal', 'decimal', 'text', TRUE
WHERE (SELECT COUNT(*) FROM new WHERE TRY_CAST(c_acctbal AS DOUBLE) IS NULL) > 0
UNION ALL
SELECT 'c_nationkey', 'removed', NULL, 'integer', NULL, TRUE
WHERE (SELECT COUNT(*) FROM (SELECT c_nationkey FROM old INTERSECT SELECT name_length FROM new))
      < 0.5 * (SELECT COUNT(*) FROM (SELECT c_nationkey FROM old UNION SELECT name_length FROM new))
UNION ALL
SELECT NULL, 'added', 'name_length', NULL, 'integer', FALSE"""

ORACLE["fact_payment_events"] = with_star(f"""
SELECT CAST(NULL AS BIGINT) AS order_id,
       CAST(row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) AS INTEGER) AS payment_sequential,
       c.customer_id IS NOT NULL AS customer_resolved,
       CAST(year(e.ts) * 10000 + month(e.ts) * 100 + day(e.ts) AS INTEGER) AS payment_date_key,
       CAST(year(e.ts) AS INTEGER) AS payment_year, 'event' AS payment_type, CAST(NULL AS INTEGER) AS payment_installments,
       CAST({cents_sql('e.value')} AS DOUBLE) / 100.0 AS payment_value
FROM events e LEFT JOIN silver_customers c ON e.user_id = c.customer_id
WHERE e.event_type = 'purchase'""")
