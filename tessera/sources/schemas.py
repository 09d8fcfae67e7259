"""Declared schemas.

Raw (Bronze) payload columns are all strings: typing happens once, in Silver,
with try_* conversions, so one malformed value never fails a job and a type
change between batches never makes a Bronze folder unreadable.

Silver specs list (output column, source column, kind, required). Kinds:
``id`` trim strings / keep typed ids, ``upper`` / ``lower`` / ``text`` string
standardisation, ``int`` / ``double`` / ``money`` / ``ts`` typed values.
Optional columns (required=False) are kept only when the source carries them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def string_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Raw column names of the marketplace export (including the
# source's own spelling "lenght"), one tuple per raw data set.
RAW_COLUMNS = {
    "customers": ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
    "orders": (
        "order_id", "customer_id", "order_status", "purchased_at", "approved_at",
        "carrier_handoff_at", "delivered_at", "est_delivery_date",
    ),
    "order_items": (
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "item_price", "freight_cost",
    ),
    "order_payments": ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    "order_reviews": (
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ),
    "products": (
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "geolocation": (
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state",
    ),
    "taxonomy": ("source_category", "normalized_category", "category_family"),
}

RAW_SCHEMAS = {name: string_schema(*cols) for name, cols in RAW_COLUMNS.items()}

# Tables whose free-text columns may contain quoted newlines: only these are
# read with multiLine (a multiLine CSV file cannot be split across tasks).
MULTILINE_TABLES = frozenset({"order_reviews"})


@dataclass(frozen=True)
class Col:
    out: str
    src: str
    kind: str
    required: bool = True


@dataclass(frozen=True)
class SilverSpec:
    name: str
    columns: tuple[Col, ...]
    keys: tuple[str, ...] = ()          # dedupe key; () = whole row
    latest_by: tuple[str, ...] = ("ingestion_ts",)
    notes: str = field(default="")


def _c(out, kind, src=None, required=True):
    return Col(out, src or out, kind, required)


SILVER_SPECS = {
    "customers": SilverSpec(
        "customers",
        (
            _c("customer_id", "id"), _c("customer_unique_id", "id"), _c("customer_zip_code_prefix", "text"),
            _c("customer_city", "upper"), _c("customer_state", "upper"),
        ),
        keys=("customer_id",),
    ),
    "orders": SilverSpec(
        "orders",
        (
            _c("order_id", "id"), _c("customer_id", "id"), _c("order_status", "lower"),
            _c("purchased_at", "ts"), _c("approved_at", "ts"), _c("carrier_handoff_at", "ts"),
            _c("delivered_at", "ts"), _c("est_delivery_date", "ts"),
        ),
        keys=("order_id",),
    ),
    "products": SilverSpec(
        "products",
        (
            _c("product_id", "id"), _c("product_category_name", "text"),
            _c("product_name_length", "int", "product_name_lenght"),
            _c("product_description_length", "int", "product_description_lenght"),
            _c("product_photos_qty", "int"), _c("product_weight_g", "int"), _c("product_length_cm", "int"),
            _c("product_height_cm", "int"), _c("product_width_cm", "int"),
        ),
        keys=("product_id",),
    ),
    "sellers": SilverSpec(
        "sellers",
        (
            _c("seller_id", "id"), _c("seller_zip_code_prefix", "text"), _c("seller_city", "upper"),
            _c("seller_state", "upper"),
        ),
        keys=("seller_id",),
    ),
    "order_items": SilverSpec(
        "order_items",
        (
            _c("order_id", "id"), _c("order_item_id", "int"), _c("product_id", "id"), _c("seller_id", "id"),
            _c("shipping_limit_date", "ts"), _c("item_price", "money"), _c("freight_cost", "money"),
            # item-level delivery time, when a source records delivery per item
            _c("delivered_at", "ts", required=False),
        ),
        keys=("order_id", "order_item_id"),
    ),
    "order_payments": SilverSpec(
        "order_payments",
        (
            _c("order_id", "id"), _c("payment_sequential", "int"), _c("payment_type", "lower"),
            _c("payment_installments", "int"), _c("payment_value", "money"),
        ),
        keys=("order_id", "payment_sequential"),
    ),
    "order_reviews": SilverSpec(
        "order_reviews",
        (
            _c("review_id", "id"), _c("order_id", "id"), _c("review_score", "int"),
            _c("review_comment_title", "text"), _c("review_comment_message", "text"),
            _c("review_creation_date", "ts"), _c("review_answer_timestamp", "ts"),
        ),
        keys=("review_id", "order_id"),
    ),
    "geolocation": SilverSpec(
        "geolocation",
        (
            _c("geolocation_zip_code_prefix", "text"), _c("geolocation_lat", "double"),
            _c("geolocation_lng", "double"), _c("geolocation_city", "upper"), _c("geolocation_state", "upper"),
        ),
        keys=(),
    ),
}
