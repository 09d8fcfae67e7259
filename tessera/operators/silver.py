"""Silver: typed, cleaned, deduplicated tables (one operator per data set)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..sources.schemas import SILVER_SPECS, Col, SilverSpec
from .dedupe import dedupe_latest, dedupe_rows
from .taxonomy import enrich_taxonomy

_KIND = {
    "id": C.clean_id,
    "upper": C.clean_upper,
    "lower": C.clean_lower,
    "text": C.clean_text,
    "int": C.to_int,
    "double": C.to_double,
    "money": C.to_money,
    "ts": C.to_ts,
}

_NULL_TYPE = {
    "id": T.StringType(), "upper": T.StringType(), "lower": T.StringType(), "text": T.StringType(),
    "int": T.IntegerType(), "double": T.DoubleType(), "money": C.MONEY, "ts": T.TimestampNTZType(),
}


def _expr(df: DataFrame, col: Col) -> Column | None:
    if col.src in df.columns:
        return _KIND[col.kind](df, col.src).alias(col.out)
    if col.required:
        # a raw file that lacks a declared column yields NULLs (schema drift is
        # reported separately by incremental.schema_drift)
        return F.lit(None).cast(_NULL_TYPE[col.kind]).alias(col.out)
    return None


def conform(df: DataFrame, spec: SilverSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Project, rename and type the raw columns according to ``spec``.

    ``keep`` passes extra columns through untouched (e.g. ``ingestion_ts`` for
    the dedupe order); they are dropped after deduplication.
    """
    exprs = [e for e in (_expr(df, c) for c in spec.columns) if e is not None]
    extra = [F.col(k) for k in keep if k in df.columns]
    return df.select(*exprs, *extra)


TYPED_KINDS = ("int", "double", "money", "ts")


def cast_failures(raw: DataFrame, spec: SilverSpec, table_name: str | None = None) -> DataFrame:
    """Per typed column: non-NULL raw values and how many of them failed to convert.

    Silver converts with try_* functions, so a bad value becomes NULL instead
    of failing the job; this one-pass profile counts those values (a value-level
    signal of schema drift, e.g. text arriving in a numeric column).
    """
    cols = [c for c in spec.columns if c.kind in TYPED_KINDS and c.src in raw.columns]
    if not cols:
        return raw.sparkSession.createDataFrame(
            [], "table_name string, column_name string, non_null_values bigint, failed_casts bigint")
    aggs = []
    for i, c in enumerate(cols):
        src = F.col(c.src)
        aggs += [F.count_if(src.isNotNull()).alias(f"n{i}"),
                 F.count_if(src.isNotNull() & _KIND[c.kind](raw, c.src).isNull()).alias(f"f{i}")]
    one = raw.agg(*aggs)
    rows = F.explode(F.array(*(
        F.struct(F.lit(c.out).alias("column_name"), F.col(f"n{i}").alias("non_null_values"), F.col(f"f{i}").alias("failed_casts"))
        for i, c in enumerate(cols)
    )))
    return one.select(F.lit(table_name or spec.name).alias("table_name"), rows.alias("r")).select("table_name", "r.*")


def current_failed_casts(raw: DataFrame, spec: SilverSpec) -> DataFrame:
    """One row, ``failed``: rows with a value that does not convert and that no later version of their key replaces.

    Only the keys of rows with such values (rare) are deduplicated again.
    """
    typed = [c for c in spec.columns if c.kind in TYPED_KINDS and c.src in raw.columns]
    bad = F.lit(False)
    for c in typed:
        bad = bad | (F.col(c.src).isNotNull() & _KIND[c.kind](raw, c.src).isNull())
    order = [c for c in spec.latest_by if c in raw.columns]
    rows = conform(raw.withColumn("_bad", bad), spec, keep=["_bad", *(c for c in order if c not in _outs(spec))])
    if spec.keys:
        keys = rows.where("_bad").select(*(F.col(k).alias(f"_k_{k}") for k in spec.keys)).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in spec.keys]
        rows = dedupe_latest(rows.join(keys, same, "left_semi"), spec.keys, order)
    return rows.agg(F.count_if("_bad").alias("failed"))


def build_silver(raw: DataFrame, spec: SilverSpec, latest_by: Sequence[str] | None = None,
                 place: tuple[int, str] | None = None) -> DataFrame:
    """conform -> latest-wins dedupe on the spec key -> drop batch metadata.

    ``place``: deal the rows out into so many partitions by this part of the key
    before the dedupe, which then shuffles nothing; the result lies by it.
    """
    order = tuple(latest_by) if latest_by is not None else spec.latest_by
    typed = conform(raw, spec, keep=[c for c in order if c not in {x.out for x in spec.columns}])
    typed = typed.repartition(*place) if place else typed
    if spec.keys:
        out = dedupe_latest(typed, spec.keys, order)
    else:
        out = dedupe_rows(typed.drop(*[c for c in order if c in typed.columns and c not in _outs(spec)]))
    return out.drop(*[c for c in order if c in out.columns and c not in _outs(spec)])


def _outs(spec: SilverSpec) -> set[str]:
    return {c.out for c in spec.columns}


def silver_customers(raw: DataFrame, latest_by=None) -> DataFrame:
    return build_silver(raw, SILVER_SPECS["customers"], latest_by)


def silver_orders(raw: DataFrame, latest_by=None, place=None) -> DataFrame:
    return build_silver(raw, SILVER_SPECS["orders"], latest_by, place)


def silver_sellers(raw: DataFrame, latest_by=None) -> DataFrame:
    return build_silver(raw, SILVER_SPECS["sellers"], latest_by)


def silver_order_items(raw: DataFrame, latest_by=None, place=None) -> DataFrame:
    return build_silver(raw, SILVER_SPECS["order_items"], latest_by, place)


def silver_order_payments(raw: DataFrame, latest_by=None, place=None) -> DataFrame:
    return build_silver(raw, SILVER_SPECS["order_payments"], latest_by, place)


def silver_order_reviews(raw: DataFrame, latest_by=None, place=None) -> DataFrame:
    """Reviews deduped on (review_id, order_id): a review id may cover two orders."""
    return build_silver(raw, SILVER_SPECS["order_reviews"], latest_by, place)


def silver_geolocation(raw: DataFrame) -> DataFrame:
    """Geolocation has no key: exact duplicate rows (re-ingestions) collapse."""
    return build_silver(raw, SILVER_SPECS["geolocation"])


def silver_products(raw: DataFrame, taxonomy: DataFrame, latest_by=None) -> DataFrame:
    """Products deduped first, then enriched: the lookup join never multiplies rows."""
    base = build_silver(raw, SILVER_SPECS["products"], latest_by)
    enriched = enrich_taxonomy(base, taxonomy, "product_category_name")
    order = [c.out for c in SILVER_SPECS["products"].columns]
    return enriched.select(*order[:2], "normalized_category", "category_family", *order[2:])
