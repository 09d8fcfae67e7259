"""Declarative data-quality rules, the DQ report and the publication gate.

Result rows have the schema of ``RESULT_SCHEMA``: test_name, rows_evaluated
(NULL = not applicable), rows_failed, failure_pct (0.0 when nothing was
evaluated, NULL when not applicable), passed, and unit (rows / groups /
values / tables) so that different denominators are not mixed up.

Execution plan per rule kind:
* row rules of one table: one aggregate pass (``count_if`` per rule), then
  unpivot; partial aggregation runs map-side;
* grain rules: ``groupBy(grain).count()`` then a global aggregate of the
  group counts (no group is collected);
* referential integrity: the fact is first reduced to (fk, rows) with
  partial aggregation, for all its relations at once, then joined to the
  distinct dimension keys, so the shuffle carries distinct keys instead of
  fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("test_name", T.StringType(), False),
    T.StructField("rows_evaluated", T.LongType(), True),
    T.StructField("rows_failed", T.LongType(), True),
    T.StructField("failure_pct", T.DoubleType(), True),
    T.StructField("passed", T.BooleanType(), True),
    T.StructField("unit", T.StringType(), True),
])

FRESHNESS_HOURS = 24


@dataclass(frozen=True)
class RowRule:
    """``fails_when`` is evaluated on rows where ``applies_when`` holds (None = all rows)."""

    name: str
    fails_when: Column
    applies_when: Column | None = None
    unit: str = "rows"


def _finish(evaluated: Column, failed: Column) -> list[Column]:
    pct = F.when(evaluated.isNull(), F.lit(None).cast("double")).when(evaluated == 0, F.lit(0.0)).otherwise(
        failed.cast("double") / evaluated.cast("double") * F.lit(100.0)
    )
    return [
        evaluated.cast("long").alias("rows_evaluated"),
        failed.cast("long").alias("rows_failed"),
        pct.alias("failure_pct"),
        (failed == 0).alias("passed"),
    ]


def result(df_one_row: DataFrame, name: str, evaluated: str | None, failed: str, unit: str) -> DataFrame:
    ev = F.col(evaluated) if evaluated else F.lit(None).cast("long")
    return df_one_row.select(F.lit(name).alias("test_name"), *_finish(ev, F.col(failed)), F.lit(unit).alias("unit"))


def row_rules(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Evaluate all row rules of one table in a single aggregate pass."""
    aggs = []
    for i, r in enumerate(rules):
        applies = r.applies_when if r.applies_when is not None else F.lit(True)
        aggs += [F.count_if(applies).alias(f"e{i}"), F.count_if(applies & r.fails_when).alias(f"f{i}")]
    return _unpivoted(df.agg(*aggs), [(r.name, r.unit) for r in rules])


def _unpivoted(one: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Result rows of (name, unit) rules from one row with columns e0, f0, e1, f1, ..."""
    rows = F.inline(F.array(*(
        F.struct(F.lit(name).alias("test_name"), F.col(f"e{i}").alias("e"), F.col(f"f{i}").alias("f"), F.lit(unit).alias("unit"))
        for i, (name, unit) in enumerate(rules)
    )))
    return one.select(rows).select("test_name", *_finish(F.col("e"), F.col("f")), "unit")


def grain_rule(df: DataFrame, grain: Sequence[str], name: str) -> DataFrame:
    """Groups of the grain (evaluated) and groups with more than one row (failed)."""
    counts = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n"))
    one = counts.agg(F.count(F.lit(1)).alias("e"), F.count_if(F.col("_n") > 1).alias("f"))
    return result(one, name, "e", "f", "groups")


def ri_rule(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str) -> DataFrame:
    """Fact rows with a non-NULL foreign key that has no dimension row."""
    keys = fact.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    dims = dim.select(F.col(pk).alias("_k")).where(F.col("_k").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    one = keys.join(dims, "_k", "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("e"),
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).alias("f"),
    )
    return result(one, name, "e", "f", "rows")


def ri_rules(fact: DataFrame, relations: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """``ri_rule`` for several relations (name, fk, dim, pk) of one fact in one pass over it.

    The fact is reduced to (relation, key, rows) once, the dimensions' keys are
    one table, and one aggregate gives all results.
    """
    integral = all(d.schema[pk].dataType.typeName() in ("long", "integer", "short", "byte")
                   and fact.schema[fk].dataType.typeName() in ("long", "integer", "short", "byte") for _, fk, d, pk in relations)
    kind = "long" if integral else "string"
    fks = F.array(*(F.struct(F.lit(i).alias("_r"), F.col(fk).cast(kind).alias("_k")) for i, (_, fk, _, _) in enumerate(relations)))
    keys = fact.select(F.inline(fks)).where("_k IS NOT NULL").groupBy("_r", "_k").agg(F.count(F.lit(1)).alias("_n"))
    dims = union_all([d.select(F.lit(i).alias("_r"), F.col(pk).cast(kind).alias("_k")) for i, (_, _, d, pk) in enumerate(relations)])
    known = dims.where("_k IS NOT NULL").distinct().withColumn("_hit", F.lit(True))
    n, zero = F.col("_n"), F.lit(0)
    counts = []
    for i in range(len(relations)):
        mine = F.col("_r") == i
        counts += [F.coalesce(F.sum(F.when(mine, n)), zero).alias(f"e{i}"),
                   F.coalesce(F.sum(F.when(mine & F.col("_hit").isNull(), n)), zero).alias(f"f{i}")]
    return _unpivoted(keys.join(known, ["_r", "_k"], "left").agg(*counts), [(name, "rows") for name, *_ in relations])


def ri_orphan_rows(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """The failing rows of an RI rule (NULL keys are not orphans)."""
    return fact.where(F.col(fk).isNotNull()).join(
        dim.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull()), fk, "left_anti"
    )


def _epoch_seconds(ts: Column) -> Column:
    """Whole seconds of a wall-clock timestamp since 1970-01-01 (fraction dropped), zone-free."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, ts.cast("timestamp_ntz"))


def age_hours(latest: Column, as_of: Column) -> Column:
    """(whole seconds of ``as_of``) - (whole seconds of ``latest``), in hours.

    As ``unix_timestamp(a) - unix_timestamp(b)``, but both sides are read as
    wall-clock (NTZ) timestamps, so the result does not depend on the session
    time zone and a daylight-saving change between them adds no hour.
    """
    return (_epoch_seconds(as_of) - _epoch_seconds(latest)) / F.lit(3600.0)


def malformed_rows_rule(bronze: DataFrame, name: str, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Raw lines that did not parse into the declared columns (captured at read time)."""
    if corrupt_col not in bronze.columns:
        return row_rules(bronze, [RowRule(name, F.lit(False))])
    return row_rules(bronze, [RowRule(name, F.col(corrupt_col).isNotNull())])


def freshness_rule(df: DataFrame, ts_col: str, as_of: Column, name: str,
                   max_hours: float = FRESHNESS_HOURS) -> DataFrame:
    """Pass when 0 <= as_of - max(ts) <= max_hours. Empty table / NULL max -> fail, no exception.

    Age is whole seconds / 3600 (fractions of a second dropped). ``as_of`` is explicit so the rule is testable;
    pass ``F.current_timestamp()`` in production.
    """
    latest = df.agg(F.max(ts_col).alias("_m"))
    age = age_hours(F.col("_m"), as_of)
    ok = F.coalesce((age >= 0) & (age <= F.lit(float(max_hours))), F.lit(False))
    one = latest.select(F.when(ok, 0).otherwise(1).alias("f"), age.alias("age_hours"))
    return result(one, name, None, "f", "tables")


def freshness_by_table(tables: dict[str, tuple[DataFrame, str]], as_of: Column,
                       max_hours: float = FRESHNESS_HOURS) -> DataFrame:
    """(table_name, latest_ts, age_hours, fresh) for each (df, ts column)."""
    parts = []
    for name, (df, ts) in tables.items():
        latest = df.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("latest_ts"))
        age = age_hours(F.col("latest_ts"), as_of)
        parts.append(latest.select(
            F.lit(name).alias("table_name"), "latest_ts", age.alias("age_hours"),
            F.coalesce((age >= 0) & (age <= F.lit(float(max_hours))), F.lit(False)).alias("fresh"),
        ))
    return union_all(parts)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ the suite
# fixed values: the labels of the 16 checks, in report order
CHECK_NAMES = (
    "dim_customer.customer_key is non-null",
    "dim_seller.seller_key is non-null",
    "dim_product.product_key is non-null",
    "fact_order_item.customer_key has no orphans",
    "fact_order_item.product_key has no orphans",
    "fact_order_item has unique (order_id, order_item_id) grain",
    "fact_payment has unique (order_id, payment_sequential) grain",
    "delivered_at is not before purchased_at",
    "payment_value is non-negative",
    "all non-null product categories are mapped to taxonomy",
    "fact_review has unique (review_id, order_id, product_key) grain",
    "fact_review scores are between 1 and 5",
    "fact_review.review_date_key has no orphans",
    "fact_review.customer_key has no orphans",
    "fact_review.product_key has no orphans",
)
RELATION_CHECKS = {  # fact -> (label, foreign key, dimension, key)
    "fact_order_item": ((CHECK_NAMES[3], "customer_key", "dim_customer", "customer_key"),
                        (CHECK_NAMES[4], "product_key", "dim_product", "product_key")),
    "fact_review": ((CHECK_NAMES[12], "review_date_key", "dim_date", "date_key"),
                    (CHECK_NAMES[13], "customer_key", "dim_customer", "customer_key"),
                    (CHECK_NAMES[14], "product_key", "dim_product", "product_key")),
}
GRAIN_CHECKS = (  # (label, fact, grain)
    (CHECK_NAMES[5], "fact_order_item", ("order_id", "order_item_id")),
    (CHECK_NAMES[6], "fact_payment", ("order_id", "payment_sequential")),
    (CHECK_NAMES[10], "fact_review", ("review_id", "order_id", "product_key")),
)


def fresh_name(max_hours: float = FRESHNESS_HOURS) -> str:
    return f"Bronze ingestion is fresh (<= {max_hours:g} hours)"


def row_checks() -> dict[str, list[RowRule]]:
    """The row rules of the suite by table: each table is scanned once for all of its rules."""
    return {
        "dim_customer": [RowRule(CHECK_NAMES[0], F.col("customer_key").isNull())],
        "dim_seller": [RowRule(CHECK_NAMES[1], F.col("seller_key").isNull())],
        "dim_product": [
            RowRule(CHECK_NAMES[2], F.col("product_key").isNull()),
            RowRule(CHECK_NAMES[9], F.col("normalized_category").isNull() | F.col("category_family").isNull(),
                    F.col("product_category_name").isNotNull()),
        ],
        "fact_order_item": [RowRule(CHECK_NAMES[7], F.col("delivered_at") < F.col("purchased_at"),
                                    F.col("delivered_at").isNotNull() & F.col("purchased_at").isNotNull())],
        "fact_payment": [RowRule(CHECK_NAMES[8], F.col("payment_value") < 0, F.col("payment_value").isNotNull())],
        "fact_review": [RowRule(CHECK_NAMES[11], F.col("review_score").isNull() | ~F.col("review_score").between(1, 5))],
    }


def dq_report(gold: dict[str, DataFrame], fresh_df: DataFrame, fresh_ts: str, as_of: Column,
              max_hours: float = FRESHNESS_HOURS) -> DataFrame:
    """The 16-row suite: 15 Gold checks plus Bronze freshness, with a check number.

    One aggregate per table for row rules, one per fact for relations, one per grain.
    """
    parts = [row_rules(gold[t], rules) for t, rules in row_checks().items()]
    parts += [ri_rules(gold[f], [(n, fk, gold[d], pk) for n, fk, d, pk in rels]) for f, rels in RELATION_CHECKS.items()]
    parts += [grain_rule(gold[f], list(grain), name) for name, f, grain in GRAIN_CHECKS]
    parts.append(freshness_rule(fresh_df, fresh_ts, as_of, fresh_name(max_hours), max_hours))
    names = F.array(*map(F.lit, [*CHECK_NAMES, fresh_name(max_hours)]))
    return union_all(parts).select(F.array_position(names, F.col("test_name")).cast("int").alias("check_no"),
                                   *[f.name for f in RESULT_SCHEMA.fields])


def key_collision_rules(gold: dict[str, DataFrame]) -> DataFrame:
    """``surrogate_key_collisions`` as result rows: surrogate keys (evaluated) shared by several natural keys (failed)."""
    named = surrogate_key_collisions(gold).withColumn(
        "test_name", F.concat("table_name", F.lit(" surrogate keys do not collide")))
    return named.select("test_name", *_finish(F.col("surrogate_keys"), F.col("colliding_keys")), F.lit("values").alias("unit"))


def with_tolerance(report: DataFrame, max_pct: float | None) -> DataFrame:
    """Rules pass up to ``max_pct`` percent of failing rows (None: always, the rates are only reported)."""
    ok = F.lit(True) if max_pct is None else F.coalesce((F.col("rows_failed") == 0) | (F.col("failure_pct") <= max_pct), F.lit(False))
    return report.withColumn("passed", ok)


def build_checks(gold: dict[str, DataFrame], max_unresolved_pct: float | None = None) -> DataFrame:
    """Build-time gate besides the suite: nine RI relations, key collisions, unresolved foreign keys.

    ``max_unresolved_pct``: tolerated share of fact rows whose foreign key did
    not resolve (a left-joined fact keeps such rows, so RI alone cannot see them).
    """
    return union_all([ri_check_matrix(gold), key_collision_rules(gold),
                      with_tolerance(unresolved_fk_rates(gold), max_unresolved_pct)])


class QualityGateError(RuntimeError):
    pass


def assert_passed(report: DataFrame) -> None:
    """Raise if any rule failed. The report has one row per rule, so this
    action moves a fixed, small number of rows to the driver."""
    failed = report.where(~F.coalesce("passed", F.lit(False))).select("test_name", "rows_failed").collect()
    if failed:
        names = ", ".join(f"{r.test_name} ({r.rows_failed})" for r in failed)
        raise QualityGateError(f"{len(failed)} data-quality checks failed: {names}")


def validate_fact_grain(fact: DataFrame, grain: Sequence[str], fact_name: str) -> None:
    """Raise when the fact has duplicated grain groups (build-time assertion)."""
    r = grain_rule(fact, grain, f"{fact_name} grain").first()
    if r.rows_failed:
        raise QualityGateError(f"{fact_name}: {r.rows_failed} keys of its grain ({', '.join(grain)}) have several rows")


def validate_referential_integrity(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> None:
    """Raise when non-NULL foreign keys have no dimension row (build-time assertion)."""
    r = ri_rule(fact, fk, dim, pk, f"{fk} -> {pk}").first()
    if r.rows_failed:
        raise QualityGateError(f"{r.rows_failed} rows hold a {fk} that no {pk} of the dimension matches")


RI_RELATIONS = (
    ("fact_order_item", "customer_key", "dim_customer", "customer_key"),
    ("fact_order_item", "seller_key", "dim_seller", "seller_key"),
    ("fact_order_item", "product_key", "dim_product", "product_key"),
    ("fact_order_item", "purchase_date_key", "dim_date", "date_key"),
    ("fact_payment", "customer_key", "dim_customer", "customer_key"),
    ("fact_payment", "payment_date_key", "dim_date", "date_key"),
    ("fact_review", "customer_key", "dim_customer", "customer_key"),
    ("fact_review", "product_key", "dim_product", "product_key"),
    ("fact_review", "review_date_key", "dim_date", "date_key"),
)


def ri_check_matrix(gold: dict[str, DataFrame]) -> DataFrame:
    """The nine build-time RI relations as result rows, one pass per fact."""
    by_fact: dict[str, list] = {}
    for f, fk, d, pk in RI_RELATIONS:
        by_fact.setdefault(f, []).append((f"{f}.{fk} -> {d}.{pk}", fk, gold[d], pk))
    return union_all([ri_rules(gold[f], rels) for f, rels in by_fact.items()])


FK_COLUMNS = {
    "fact_order_item": ("customer_key", "seller_key", "product_key", "purchase_date_key"),
    "fact_payment": ("customer_key", "payment_date_key"),
    "fact_review": ("customer_key", "product_key", "review_date_key"),
}


def unresolved_fk_rates(gold: dict[str, DataFrame]) -> DataFrame:
    """Share of fact rows whose foreign key is NULL (unresolved or missing natural key).

    RI checks exclude NULL keys, so a left-joined fact can never have orphans;
    this rule shows how many rows did not resolve. One pass per fact.
    """
    parts = []
    for fact, fks in FK_COLUMNS.items():
        parts.append(row_rules(gold[fact], [RowRule(f"{fact}.{fk} is resolved", F.col(fk).isNull()) for fk in fks]))
    return union_all(parts)


DIM_KEYS = {
    "dim_customer": ("customer_id", "customer_key"),
    "dim_seller": ("seller_id", "seller_key"),
    "dim_product": ("product_id", "product_key"),
}


def surrogate_key_collisions(gold: dict[str, DataFrame]) -> DataFrame:
    """Per dimension: distinct natural keys, distinct surrogate keys, colliding surrogate keys.

    A 64-bit hash key collides with noticeable probability only near 2^32
    keys; this check makes a collision a reported failure instead of a silent
    merge of two members.
    """
    parts = []
    for dim, (nk, sk) in DIM_KEYS.items():
        per_key = gold[dim].where(F.col(nk).isNotNull()).groupBy(sk).agg(F.count_distinct(nk).alias("_n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("natural_keys"),
            F.count(F.lit(1)).alias("surrogate_keys"),
            F.count_if(F.col("_n") > 1).alias("colliding_keys"),
        ).select(F.lit(dim).alias("table_name"), "natural_keys", "surrogate_keys", "colliding_keys"))
    return union_all(parts)
