"""The failing rows of every data-quality rule.

The row rules of a table are compiled into one bitmask column, so a table is
scanned once however many rules it has: ``rule_bits`` adds the mask,
``exploded`` turns set bits into (rule, key) rows. Rules over several rows feed
the same table: a referential rule becomes a bit too (the few keys without a
dimension row are joined to the fact), a grain rule gives one row for each
group that has several.

Counts per rule equal the ``rows_failed`` of ``quality.dq_report``, rule by rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import quality as Q

NULL_KEY = "NULL"


@dataclass(frozen=True)
class Relation:
    """Rows of a table whose ``fk`` is not NULL and not among ``pk`` of ``dim`` fail."""

    name: str
    fk: str
    dim: DataFrame
    pk: str


def row_key(keys: Sequence[str]) -> Column:
    """A row's key as text: values joined by ``|``, NULL as ``NULL``."""
    return F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)) for k in keys))


def rule_bits(df: DataFrame, rules: Sequence[Q.RowRule], relations: Sequence[Relation] = ()) -> DataFrame:
    """Add ``_bits``: bit i is set where rule i (row rules, then relations) fails.

    A rule whose condition is NULL does not fail, as in the report.
    """
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        fails = rule.fails_when if rule.applies_when is None else rule.applies_when & rule.fails_when
        bits = bits + F.when(fails, F.lit(1 << i).cast("long")).otherwise(0)
    out = df.withColumn("_bits", bits)
    for i, rel in enumerate(relations, len(rules)):
        known = rel.dim.select(F.col(rel.pk).alias(rel.fk)).where(F.col(rel.fk).isNotNull())
        # distinct keys without a dimension row: a fraction of the keys, joined back to the rows; written, so that
        # their real size is known and the rows need no shuffle where few keys (or none) are lost
        lost = materialize(df.select(rel.fk).where(F.col(rel.fk).isNotNull()).distinct().join(known, rel.fk, "left_anti"), "lost-keys")
        out = out.join(lost.withColumn("_lost", F.lit(1 << i).cast("long")), rel.fk, "left").withColumn(
            "_bits", F.col("_bits") + F.coalesce("_lost", F.lit(0).cast("long"))).drop("_lost")
    return out


def exploded(marked: DataFrame, table: str, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows (test_name, table_name, row_key), one for every set bit of ``_bits``."""
    failing = F.array_compact(F.array(*(F.when(F.col("_bits").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(n))
                                        for i, n in enumerate(names))))
    rows = marked.where("_bits <> 0").select(row_key(keys).alias("row_key"), F.explode(failing).alias("test_name"))
    return rows.select("test_name", F.lit(table).alias("table_name"), "row_key")


def failing_rows(df: DataFrame, table: str, keys: Sequence[str], rules: Sequence[Q.RowRule] = (),
                 relations: Sequence[Relation] = ()) -> DataFrame:
    """All failing rows of a table's row rules and relations."""
    names = [r.name for r in rules] + [r.name for r in relations]
    return exploded(rule_bits(df, rules, relations), table, names, keys)


def failing_groups(df: DataFrame, table: str, grain: Sequence[str], name: str) -> DataFrame:
    """One row for each group of the grain that has several rows."""
    groups = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return groups.select(F.lit(name).alias("test_name"), F.lit(table).alias("table_name"), row_key(grain).alias("row_key"))


def gold_violations(gold: dict[str, DataFrame], fresh_df: DataFrame, fresh_ts: str, as_of: Column,
                    max_hours: float = Q.FRESHNESS_HOURS) -> DataFrame:
    """Failing rows (test_name, table_name, row_key) of the 16 checks of ``quality.dq_report``."""
    keys = {"dim_customer": ["customer_id"], "dim_seller": ["seller_id"], "dim_product": ["product_id"],
            "fact_order_item": ["order_id", "order_item_id"], "fact_payment": ["order_id", "payment_sequential"],
            "fact_review": ["review_id", "order_id", "product_key"]}
    parts = [failing_rows(gold[t], t, keys[t], rules, [
        Relation(n, fk, gold[dim], pk) for n, fk, dim, pk in Q.RELATION_CHECKS.get(t, ())]) for t, rules in Q.row_checks().items()]
    parts += [failing_groups(gold[t], t, grain, name) for name, t, grain in Q.GRAIN_CHECKS]
    stale = Q.freshness_rule(fresh_df, fresh_ts, as_of, Q.fresh_name(max_hours), max_hours).where("NOT passed")
    parts.append(stale.select("test_name", F.lit("bronze").alias("table_name"), F.lit("").alias("row_key")))
    return Q.union_all(parts)
