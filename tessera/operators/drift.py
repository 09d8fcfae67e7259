"""Schema drift between two versions of a table, renames included.

Names alone cannot tell a renamed column from one that went and another that
came. ``column_profiles`` describes every column in one pass: the most special
type all its values fit (integer, decimal, timestamp, boolean, else text), its
share of NULLs, and two mergeable distinct-count sketches, of its values and of
their shapes (letters and digits replaced by one sign each). A column that is
missing and one that is new are the same column under another name if their
types agree and their sketches overlap, each being the other's best match.

Everything collected is one row a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIKE = 0.5
SHAPES_LIKE = 0.9
# the types a value can fit, special ones first; a type further right takes those it is listed for
WIDER = {"integer": ("decimal", "text"), "decimal": ("text",), "timestamp": ("text",), "boolean": ("text",), "empty": (
    "integer", "decimal", "timestamp", "boolean", "text")}


def _shape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\p{L}+", "a"), r"[0-9]+", "9")


def column_profiles(df: DataFrame) -> DataFrame:
    """One row a column: column_name, declared_type, kind, null_rate, and the sketches ``values`` and ``shapes``."""
    rows = []
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, field in enumerate(df.schema):
        text = F.trim(F.col(f"`{field.name}`").cast("string"))
        aggs += [
            F.count(text).alias(f"_n{i}"),
            F.count_if(F.expr("TRUE") & text.rlike(r"^[+-]?[0-9]{1,18}$")).alias(f"_i{i}"),
            F.count_if(text.try_cast("double").isNotNull() & ~text.rlike("(?i)^[+-]?(nan|inf|infinity)$")).alias(f"_d{i}"),
            F.count_if(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}") & text.try_cast("timestamp_ntz").isNotNull()).alias(f"_t{i}"),
            F.count_if(F.lower(text).isin("true", "false")).alias(f"_b{i}"),
            F.hll_sketch_agg(text).alias(f"_v{i}"), F.hll_sketch_agg(_shape(text)).alias(f"_s{i}"),
        ]
        n = F.col(f"_n{i}")
        kind = (F.when(n == 0, "empty").when(F.col(f"_i{i}") == n, "integer").when(F.col(f"_d{i}") == n, "decimal")
                .when(F.col(f"_t{i}") == n, "timestamp").when(F.col(f"_b{i}") == n, "boolean").otherwise("text"))
        rows.append(F.struct(
            F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("declared_type"), kind.alias("kind"),
            F.try_divide((F.col("_rows") - n).cast("double"), F.col("_rows").cast("double")).alias("null_rate"),
            F.col(f"_v{i}").alias("values"), F.col(f"_s{i}").alias("shapes")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sketched sets."""
    x, y, both = F.hll_sketch_estimate(a), F.hll_sketch_estimate(b), F.hll_sketch_estimate(F.hll_union(a, b))
    return F.coalesce(F.try_divide((x + y - both).cast("double"), both.cast("double")), F.lit(0.0))


def data_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes (column_name, change, new_name, old_type, new_type, breaking) from ``old`` to ``new``.

    ``renamed``: breaking until the reader follows; ``removed``: breaking;
    ``added``: not; ``retyped``: the values' type changed, breaking unless the
    new type is more special than the old. Columns without a change are left out.
    """
    a, b = column_profiles(old), column_profiles(new)
    left = a.select("column_name", *(F.col(c).alias(f"o_{c}") for c in ("kind", "values", "shapes")))
    right = b.select("column_name", *(F.col(c).alias(f"n_{c}") for c in ("kind", "values", "shapes")))
    kept = left.join(right, "column_name")
    retyped = kept.where("o_kind <> n_kind").select(
        "column_name", F.lit("retyped").alias("change"), F.col("column_name").alias("new_name"), F.col("o_kind").alias("old_type"),
        F.col("n_kind").alias("new_type"), _fits(F.col("n_kind"), F.col("o_kind")).alias("_ok"))
    gone = left.join(right.select("column_name"), "column_name", "left_anti")
    come = right.join(left.select("column_name"), "column_name", "left_anti").withColumnRenamed("column_name", "new_name")
    # columns of one type are compared with each other; a table has few columns
    pairs = gone.join(come, F.col("o_kind") == F.col("n_kind")).withColumns({
        "_like": _overlap(F.col("o_values"), F.col("n_values")), "_shaped": _overlap(F.col("o_shapes"), F.col("n_shapes"))})
    likely = pairs.where((F.col("_like") >= LIKE) | ((F.col("o_kind") == "text") & (F.col("_shaped") >= SHAPES_LIKE)))
    best = [F.desc("_like"), F.desc("_shaped"), F.asc("column_name"), F.asc("new_name")]
    matched = likely.withColumns({
        "_a": F.row_number().over(Window.partitionBy("column_name").orderBy(*best)),
        "_b": F.row_number().over(Window.partitionBy("new_name").orderBy(*best))}).where("_a = 1 AND _b = 1")
    renamed = matched.select("column_name", F.lit("renamed").alias("change"), "new_name", F.col("o_kind").alias("old_type"),
                             F.col("n_kind").alias("new_type"), F.lit(False).alias("_ok"))
    none = F.lit(None).cast("string")
    removed = gone.join(matched.select("column_name"), "column_name", "left_anti").select(
        "column_name", F.lit("removed").alias("change"), none.alias("new_name"), F.col("o_kind").alias("old_type"),
        none.alias("new_type"), F.lit(False).alias("_ok"))
    added = come.join(matched.select("new_name"), "new_name", "left_anti").select(
        none.alias("column_name"), F.lit("added").alias("change"), "new_name", none.alias("old_type"),
        F.col("n_kind").alias("new_type"), F.lit(True).alias("_ok"))
    out = retyped.unionByName(renamed).unionByName(removed).unionByName(added)
    return out.select("column_name", "change", "new_name", "old_type", "new_type", (~F.col("_ok")).alias("breaking"))


def _fits(special: Column, wide: Column) -> Column:
    """Whether every value of type ``special`` is one of type ``wide``."""
    found = F.lit(False)
    for name, wider in WIDER.items():
        found = found | ((special == name) & wide.isin(*wider))
    return found
