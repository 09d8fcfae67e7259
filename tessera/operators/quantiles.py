"""Exact discrete percentiles per group, with bounded work per task.

``percentile_disc``-style exact aggregates hold every distinct value of a
group in one buffer, and ``percentile_approx`` with a tight error bound keeps
a very large sketch per group and task. Here the exact value at rank
``ceil(q * n)`` (the SQL-standard discrete percentile) is found by selection
inside a bracket:

1. one mergeable quantile sketch per group (``percentile_approx``, its rank
   error bounded by n / accuracy) gives a value below and one above the wanted
   rank, and the group's count;
2. one exact counting pass: values below the bracket are counted, values
   inside it aggregated to a histogram (both combined before the shuffle);
3. running sums over that histogram, some ten-thousandths of a group, find the
   value at the rank.

Nothing is written and no range is sampled. A bracket that does not hold the
rank is widened to its whole group, so the result is exact at every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def range_segments(df: DataFrame, order: Sequence, segments: int | None = None) -> DataFrame:
    """Rows range-partitioned on ``order`` with their segment number, materialised once.

    Without an explicit ``segments`` the shuffle uses the session's partition
    count and AQE may merge adjacent small ranges (segments stay contiguous
    and ordered), so a small input does not become thousands of tiny
    segments. Materialising matters for correctness, not only speed: the range
    boundaries come from a sample, so every consumer must see the same
    assignment of rows to segments.
    """
    ranged = df.repartitionByRange(segments, *order) if segments else df.repartitionByRange(*order)
    return materialize(ranged.withColumn("_seg", F.spark_partition_id()), "segments")


def exact_percentile(df: DataFrame, group_cols: Sequence[str], value_col: str, q: float,
                     accuracy: int = 10_000, alias: str = "percentile") -> DataFrame:
    """Per group (a NULL group too), the value at 1-based rank ceil(q * n) among the non-NULL values.

    ``df`` is read twice (write it first if it is expensive); ``accuracy``
    sets the sketch's size and the bracket's width, not the result.
    """
    frac = Fraction(str(q))
    if not 0 < frac <= 1:
        raise ValueError("q must be in (0, 1]")
    groups = list(group_cols)
    value = F.col(value_col)
    known = df.where(value.isNotNull())
    # the sketch's ranks are off by n / accuracy at most: these two values enclose the wanted one
    margin = 2.0 / accuracy
    ends = F.array(F.lit(max(0.0, float(frac) - margin)), F.lit(min(1.0, float(frac) + margin)))
    # ceil(q * n) on integers: (num * n + den - 1) div den
    x = (F.col("_total") * frac.numerator + (frac.denominator - 1)).cast("decimal(38,0)")
    k = ((x - x % frac.denominator) / frac.denominator).cast("long")
    brackets = known.groupBy(*groups).agg(
        F.percentile_approx(value_col, ends, accuracy).alias("_ends"), F.count(F.lit(1)).alias("_total"),
    ).select(*(F.col(g).alias(f"_b_{g}") for g in groups), F.col("_ends")[0].alias("_low"), F.col("_ends")[1].alias("_high"), k.alias("_k"))
    same = [F.col(g).eqNullSafe(F.col(f"_b_{g}")) for g in groups]
    near = known.join(brackets, same).where(value <= F.col("_high"))
    # values below the bracket are one row of the histogram
    inside = F.when(value >= F.col("_low"), value)
    found = _at_rank(near.select(*groups, inside.alias("_v"), "_k"), groups)
    hit = found.where(F.col("_v").isNotNull())
    # a bracket that missed (which the sketch's bound excludes) is widened to the whole group
    done = hit.select(*(F.col(g).alias(f"_d_{g}") for g in groups), F.lit(True).alias("_done"))
    missed = brackets.join(done, [F.col(f"_b_{g}").eqNullSafe(F.col(f"_d_{g}")) for g in groups], "left_anti")
    rest = _at_rank(known.join(missed, same).select(*groups, value.alias("_v"), "_k"), groups)
    return hit.unionByName(rest).select(*groups, F.col("_v").alias(alias))


def _at_rank(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Of rows (groups, _v, _k), per group the value at rank ``_k``, NULL values lowest."""
    histogram = rows.groupBy(*groups, "_v", "_k").agg(F.count(F.lit(1)).alias("_n"))
    upwards = Window.partitionBy(*groups).orderBy(F.col("_v").asc_nulls_first())
    upto = F.sum("_n").over(upwards.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return histogram.withColumn("_upto", upto).where(
        (F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_n") < F.col("_k"))).select(*groups, "_v")
