"""Skew-safe sequence numbers: ``row_number() over (partition by key order by ...)``
without sending a whole key group to one task.

Rows are range-partitioned on (key, order) into balanced segments (a hot key
spans several) and materialised once; each row gets its position inside its
(segment, key); a table with one row per (segment, key) turns segment sizes
into per-key offsets with a running sum; position = offset + local position.
Give a total order (e.g. end with a unique id) for a deterministic result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import range_segments


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "seq",
                    segments: int | None = None) -> DataFrame:
    """``df`` with a 1-based ``name`` column numbering the rows of each key by ``order``."""
    sort = [F.col(c).asc_nulls_first() for c in order]
    ranged = range_segments(df, [*(F.col(k).asc_nulls_first() for k in keys), *sort], segments)
    seg_keys = ["_seg", *keys]
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy(*seg_keys).orderBy(*sort)))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*seg_keys).agg(F.count(F.lit(1)).alias("_cnt"))
        .select(*(F.col(c).alias(f"_o{c}") for c in seg_keys),
                F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"))
    )
    cond = [F.col(c).eqNullSafe(F.col(f"_o{c}")) for c in seg_keys]  # NULL keys form one group, as in a window
    out = local.join(offsets, cond).withColumn(name, (F.col("_offset") + F.col("_local")).cast("long"))
    return out.drop("_seg", "_local", "_offset", *(f"_o{c}" for c in seg_keys))
