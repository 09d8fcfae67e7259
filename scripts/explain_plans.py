"""Write PLANS.md: what the executed plans of the headline queries look like.

Stages Silver + Gold from $BENCH_SF_DIR (default sf0.1), runs each headline
query on the written tables and on the lazy end-to-end chain, and records
for each executed (AQE final) plan: the scans with their partition filters,
pushed filters and read schema, the join strategies, the number of shuffle
exchanges, and the number of whole-stage-codegen stages.

Usage: python scripts/explain_plans.py [output.md]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(df) -> list[str]:
    # execute through this DataFrame's own query execution (a write would plan
    # a separate one), so the adaptive plan below is the final one
    for _ in df.toLocalIterator():
        pass
    plan = df._jdf.queryExecution().executedPlan().toString()
    # keep the final adaptive plan only: cut at the top-level "Initial Plan"
    # marker (subqueries carry their own, indented, markers)
    lines = plan.split("\n")
    cut = next((i for i, line in enumerate(lines) if line.startswith("+- == Initial Plan ==")), len(lines))
    plan = "\n".join(lines[:cut])
    codegen = len(set(re.findall(r"[*][(](\d+)[)]", plan)))
    lines = []
    scans = re.findall(r"FileScan parquet [^\n]*", plan)
    seen = set()
    for s in scans:
        loc = re.search(r"Location: \w+\(\d+ paths?\)\[([^\]]*)\]", s)
        table = os.path.basename(loc.group(1).rstrip("/")) if loc else "?"
        part = re.search(r"PartitionFilters: (\[[^\]]*\]?)", s)
        push = re.search(r"PushedFilters: (\[[^\]]*\]?)", s)
        schema = re.search(r"ReadSchema: (struct<[^>]*>?)", s)
        key = (table, part and part.group(1), push and push.group(1), schema and schema.group(1))
        if key in seen:
            continue
        seen.add(key)
        lines.append(f"- scan `{table}`: PartitionFilters {key[1]}; PushedFilters {key[2]}; ReadSchema `{key[3]}`")
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|RightOuter)", plan)
    if joins:
        counts: dict[str, int] = {}
        for j in joins:
            counts[f"{j[0]} {j[1]}"] = counts.get(f"{j[0]} {j[1]}", 0) + 1
        lines.append("- joins: " + ", ".join(f"{k} x{v}" for k, v in sorted(counts.items())))
    lines.append(f"- shuffle exchanges: {len(re.findall(r'Exchange (hash|range|single|round)', plan))}; "
                 f"broadcast exchanges: {plan.count('BroadcastExchange')}; reused: {plan.count('Reused')}; "
                 f"whole-stage-codegen stages: {codegen}")
    return lines


def main(out: str) -> None:
    from pyspark.sql import functions as F

    from tessera.operators import analytics as N
    from tessera.operators import quality as Q
    from tessera.plans.catalog import QUERIES
    from tessera.plans.publish import stage_layers
    from tessera.session import local_session, scratch_path
    from tessera.sources import driver_tables as D

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(shuffle_partitions=16, app="tessera-plans")
    g = stage_layers(spark, D.silver_tables(spark, sf_dir), scratch_path(spark, "plans"))
    ev, ts = D.feed_times(spark, sf_dir)["events"]
    gold = {
        "N1 late_delivery_rate": N.late_delivery_rate(g["fact_order_item"], g["dim_seller"], g["dim_product"]),
        "N2 delivery_lag_by_state": N.delivery_lag_by_state(g["fact_order_item"], g["dim_customer"]),
        "N3 negative_review_mom": N.negative_review_mom(g["fact_review"]),
        "N4 order_value_anomalies": N.order_value_anomalies(g["fact_order_item"], g["dim_product"]),
        "N5 category_value_ranking": N.category_value_ranking(g["fact_order_item"], g["dim_product"]),
        "DQ suite (16 checks)": Q.dq_report(g, ev, ts, F.lit(D.FRESHNESS_AS_OF).cast("timestamp_ntz")),
    }
    doc = ["# PLANS", "", f"Generated by `scripts/explain_plans.py` on `{sf_dir}` (Spark {spark.version}, AQE on, "
           "final adaptive plans after execution).", "",
           "## On published Gold (the production path)", ""]
    for name, df in gold.items():
        doc += [f"### {name}", *summarize(df), ""]
    doc += ["## End to end from the Parquet sources (lazy chain, one plan)", ""]
    for name in ("fact_order_item", "silver_order_items", "late_delivery_rate", "scd2_history"):
        doc += [f"### {name}", *summarize(QUERIES[name](spark, sf_dir)), ""]
    with open(out, "w") as f:
        f.write("\n".join(doc))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
