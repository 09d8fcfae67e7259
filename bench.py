"""Benchmark at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Two groups, each a median of $BENCH_RUNS timed runs after one warm-up:

* the pipeline workload the reference runs: ``gold_build`` (sources ->
  Silver (7 tables written) -> 4 dimensions written -> 3 facts written,
  partitioned, built on the written dimensions),
  ``gold_dq_suite`` (16 checks on the written tables), the five analyses
  ``gold_q1`` .. ``gold_q5`` on the written tables, and
  ``gold_incremental_refresh`` (the line items of the orders of the last 30
  days applied to a lake: Silver upsert, touched partitions of both facts
  rewritten, checked and published as a new version);
* end-to-end catalog queries (``e2e_*``): the same operators computed lazily
  from the Parquet sources in one plan, forced with the ``noop`` sink.

``value`` is the sum of all medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

E2E = (
    "late_delivery_rate",
    "delivery_lag_by_state",
    "negative_review_mom",
    "order_value_anomalies",
    "category_value_ranking",
    "fact_review",
    "null_profile",
    "orphan_values",
    "mart_customer_summary",
    "scd2_history",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from pyspark import __version__ as spark_version
    from pyspark.sql import functions as F

    from tessera.operators import analytics as N
    from tessera.operators import quality as Q
    from tessera.plans.catalog import QUERIES
    from tessera.plans.publish import stage_layers
    from tessera.session import local_session, scratch_path
    from tessera.sources import driver_tables as D

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="tessera-bench")
    timings: dict[str, float] = {}

    silver = D.silver_tables(spark, sf_dir)
    written: dict = {}

    def build():
        written.clear()
        written.update(stage_layers(spark, silver, scratch_path(spark, "bench-run")))

    timings["gold_build"] = timed(build, runs)
    g = written
    events, ts = D.feed_times(spark, sf_dir)["events"]
    as_of = F.lit(D.FRESHNESS_AS_OF).cast("timestamp_ntz")
    gold_queries = {
        "gold_dq_suite": lambda: Q.dq_report(g, events, ts, as_of),
        "gold_q1_late_delivery_rate": lambda: N.late_delivery_rate(g["fact_order_item"], g["dim_seller"], g["dim_product"]),
        "gold_q2_delivery_lag_by_state": lambda: N.delivery_lag_by_state(g["fact_order_item"], g["dim_customer"]),
        "gold_q3_negative_review_mom": lambda: N.negative_review_mom(g["fact_review"]),
        "gold_q4_order_value_anomalies": lambda: N.order_value_anomalies(g["fact_order_item"], g["dim_product"]),
        "gold_q5_category_value_ranking": lambda: N.category_value_ranking(g["fact_order_item"], g["dim_product"]),
    }
    for name, make in gold_queries.items():
        timings[name] = timed(lambda make=make: run(make()), runs)

    # incremental: the line items of the orders placed in the last 30 days arrive as a
    # batch and are applied to a lake (Silver upsert, touched fact partitions, one new
    # version); idempotent, so repeated runs do the same work
    from tessera.plans.lake import build_lake, refresh

    raw = dict(D.raw_tables(spark, sf_dir).items())
    latest_by = {"order_items": D.ITEM_LATEST_BY}
    taxonomy = D.taxonomy(spark)
    lake = build_lake(spark, raw, taxonomy, scratch_path(spark, "bench-lake"), latest_by, buckets=16)
    cutoff = raw["orders"].select(F.max("purchased_at") - F.expr("INTERVAL 30 DAYS")).scalar()
    recent = raw["orders"].where(F.col("purchased_at") >= cutoff).select("order_id")
    batch = raw["order_items"].join(recent, "order_id", "left_semi")
    timings["gold_incremental_refresh"] = timed(lambda: refresh(lake, {"order_items": batch}, taxonomy, latest_by), runs)
    for name in E2E:
        timings[f"e2e_{name}"] = timed(lambda name=name: run(QUERIES[name](spark, sf_dir)), runs)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark_version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
