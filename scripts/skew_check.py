"""Skew evidence: run the pipeline with one order id holding a third of all line items.

A skewed copy of ``lineitem`` is derived with Spark (every third row moves to
one hot order id, so that order also repeats each line number thousands of
times) and of ``orders`` (a third of the orders move to one customer); the
other tables are linked unchanged. Queries with per-key work run with
Spark's event log written to the scratch folder. For each stage with a shuffle read, the
report gives the records read by the largest task as a share of the stage's
records: a hot key processed by one task would show up as a share near 1/3
or more.

Usage: python scripts/skew_check.py [output.md]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HOT_ORDER = 999_999_999
HOT_CUSTOMER = 7  # an existing customer


def stage_shares(event_dir: str) -> list[tuple[int, int, int, int]]:
    """(stage id, tasks, total shuffle records read, max records read by one task) per stage."""
    stages: dict[int, list[int]] = {}
    for path in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("."):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                metrics = ev.get("Task Metrics") or {}
                read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if read:
                    stages.setdefault(ev["Stage ID"], []).append(read)
    return [(sid, len(v), sum(v), max(v)) for sid, v in sorted(stages.items()) if sum(v) > 10_000]


def main(out: str) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from tessera.session import RECOMMENDED_CONF

    src = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    scratch = os.environ.get("SKEW_SCRATCH") or os.path.join("/tmp", f"skew-{int(time.time())}")
    os.makedirs(scratch, exist_ok=True)
    events = os.path.join(scratch, "eventlog")
    os.makedirs(events, exist_ok=True)
    builder = (SparkSession.builder.master("local[8]").appName("tessera-skew")
               .config("spark.sql.shuffle.partitions", "16")
               # no coalescing: every shuffle keeps 16 tasks, so a task's share shows skew, not small data
               .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
               .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", events)
               .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false"))
    for k, v in RECOMMENDED_CONF.items():
        if k != "spark.sql.adaptive.coalescePartitions.enabled":
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    # a data folder: every table linked, lineitem replaced by a skewed copy
    sf = os.path.join(scratch, "sf")
    os.makedirs(sf, exist_ok=True)
    for f in os.listdir(src):
        if f not in ("lineitem.parquet", "orders.parquet", "events.parquet") and not os.path.exists(os.path.join(sf, f)):
            os.symlink(os.path.join(src, f), os.path.join(sf, f))
    # one user produces a third of all events
    ev = spark.read.parquet(os.path.join(src, "events.parquet"))
    hot_user = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    ev.withColumn("user_id", F.when(hot_user, F.lit(HOT_CUSTOMER).cast("long")).otherwise(F.col("user_id"))) \
        .write.mode("overwrite").parquet(os.path.join(sf, "events.parquet"))
    # one customer places a third of all orders
    orders = spark.read.parquet(os.path.join(src, "orders.parquet"))
    hot_cust = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0
    orders.withColumn("o_custkey", F.when(hot_cust, F.lit(HOT_CUSTOMER).cast("long")).otherwise(F.col("o_custkey"))) \
        .write.mode("overwrite").parquet(os.path.join(sf, "orders.parquet"))
    li = spark.read.parquet(os.path.join(src, "lineitem.parquet"))
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0
    li.withColumn("l_orderkey", F.when(hot, F.lit(HOT_ORDER).cast("long")).otherwise(F.col("l_orderkey"))) \
        .write.mode("overwrite").parquet(os.path.join(sf, "lineitem.parquet"))
    # the hot order needs an orders row to be joined
    skewed = spark.read.parquet(os.path.join(sf, "lineitem.parquet"))
    total = skewed.count()
    hot_rows = skewed.where(F.col("l_orderkey") == HOT_ORDER).count()

    from tessera.plans.catalog import QUERIES

    results = {}
    for name in ("silver_order_items", "fact_order_item", "late_delivery_rate", "scd2_history", "fact_review",
                 "order_value_anomalies", "duplicate_rows", "mart_customer_summary", "negative_review_mom", "dq_report",
                 "event_payment_sequence"):
        t0 = time.time()
        rows = QUERIES[name](spark, sf).count()
        results[name] = (rows, round(time.time() - t0, 2))
    spark.stop()

    shares = stage_shares(events)
    doc = ["# SKEW", "",
           f"Generated by `scripts/skew_check.py`: `lineitem` of `{src}` with {hot_rows:,} of {total:,} rows "
           f"({hot_rows / total:.0%}) moved to one order id, a third of `orders` moved to one customer and a third of `events` to one user; local[8], 16 shuffle partitions, AQE on "
           "(partition coalescing off, so each shuffle keeps 16 tasks and a share near 1/16 = 6% is balanced).", "",
           "| query | rows | seconds |", "|---|---:|---:|"]
    doc += [f"| {n} | {r:,} | {s} |" for n, (r, s) in results.items()]
    doc += ["", "Shuffle-reading stages with more than 10,000 records: records read by the largest task, as a share "
            "of the stage and of the rows of the skewed table.", "",
            "| stage | non-empty tasks | records read | largest task | share of stage | share of lineitem |",
            "|---:|---:|---:|---:|---:|---:|"]
    doc += [f"| {sid} | {n} | {tot:,} | {mx:,} | {mx / tot:.1%} | {mx / total:.1%} |" for sid, n, tot, mx in shares]
    worst = max((mx / total for _, _, tot, mx in shares), default=0)
    doc += ["", f"Largest task of any stage: {worst:.1%} of the line items (the hot order alone is "
            f"{hot_rows / total:.0%} of them). Stages with few non-empty tasks are expected: the exact "
            "percentile ranks only the one target range segment of each category family (about 1/16 of the "
            "values each), and the partitioned fact writes (inside dq_report, which checks staged tables) "
            "`rebalance` by year, one non-empty partition per year at this size; AQE splits such partitions "
            "once they exceed the advisory size, i.e. at scale."]
    with open(out, "w") as f:
        f.write("\n".join(doc) + "\n")
    print("\n".join(doc))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "SKEW.md"))
