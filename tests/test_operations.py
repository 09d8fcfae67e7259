"""Failing rows of rules, metric history, drift with renames, trees of fingerprints, merged type-2 history."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.operators import drift, fingerprint as FP, metrics as H, quality as Q, violations as V
from tessera.operators.incremental import assert_compatible, scd2_history
from tessera.plans.history import merge_versions, start_history
from tessera.sources.versions import BUCKET, Lake, bucketed
from test_silver_star import market


def gold_with_faults(spark):
    _, _, gold = market(spark)
    gold = dict(gold)
    items, reviews = gold["fact_order_item"], gold["fact_review"]
    gold["fact_order_item"] = items.unionByName(items.where("order_item_id = 2")).withColumn(  # a repeated key, an orphan
        "product_key", F.when(F.col("order_item_id") == 3, F.lit(77).cast("long")).otherwise(F.col("product_key")))
    gold["fact_review"] = reviews.withColumn("review_date_key", F.when(F.col("review_id") == "r2", 19000101).otherwise(F.col("review_date_key")))
    return gold


def test_violations_are_as_many_as_the_report_counts(spark):
    gold = gold_with_faults(spark)
    feed, as_of = spark.createDataFrame([], "ts timestamp_ntz"), F.lit("2024-01-01").cast("timestamp_ntz")
    report = {r.test_name: r.rows_failed for r in Q.dq_report(gold, feed, "ts", as_of).collect()}
    rows = V.gold_violations(gold, feed, "ts", as_of).collect()
    assert Counter(r.test_name for r in rows) == Counter({n: f for n, f in report.items() if f})
    assert sum(1 for f in report.values() if f) >= 6  # orphans of two kinds, a grain, dates, scores, categories, freshness
    keys = {(r.table_name, r.row_key) for r in rows}
    assert ("fact_order_item", "o1|2") in keys and ("fact_order_item", "o1|3") in keys and ("bronze", "") in keys


def test_one_row_can_break_several_rules_and_null_conditions_break_none(spark):
    df = spark.createDataFrame([(1, None, None), (2, -1, "x"), (None, -1, "k"), (4, 5, "x")], "id long, v long, fk string")
    dim = spark.createDataFrame([("k",), (None,)], "pk string")
    rules = [Q.RowRule("negative", F.col("v") < 0), Q.RowRule("odd", F.col("v") % 2 != 0, F.col("id") < 4)]
    got = V.failing_rows(df, "t", ["id", "fk"], rules, [V.Relation("known", "fk", dim, "pk")]).collect()
    assert {(r.test_name, r.row_key) for r in got} == {
        ("negative", "2|x"), ("negative", "NULL|k"), ("odd", "2|x"), ("known", "2|x"), ("known", "4|x")}
    assert V.failing_rows(df.limit(0), "t", ["id"], rules).count() == 0
    assert V.failing_groups(df, "t", ["v"], "g").collect()[0].row_key == "-1"


def test_refused_run_keeps_its_failing_rows(spark, tmp_path):
    from tessera.plans import publish as P

    _, silver, _ = market(spark)
    with pytest.raises(Q.QualityGateError):
        P.publish_gold(spark, silver, str(tmp_path), spark.createDataFrame([], "ts timestamp_ntz"), "ts", run_id="r1")
    rows = spark.read.parquet(str(tmp_path / "runs" / "r1" / "_violations"))
    assert {"bronze", "fact_review"} <= {r.table_name for r in rows.collect()}


def test_relations_in_one_pass_equal_one_by_one(spark):
    gold = gold_with_faults(spark)
    for fact, rels in Q.RELATION_CHECKS.items():
        together = {tuple(r) for r in Q.ri_rules(gold[fact], [(n, fk, gold[d], pk) for n, fk, d, pk in rels]).collect()}
        assert together == {tuple(Q.ri_rule(gold[fact], fk, gold[d], pk, n).first()) for n, fk, d, pk in rels}
    empty = Q.ri_rules(gold["fact_review"].limit(0), [("x", "customer_key", gold["dim_customer"], "customer_key")]).first()
    assert (empty.rows_evaluated, empty.rows_failed, empty.passed) == (0, 0, True)


def test_metric_history_and_deltas(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    tables = [spark.createDataFrame(rows, "a long, b string") for rows in ([(1, "x"), (2, None)], [(1, None)] * 4, [], [(7, "y")])]
    for i, df in enumerate(tables):
        change = lake.begin()
        rows = H.table_metrics(df, "t")
        if i in (1, 2):
            rows = rows.unionByName(H.count_metric(df, "t", "late_rows"))
        H.record(change, f"run{i}", rows)
        change.publish()
    got = {(r.run_id, r.metric): (r.value, r.previous_value, r.delta, r.delta_pct)
           for r in H.metric_deltas(lake.snapshot().read(H.HISTORY)).collect()}
    assert got["run0", "rows"] == (2.0, None, None, None)
    assert got["run1", "rows"] == (4.0, 2.0, 2.0, 100.0)
    assert got["run1", "null_rate:b"] == (1.0, 0.5, 0.5, 100.0)
    assert got["run2", "rows"] == (0.0, 4.0, -4.0, -100.0) and got["run2", "null_rate:a"] == (0.0, 0.0, 0.0, None)
    assert got["run3", "rows"] == (1.0, 0.0, 1.0, None) and ("run3", "late_rows") not in got
    assert got["run2", "late_rows"] == (0.0, 4.0, -4.0, -100.0)
    stored = lake.snapshot()
    e = stored.entries[H.HISTORY]
    paths = [f"{lake.data(H.HISTORY)}/_run={r}" for ids in e.parts.values() for r in ids]
    assert H.stored_bytes(spark.read.parquet(*paths), "h").first().value > 0


def test_drift_finds_renames_and_types(spark):
    rng = random.Random(1)
    old = spark.createDataFrame([(i, f"name {rng.randrange(10**6)}", float(i) / 7, f"2024-01-{i % 28 + 1:02d}", None, "true")
                                 for i in range(300)], "id long, name string, x double, day string, empty string, flag string")
    same = drift.data_drift(old, old.repartition(3))
    assert same.count() == 0
    new = old.select(F.col("id").cast("string").alias("key"), F.upper("name").alias("title"), F.col("x").cast("int").alias("x"),
                     F.concat("day", F.lit("?")).alias("day"), F.lit("now set").alias("empty"), F.lit(3).alias("extra"))
    got = {(r.column_name, r.change, r.new_name): (r.old_type, r.new_type, r.breaking) for r in drift.data_drift(old, new).collect()}
    assert got == {
        ("id", "renamed", "key"): ("integer", "integer", True),
        ("name", "renamed", "title"): ("text", "text", True),      # other values of the same shape
        ("x", "retyped", "x"): ("decimal", "integer", False),      # integers are decimals
        ("day", "retyped", "day"): ("timestamp", "text", True),
        ("empty", "retyped", "empty"): ("empty", "text", True),
        ("flag", "removed", None): ("boolean", None, True),
        (None, "added", "extra"): (None, "integer", False),
    }
    with pytest.raises(ValueError, match="renamed"):
        assert_compatible(drift.data_drift(old, new))
    assert_compatible(drift.data_drift(old, old.withColumn("more", F.lit(1))))
    assert drift.data_drift(old.limit(0), old.limit(0)).count() == 0


def test_tree_descends_to_the_buckets_that_differ(spark):
    rows = spark.range(3000).selectExpr("id", "id % 7 AS v", "CASE WHEN id % 5 > 0 THEN 'x' END AS s")
    a = bucketed(rows, ["id"], 100)
    changed = rows.where("id <> 40").withColumn("v", F.when(F.col("id") == 9, -1).otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(5000, 1, None)], "id long, v long, s string"))
    b = bucketed(changed, ["id"], 100)
    ta, tb = FP.fingerprint_tree(a), FP.fingerprint_tree(b.repartition(4))
    assert FP.unequal_buckets(ta, FP.fingerprint_tree(a.repartition(3))) == []
    unequal = FP.unequal_buckets(ta, tb)
    assert unequal == sorted({r[0] for r in bucketed(spark.createDataFrame([(9,), (40,), (5000,)], "id long"), ["id"], 100)
                              .select(BUCKET).collect()})
    read = []

    def reader(df):
        return lambda buckets: read.append(list(buckets)) or df.where(F.col(BUCKET).isin(buckets))

    got = FP.bucket_diff(reader(a), reader(b), ["id"], unequal).collect()
    assert {(r.id, r.change) for r in got} == {(9, "changed"), (40, "removed"), (5000, "added")}
    assert read == [unequal, unequal]
    root = ta.where(f"level = {FP.LEVELS}").first()
    assert root.row_count == 3000
    assert FP.unequal_buckets(ta, FP.fingerprint_tree(a.limit(0))) == list(range(100))


def test_merged_history_equals_a_rebuild(spark, tmp_path):
    rng = random.Random(6)
    start = datetime(2023, 1, 1)

    def versions(n):
        return [(rng.choice(["hot", "hot", "k1", "k2", None]), rng.choice("abc"),
                 None if rng.random() < 0.05 else start + timedelta(days=rng.randrange(400))) for _ in range(n)]

    schema, keys, tracked = "k string, v string, at timestamp_ntz", ["k"], ["v"]
    batches = [versions(60), versions(15), [("new", "a", start)], versions(15), []]
    lake = Lake(spark, str(tmp_path / "lake"))
    change = lake.begin()
    start_history(change, spark.createDataFrame(batches[0], schema), "t", keys, tracked, "at", 8)
    change.publish()
    so_far = list(batches[0])
    for batch in batches[1:]:
        change = lake.begin()
        merge_versions(change, spark.createDataFrame(batch, schema), "t", keys, tracked, "at", 8)
        change.publish()
        so_far += batch
    whole = spark.createDataFrame(so_far, schema)
    rows = lambda df: Counter(tuple(r) for r in df.collect())
    assert rows(lake.snapshot().read("t_history").drop(BUCKET)) == rows(scd2_history(whole, keys, tracked, "at", segments=3))
    for period in ("month", "day"):
        assert rows(scd2_history(whole, keys, tracked, "at", period=period)) == rows(scd2_history(whole, keys, tracked, "at", segments=1))


def test_portable_fingerprint_has_one_text_for_a_row(spark):
    df = spark.sql("SELECT CAST(1.50 AS decimal(18,2)) AS m, timestamp_ntz'2024-01-02 03:04:05.5' AS t, true AS f, "
                   "CAST(NULL AS string) AS n, date'2024-01-02' AS d, 7 AS i")
    assert df.select(FP.portable_text(df)).first()[0] == r"2024-01-02|true|7|150|\N|2024-01-02 03:04:05.500000"
    one = FP.portable_fingerprint(df).drop("table_name").first()
    assert one == FP.portable_fingerprint(df.select("t", "i", "n", "m", "f", "d")).drop("table_name").first()
    assert FP.portable_fingerprint(df.limit(0)).first().row_count == 0


def test_light_keys_of_a_history_are_shuffled_once(spark):
    import random

    from tessera.operators.incremental import scd2_history

    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["a", "b", None]), rng.choice([None, *range(30)])) for _ in range(200)]
    df = spark.createDataFrame(data, "k int, v string, at int")
    args = (["k"], ["v"], "at")

    def rows(x):
        return sorted(map(str, x.collect()))

    whole = rows(scd2_history(df, *args, segments=1))
    light = scd2_history(df, *args)
    assert rows(light) == whole
    assert light._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 2
    assert rows(scd2_history(df, *args, hot_versions=50)) == whole  # key 1 by segments, the others by key


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_a_large_batch_of_versions_rebuilds_its_buckets(spark, tmp_path, limit):
    """Both ways of a merge (keys picked out, buckets rebuilt) give the rebuild, a late version and a NULL key included."""
    from tessera.operators.incremental import scd2_history
    from tessera.plans.history import merge_versions, start_history
    from tessera.sources.versions import BUCKET, Lake

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        first, late = [(1, "a", 1), (1, "a", 9), (2, "x", 5), (None, "n", 3)], [(1, "b", 4), (3, "z", 1), (None, "m", 2)]
        schema, args = "k int, v string, at int", (["k"], ["v"], "at")

        def make(data):
            return spark.createDataFrame(data, schema).selectExpr("k", "v", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, at) at")

        lake = Lake(spark, str(tmp_path / "lake"))
        change = lake.begin()
        start_history(change, make(first), "t", *args, 4)
        change.publish()
        change = lake.begin()
        merge_versions(change, make(late), "t", *args, 4)
        change.publish()
        got = sorted(map(str, lake.snapshot().read("t_history").drop(BUCKET).collect()))
        assert got == sorted(map(str, scd2_history(make(first + late), *args, segments=1).collect()))
        assert lake.broadcast_limit() == (0 if limit == "-1" else 10 << 20)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
