"""DQ rules, analytics boundaries, fingerprints, incremental operators (FIXTURES.md §4)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.operators import analytics as N
from tessera.operators import incremental as T
from tessera.operators import quality as Q
from tessera.operators.fingerprint import fingerprint, table_diff
from tessera.sources.io import write_partitioned

TS = "timestamp_ntz"


def ts(s):
    return datetime.fromisoformat(s)


def fact_items(spark, rows):
    """rows: (order_id, seller_key, product_key, purchased_at, delivered_at, est, price, freight)."""
    schema = ("order_id string, order_item_id int, seller_key long, product_key long, customer_key long, purchased_at timestamp_ntz, "
              "delivered_at timestamp_ntz, est_delivery_date timestamp_ntz, item_price decimal(18,2), freight_cost decimal(18,2)")
    from decimal import Decimal

    data = [(o, i + 1, s, p, 1, pu, de, es, Decimal(str(pr)), Decimal(str(fr))) for i, (o, s, p, pu, de, es, pr, fr) in enumerate(rows)]
    return spark.createDataFrame(data, schema).withColumn("purchase_year", F.year("purchased_at"))


def dims(spark, families):
    dp = spark.createDataFrame([(k, f) for k, f in families.items()], "product_key long, category_family string")
    ds = spark.createDataFrame([(1, "s1"), (2, "s2")], "seller_key long, seller_id string")
    return ds, dp


def test_late_boundary_and_window_and_small_group(spark):
    base = ts("2020-06-30 00:00:00")
    est = ts("2020-07-10 12:00:00")
    rows = []
    # seller 1 x family A: 5 items inside the window; one delivered exactly at the estimate, one a second later
    rows.append(("o1", 1, 10, base, est, est, 1, 0))
    rows.append(("o2", 1, 10, base, est + timedelta(seconds=1), est, 1, 0))
    rows += [("o3", 1, 10, base - timedelta(days=90), est, est, 1, 0)] * 3  # max - 90 d: inside
    rows.append(("o4", 1, 10, base - timedelta(days=91), est + timedelta(days=9), est, 1, 0))  # max - 91 d: outside
    rows.append(("o5", 1, 10, base, None, est, 1, 0))  # not delivered: excluded
    # seller 2 x family A: only 4 items -> dropped
    rows += [("o6", 2, 10, base, est, est, 1, 0)] * 4
    foi = fact_items(spark, rows)
    ds, dp = dims(spark, {10: "A"})
    out = N.late_delivery_rate(foi, ds, dp).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.seller_id, r.delivered_items, r.late_items, r.late_delivery_rate_pct) == ("s1", 5, 1, 20.0)


def test_mom_gaps_previous_zero_and_strict(spark):
    schema = "review_id string, review_score int, review_creation_date timestamp_ntz, category_family string"
    rows = [
        ("a", 1, ts("2018-01-05 00:00:00"), "F"), ("b", 2, ts("2018-01-06 00:00:00"), "F"),
        ("c", 1, ts("2018-03-01 00:00:00"), "F"), ("d", 1, ts("2018-03-02 00:00:00"), "F"), ("e", 1, ts("2018-03-03 00:00:00"), "F"),
        ("f", 5, ts("2018-04-01 00:00:00"), "F"),  # only positive reviews: present with count 0
        ("g", 1, ts("2018-05-01 00:00:00"), "F"),  # previous = 0 -> no row
        ("a", 1, ts("2018-01-05 00:00:00"), "F"),  # fan-out duplicate of review a: counted once
    ]
    fr = spark.createDataFrame(rows, schema)
    out = {(r.review_month.isoformat(), r.negative_reviews, r.previous_month_negative_reviews, r.mom_change_pct)
           for r in N.negative_review_mom(fr).collect()}
    assert out == {("2018-03-01", 3, 2, 50.0), ("2018-04-01", 0, 3, -100.0)}
    strict = N.negative_review_mom(fr, strict_calendar=True).collect()
    assert [(r.review_month.isoformat(), r.mom_change_pct) for r in strict] == [("2018-04-01", -100.0)]


def test_zero_p95_gives_no_row_and_no_error(spark):
    rows = [(f"o{i}", 1, 10, ts("2020-01-01 00:00:00"), None, None, 0, 0) for i in range(5)]
    rows += [(f"p{i}", 1, 20, ts("2020-01-01 00:00:00"), None, None, i + 1, 0) for i in range(20)]
    foi = fact_items(spark, rows)
    _, dp = dims(spark, {10: "Zero", 20: "Ones"})
    out = N.order_value_anomalies(foi, dp).collect()
    assert [r.category_family for r in out] == ["Ones"]
    assert out[0].order_category_value == 20.0 and out[0].category_p95_value == 19.0 and out[0].multiple_of_category_p95 == 1.05


def test_rounding_is_half_up_and_exact(spark):
    from tessera.functions.columns import pct, ratio2

    df = spark.createDataFrame([(1, 8), (1, 3), (-1, 8), (2, 3), (0, 5), (1, 0)], "a long, b long")
    got = [(r.p, r.q) for r in df.select(pct(F.col("a"), F.col("b")).alias("p"), ratio2(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [(12.5, 0.13), (33.33, 0.33), (-12.5, -0.13), (66.67, 0.67), (0.0, 0.0), (None, None)]


def test_temporal_payment_empty_rules(spark):
    schema = "delivered_at timestamp_ntz, purchased_at timestamp_ntz"
    df = spark.createDataFrame([(ts("2020-01-01 00:00:00"), ts("2020-01-02 00:00:00")), (None, ts("2020-01-01 00:00:00")),
                                (ts("2020-01-03 00:00:00"), ts("2020-01-01 00:00:00"))], schema)
    rule = Q.RowRule("t", F.col("delivered_at") < F.col("purchased_at"),
                     F.col("delivered_at").isNotNull() & F.col("purchased_at").isNotNull())
    r = Q.row_rules(df, [rule]).first()
    assert (r.rows_evaluated, r.rows_failed, r.failure_pct, r.passed) == (2, 1, 50.0, False)
    pay = spark.createDataFrame([(-1.0,), (0.0,), (None,)], "payment_value double")
    r = Q.row_rules(pay, [Q.RowRule("p", F.col("payment_value") < 0, F.col("payment_value").isNotNull())]).first()
    assert (r.rows_evaluated, r.rows_failed) == (2, 1)
    empty = spark.createDataFrame([], schema)
    r = Q.row_rules(empty, [rule]).first()
    assert (r.rows_evaluated, r.rows_failed, r.failure_pct, r.passed) == (0, 0, 0.0, True)
    g = Q.grain_rule(empty, ["delivered_at"], "g").first()
    assert (g.rows_evaluated, g.failure_pct, g.passed) == (0, 0.0, True)


def test_freshness_cases(spark):
    as_of = ts("2024-01-02 00:00:00")
    lit = F.lit(as_of).cast(TS)

    def fresh(values):
        df = spark.createDataFrame([(v,) for v in values], "ingestion_ts timestamp_ntz")
        return Q.freshness_rule(df, "ingestion_ts", lit, "f").first()

    assert fresh([as_of - timedelta(hours=23)]).passed is True
    assert fresh([as_of - timedelta(hours=25)]).passed is False
    assert fresh([as_of + timedelta(hours=1)]).passed is False
    r = fresh([])
    assert r.passed is False and r.rows_evaluated is None and r.failure_pct is None


def test_ri_and_gate(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k long")
    dim = spark.createDataFrame([(1,), (2,)], "k long")
    r = Q.ri_rule(fact, "k", dim, "k", "ri").first()
    assert (r.rows_evaluated, r.rows_failed) == (4, 1)
    assert Q.ri_orphan_rows(fact, "k", dim, "k").count() == 1
    with pytest.raises(Q.QualityGateError):
        Q.validate_referential_integrity(fact, "k", dim, "k")
    with pytest.raises(Q.QualityGateError):
        Q.validate_fact_grain(fact, ["k"], "fact")
    with pytest.raises(Q.QualityGateError):
        Q.assert_passed(Q.ri_rule(fact, "k", dim, "k", "ri"))


def test_fingerprint_properties(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, "y")], "id int, a string, b string")
    fa = fingerprint(a).drop("table_name").first()
    assert fingerprint(a.orderBy(F.col("id").desc()).repartition(3)).drop("table_name").first() == fa
    assert fingerprint(a.select("b", "id", "a")).drop("table_name").first() == fa
    moved = spark.createDataFrame([(1, None, "x"), (2, None, "y")], "id int, a string, b string")
    assert fingerprint(moved).drop("table_name").first() != fa
    assert fingerprint(a.unionByName(a.limit(1))).drop("table_name").first() != fa


def test_table_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d"), (3, None)], "k int, v string")
    got = {(r.k, r.change, r.changed_columns) for r in table_diff(old, new, ["k"]).collect()}
    assert got == {(2, "changed", "v"), (4, "added", None)}


def test_schema_drift(spark):
    from pyspark.sql import types as T_

    exp = T_.StructType([T_.StructField("a", T_.IntegerType()), T_.StructField("b", T_.StringType())])
    act = T_.StructType([T_.StructField("a", T_.StringType()), T_.StructField("c", T_.StringType())])
    got = {(r.column_name, r.change, r.breaking) for r in T.schema_drift(spark, exp, act).collect()}
    assert got == {("a", "type_changed", True), ("b", "removed", True), ("c", "added", False)}
    with pytest.raises(ValueError):
        T.assert_compatible(T.schema_drift(spark, exp, act))
    T.assert_compatible(T.schema_drift(spark, exp, T_.StructType(exp.fields + [T_.StructField("z", T_.LongType())])))


def test_scd2_and_scd1(spark):
    v = spark.createDataFrame([("k", "A", ts("2020-01-01 00:00:00")), ("k", "A", ts("2020-02-01 00:00:00")),
                               ("k", "B", ts("2020-03-01 00:00:00")), ("j", None, ts("2020-01-01 00:00:00"))],
                              "key string, attr string, updated_at timestamp_ntz")
    h = {(r.key, r.attr, r.valid_from.month, r.valid_to.month if r.valid_to else None, r.is_current)
         for r in T.scd2_history(v, ["key"], ["attr"], "updated_at").collect()}
    assert h == {("k", "A", 1, 3, False), ("k", "B", 3, None, True), ("j", None, 1, None, True)}
    cur = v.where("attr = 'A'")
    upd = v.where("attr = 'B' OR key = 'j'")
    up = {(r.key, r.attr) for r in T.scd1_upsert(cur, upd, ["key"], "updated_at").collect()}
    assert up == {("k", "B"), ("j", None)}


def test_partitioned_write_null_and_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = spark.createDataFrame([(2017, "SP", 1), (2018, None, 2), (2018, "RJ", 3)], "purchase_year int, seller_state string, v int")
    write_partitioned(df, path, ["purchase_year", "seller_state"])
    back = spark.read.parquet(path)
    assert back.count() == 3 and back.where(F.col("seller_state").isNull()).count() == 1
    write_partitioned(spark.createDataFrame([(2018, "RJ", 30)], df.schema), path, ["purchase_year", "seller_state"])
    got = {(r.purchase_year, r.seller_state, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {(2017, "SP", 1), (2018, None, 2), (2018, "RJ", 30)}


def test_late_arrivals_backfill_affected(spark):
    df = spark.createDataFrame([
        (1, ts("2020-01-01 00:00:00"), ts("2020-01-05 00:00:00"), 2020, "SP"),
        (2, ts("2019-01-01 00:00:00"), ts("2020-01-05 00:00:00"), 2019, "RJ"),
        (3, ts("2020-01-10 00:00:00"), None, 2020, "RJ"),
    ], "id int, purchased_at timestamp_ntz, delivered_at timestamp_ntz, purchase_year int, seller_state string")
    late = T.late_arrivals(df, "purchased_at", "delivered_at", 30)
    assert [r.id for r in late.collect()] == [2]
    assert [(r.purchase_year, r.late_rows) for r in T.late_arrival_volume(late, "purchase_year").collect()] == [(2019, 1)]
    assert sorted(r.id for r in T.backfill_window(df, "purchased_at", 10).collect()) == [1, 3]
    parts = {(r.purchase_year, r.seller_state) for r in T.affected_partitions(late, ["purchase_year", "seller_state"]).collect()}
    assert parts == {(2019, "RJ")}
    assert T.restrict_to_partitions(df, T.affected_partitions(late, ["purchase_year", "seller_state"]),
                                    ["purchase_year", "seller_state"]).count() == 1


def _scd2_brute(rows):
    """rows: (key, attr, day). Expected intervals by the definition."""
    out = []
    by_key = {}
    for k, a, d in rows:
        by_key.setdefault(k, []).append((d, a))
    for k, vs in by_key.items():
        vs.sort(key=lambda t: (t[0], (t[1] is not None, t[1])))
        starts = [v for i, v in enumerate(vs) if i == 0 or v[1] != vs[i - 1][1]]
        for i, (d, a) in enumerate(starts):
            nxt = starts[i + 1][0] if i + 1 < len(starts) else None
            out.append((k, a, d, nxt))
    return sorted(out, key=repr)


def test_scd2_hot_key_spans_segments(spark):
    import random

    rnd = random.Random(7)
    rows = [("hot", rnd.choice(["A", "B", None]), rnd.randrange(0, 400)) for _ in range(3000)]
    rows += [(f"k{i}", rnd.choice(["A", "B"]), rnd.randrange(0, 50)) for i in range(300) for _ in range(3)]
    df = spark.createDataFrame(rows, "key string, attr string, day int")
    got = T.scd2_history(df, ["key"], ["attr"], "day", segments=8)
    # the hot key really is split across several range segments
    assert df.repartitionByRange(8, "key", "day", "attr").where("key = 'hot'").select(
        F.spark_partition_id()).distinct().count() > 2
    res = sorted(((r.key, r.attr, r.valid_from, r.valid_to) for r in got.collect()), key=repr)
    assert res == _scd2_brute(rows)
    cur = got.where("is_current").groupBy("key").count().where("count <> 1").count()
    assert cur == 0


def test_exact_percentile_hot_group_matches_brute_force(spark):
    import math
    import random

    from tessera.operators.quantiles import exact_percentile

    rnd = random.Random(11)
    rows = [("hot", rnd.randrange(0, 10**6)) for _ in range(5000)]
    rows += [(f"g{i}", rnd.randrange(0, 100)) for i in range(40) for _ in range(rnd.randrange(1, 30))]
    rows += [("nulls", None), ("nulls", 5)]
    df = spark.createDataFrame(rows, "g string, v long")
    for q, accuracy in ((0.95, 10_000), (0.5, 100), (0.95, 40), (1.0, 5), (0.01, 2)):
        got = {r.g: r.percentile for r in exact_percentile(df, ["g"], "v", q, accuracy=accuracy).collect()}
        exp = {}
        for g in {r[0] for r in rows}:
            vals = sorted(v for gg, v in rows if gg == g and v is not None)
            exp[g] = vals[math.ceil(q * len(vals) - 1e-12) - 1]
        assert got == exp, q


def test_sha256_fingerprint_properties(spark):
    from tessera.operators.fingerprint import sha256_fingerprint

    a = spark.createDataFrame([(1, "x", None), (2, None, "y")], "id int, a string, b string")
    fa = sha256_fingerprint(a).drop("table_name").first()
    assert sha256_fingerprint(a.orderBy(F.col("id").desc()).repartition(3)).drop("table_name").first() == fa
    assert sha256_fingerprint(a.select("b", "id", "a")).drop("table_name").first() == fa
    moved = spark.createDataFrame([(1, None, "x"), (2, None, "y")], "id int, a string, b string")
    assert sha256_fingerprint(moved).drop("table_name").first() != fa
    assert sha256_fingerprint(a.unionByName(a.limit(1))).drop("table_name").first() != fa


def test_staged_partition_values_keep_their_type(spark, tmp_path):
    from tessera.plans.publish import stage_tables

    df = spark.createDataFrame([("o1", 1, 2018, "01"), ("o2", 1, 2018, None)],
                               "order_id string, order_item_id int, purchase_year int, seller_state string")
    # fact_order_item is staged partitioned by (purchase_year, seller_state)
    back = stage_tables(spark, {"fact_order_item": df}, str(tmp_path))["fact_order_item"]
    assert back.schema == df.schema
    assert sorted((r.seller_state or "") for r in back.collect()) == ["", "01"]


def test_profile_table_and_null_filter(spark):
    from tessera.operators.profile import null_profiles, profile_table

    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 1.5, "c")], "id int, x double, s string")
    rows = {r.column_name: r for r in profile_table(df, "t").collect()}
    assert {c: (r.data_type, r.row_count, r.null_count, r.column_count) for c, r in rows.items()} == {
        "id": ("int", 3, 0, 3), "x": ("double", 3, 2, 3), "s": ("string", 3, 1, 3)}
    only = {(r.table_name, r.column_name) for r in null_profiles({"t": df, "u": df.select("id")}, only_with_nulls=True).collect()}
    assert only == {("t", "x"), ("t", "s")}
