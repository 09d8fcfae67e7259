"""Driver contract, oracle agreement, gated publish and streaming Bronze."""

import os

import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from oracle_compare import compare, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["category_family", "orders", "units_sold", "item_revenue", "freight_cost", "total_value"]


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs_at_sf0001(spark, name):
    df = E.queries()[name](spark, SF001)
    assert df.count() >= 0


@pytest.fixture(scope="module")
def duck_sf01():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_agrees_at_sf001(spark, duck_sf01, name):
    res = compare(spark, duck_sf01, name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert res["ok"], res


def test_publish_is_gated(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.operators.quality import QualityGateError
    from tessera.plans.publish import POINTER, publish_gold
    from tessera.sources import driver_tables as D

    root = str(tmp_path / "lake")
    events, ts = D.feed_times(spark, SF001)["events"]
    as_of = F.lit(D.FRESHNESS_AS_OF).cast("timestamp_ntz")
    # the driver data has real failures (deliveries before purchase, unmapped PROMO parts)
    with pytest.raises(QualityGateError):
        publish_gold(spark, D.silver_tables(spark, SF001), root, events, ts, as_of, run_id="r1")
    assert not os.path.exists(os.path.join(root, POINTER))
    assert os.path.exists(os.path.join(root, "runs", "r1", "_dq_report"))


def test_publish_passes_on_clean_data(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.plans.publish import current_run, publish_gold, read_published
    from test_silver_star import market

    raw, silver, _ = market(spark)
    # drop the rows that the mini marketplace makes fail on purpose
    silver = dict(silver)
    silver["order_payments"] = silver["order_payments"].where("payment_value >= 0")
    silver["order_reviews"] = silver["order_reviews"].where("review_score BETWEEN 1 AND 5")
    silver["products"] = silver["products"].where("category_family IS NOT NULL OR product_category_name IS NULL")
    silver["orders"] = silver["orders"].where("order_id <> 'o2'")
    fresh = spark.createDataFrame([(1,)], "x int").select(F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts"))
    root = str(tmp_path / "lake")
    report = publish_gold(spark, silver, root, fresh, "ts", F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"), run_id="ok1")
    assert report.where("NOT passed").count() == 0 and report.count() == 16
    assert current_run(spark, root) == "ok1"
    assert read_published(spark, root, "fact_order_item").count() == 4  # the o2 item stays, without order context


def test_bronze_stream_is_incremental(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.streaming.bronze_stream import ingest_bronze, replay_safe

    src = tmp_path / "landing"
    bronze, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    ev = spark.read.parquet(os.path.join(SF001, "events.parquet"))
    ev.where("event_id < 100").write.parquet(str(src / "b1"))
    schema = ev.schema
    ingest_bronze(spark, str(src / "*"), schema, bronze, ckpt, "b1")
    assert spark.read.parquet(bronze).count() == 100
    # a second landing batch replays 10 events and adds 50 new ones
    ev.where("event_id >= 90 AND event_id < 150").write.parquet(str(src / "b2"))
    ingest_bronze(spark, str(src / "*"), schema, bronze, ckpt, "b2")
    back = spark.read.parquet(bronze)
    assert back.count() == 160  # Bronze keeps everything, replays too
    assert replay_safe(back, ["event_id"]).count() == 150
    # an old file that arrives late is kept whole
    ev.where("event_id >= 200 AND event_id < 300").withColumn("ts", F.expr("ts - INTERVAL 30 DAYS")).write.parquet(str(src / "b3"))
    ingest_bronze(spark, str(src / "*"), schema, bronze, ckpt, "b3")
    back = spark.read.parquet(bronze)
    assert back.where("batch_id = 'b3'").count() == 100
    back = back.where("batch_id <> 'b3'")
    assert {r.batch_id for r in back.select("batch_id").distinct().collect()} == {"b1", "b2"}


def test_sql_surface_equals_dataframe_operators(spark):
    from tessera.operators import analytics as N
    from tessera.operators.fingerprint import fingerprint
    from tessera.plans.pipeline import driver_star
    from tessera.plans.sql_views import ANALYSIS_SQL, register_gold_views, run_analysis

    g = driver_star(spark, SF001)
    register_gold_views(spark, g)
    frames = {
        "late_delivery_rate": N.late_delivery_rate(g["fact_order_item"], g["dim_seller"], g["dim_product"]),
        "delivery_lag_by_state": N.delivery_lag_by_state(g["fact_order_item"], g["dim_customer"]),
        "negative_review_mom": N.negative_review_mom(g["fact_review"]),
        "order_value_anomalies": N.order_value_anomalies(g["fact_order_item"], g["dim_product"]),
        "category_value_ranking": N.category_value_ranking(g["fact_order_item"], g["dim_product"]),
    }
    for name in ANALYSIS_SQL:
        sql_df = run_analysis(spark, name)
        assert sql_df.columns == frames[name].columns, name
        assert fingerprint(sql_df).drop("table_name").first() == fingerprint(frames[name]).drop("table_name").first(), name
        assert [tuple(r) for r in sql_df.collect()] == [tuple(r) for r in frames[name].collect()], name


@pytest.mark.parametrize("name", ["freshness_check", "dq_report", "negative_review_mom", "dim_date", "late_delivery_rate",
                                  "backfill_window"])
def test_results_do_not_depend_on_session_time_zone(spark, duck_sf01, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        res = compare(spark, duck_sf01, name, E.queries()[name], E.oracle_sql()[name], SF01)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["ok"], res


def _folder_bytes(path):
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_bucketed_silver_builds_facts_without_shuffling_order_tables(spark, tmp_path):
    from tessera.operators.fingerprint import fingerprint
    from tessera.plans.pipeline import build_star
    from tessera.plans.publish import ORDER_LEVEL, stage_tables
    from tessera.sources import driver_tables as D

    silver = D.silver_tables(spark, SF001)
    folder = tmp_path / "silver"
    written = stage_tables(spark, dict(silver.items()), str(folder), buckets={n: (["order_id"], 8) for n in ORDER_LEVEL})
    # as at scale: the order-level tables are too large to broadcast, the product catalogue is not
    small = max(_folder_bytes(folder / n) for n in ("products", "customers", "sellers"))
    large = min(_folder_bytes(folder / n) for n in ORDER_LEVEL)
    assert small < large
    threshold = str((small + large) // 2)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, threshold)
        gold = build_star(written)
        for fact in ("fact_order_item", "fact_payment", "fact_review"):
            plan = gold[fact]._jdf.queryExecution().executedPlan().toString()
            shuffles = [line.strip()[:90] for line in plan.split("\n") if "Exchange hashpartitioning(order_id" in line]
            assert shuffles == [], (fact, shuffles)
        plain = build_star(silver)
        for fact in ("fact_order_item", "fact_review"):
            assert fingerprint(gold[fact]).drop("table_name").first() == fingerprint(plain[fact]).drop("table_name").first()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_late_events_are_routed_not_dropped(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from tessera.streaming.late_stream import route_late_events

    ev = spark.read.parquet(os.path.join(SF001, "events.parquet"))
    landing = tmp_path / "landing"
    ev.where("event_id < 100").coalesce(1).write.parquet(str(landing / "b1"))
    replay = ev.where("event_id < 5").withColumn("event_id", F.col("event_id") + 100000)  # old event times, new ids
    ev.where("event_id >= 100 AND event_id < 150").unionByName(replay).coalesce(1).write.parquet(str(landing / "b2"))
    for i, d in enumerate(("b1", "b2")):
        for f in os.listdir(landing / d):
            os.utime(landing / d / f, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    out = tmp_path / "routed"
    route_late_events(spark, str(landing / "*"), ev.schema, "ts", 60, str(out), str(tmp_path / "ckpt"),
                      max_files_per_trigger=1)
    schema = ev.schema.add("batch_id", "integer")
    on_time = spark.read.schema(schema).parquet(str(out / "on_time"))
    late = spark.read.schema(schema).parquet(str(out / "late"))
    assert on_time.count() == 150 and late.count() == 5
    assert {r.event_id for r in late.collect()} == {100000 + i for i in range(5)}


def test_csv_stream_rejects_a_mismatching_header(spark, tmp_path):
    from tessera.sources.schemas import RAW_SCHEMAS
    from tessera.streaming.bronze_stream import ingest_bronze

    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("seller_city,seller_id,seller_zip_code_prefix,seller_state\nx,s1,01000,sp\n")
    with pytest.raises(Exception):
        ingest_bronze(spark, str(landing), RAW_SCHEMAS["sellers"], str(tmp_path / "bronze"), str(tmp_path / "ckpt"),
                      "b1", fmt="csv", header=True)


def test_queries_work_without_a_configured_checkpoint_dir(tmp_path):
    """No spark-defaults.conf (so no spark.checkpoint.dir): scratch-writing queries still run."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    conf_dir = tmp_path / "conf"
    conf_dir.mkdir()
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "import __spark_entry__ as E\n"
        "for n in ('scd2_history', 'order_value_anomalies', 'event_payment_sequence', 'bronze_stream_append'):\n"
        "    print(n, E.queries()[n](s, %r).count())\n"
    ) % (root, SF001)
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "bronze_stream_append" in out.stdout


def test_rows_without_event_time_are_routed_to_undated(spark, tmp_path):
    from tessera.streaming.late_stream import route_late_events

    landing, out = tmp_path / "landing", tmp_path / "out"
    rows = spark.sql("SELECT id, CASE WHEN id < 3 THEN TIMESTAMP_NTZ'2024-01-01 00:00:00' END AS ts FROM range(4)")
    rows.coalesce(1).write.parquet(str(landing / "b1"))
    rows.withColumnRenamed("id", "x").selectExpr("x + 10 AS id", "ts").coalesce(1).write.parquet(str(landing / "b2"))
    route_late_events(spark, str(landing / "*"), rows.schema, "ts", 60, str(out), str(tmp_path / "ckpt"), max_files_per_trigger=1)
    schema = rows.schema.add("batch_id", "integer")
    parts = {n: spark.read.schema(schema).parquet(str(out / n)).count() for n in ("on_time", "undated")}
    assert parts == {"on_time": 6, "undated": 2}


def test_null_partitions_and_groups_are_kept(spark):
    from tessera.operators.incremental import restrict_to_partitions
    from tessera.operators.quantiles import exact_percentile

    t = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("b", 3.0)], "g string, v double")
    parts = spark.createDataFrame([(None,), ("a",)], "g string")
    assert restrict_to_partitions(t, parts, ["g"]).count() == 2
    assert {(r.g, r.percentile) for r in exact_percentile(t, ["g"], "v", 0.95).collect()} == {(None, 1.0), ("a", 2.0), ("b", 3.0)}


def test_gate_fails_on_unknown_results(spark):
    from tessera.operators.quality import QualityGateError, assert_passed

    report = spark.createDataFrame([("a", None, 0)], "test_name string, passed boolean, rows_failed long")
    with pytest.raises(QualityGateError):
        assert_passed(report)
