"""Versioned tables and their refresh: after any batch the lake equals a full rebuild."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import raw_df
from tessera.operators import incremental as T
from tessera.operators.fingerprint import fingerprint
from tessera.operators.quality import QualityGateError
from tessera.operators.taxonomy import taxonomy_from_rows
from tessera.plans import lake as L
from tessera.plans.pipeline import build_star
from tessera.sources.versions import Lake, VersionConflict
from test_silver_star import TAX, market

STARTS = "2024-01-01 00:00:00"


def stamped(raw):
    return {n: df.withColumn("ingestion_ts", F.lit(STARTS).cast("timestamp")) for n, df in raw.items()}


def rebuilt(spark, raw, taxonomy):
    """Gold from scratch over all raw rows that ever arrived."""
    from tessera.operators import silver as S

    silver = {n: getattr(S, f"silver_{n}")(df, taxonomy) if n == "products" else getattr(S, f"silver_{n}")(df)
              for n, df in raw.items()}
    return silver, build_star(silver)


def same(a, b):
    return fingerprint(a.select(*b.columns)).drop("table_name").first() == fingerprint(b).drop("table_name").first()


def assert_equal(spark, lake, raw, taxonomy):
    silver, gold = rebuilt(spark, raw, taxonomy)
    now = lake.begin()
    for name in silver:
        assert same(L.silver(now, name), silver[name]), name
    for name in gold:
        assert same(now.read(name), gold[name]), name


def files(lake, table):
    return {(f, r) for f, runs in lake.snapshot().entries[table].parts.items() for r in runs}


@pytest.fixture()
def started(spark, tmp_path):
    raw = stamped(market(spark)[0])
    taxonomy = taxonomy_from_rows(spark, TAX)
    return L.build_lake(spark, raw, taxonomy, str(tmp_path / "lake"), buckets=8), raw, taxonomy


def apply(spark, lake, raw, taxonomy, ts, **rows):
    batches = {n: raw_df(spark, n, r, ts).drop("batch_id") for n, r in rows.items()}
    L.refresh(lake, batches, taxonomy)
    for n, df in batches.items():
        raw[n] = raw[n].select(*df.columns).unionByName(df)


def test_first_version_equals_the_star(spark, started):
    assert_equal(spark, *started)


def test_refresh_of_items_moves_rows_and_keeps_other_partitions(spark, started):
    lake, raw, taxonomy = started
    before = files(lake, "fact_order_item")
    # (o1, 3) moves to a seller without a state; (o2, 1), alone in its partition, leaves it; o4 gets its first item
    apply(spark, lake, raw, taxonomy, "2024-02-01 00:00:00", order_items=[
        {"order_id": "o1", "order_item_id": "3", "product_id": "p2", "seller_id": "s2", "item_price": "5.25", "freight_cost": "0.75"},
        {"order_id": "o2", "order_item_id": "1", "product_id": "pX", "seller_id": "s1", "item_price": "7.00", "freight_cost": "1.00"},
        {"order_id": "o4", "order_item_id": "1", "product_id": "p1", "seller_id": "s1", "item_price": "3.00", "freight_cost": "0.10"},
    ])
    assert_equal(spark, lake, raw, taxonomy)
    # an older version that arrives late changes nothing; neither does the same batch again
    rows = [{"order_id": "o1", "order_item_id": "1", "product_id": "p3", "seller_id": "s2", "item_price": "99.00"}]
    apply(spark, lake, raw, taxonomy, "2023-12-01 00:00:00", order_items=rows)
    assert_equal(spark, lake, raw, taxonomy)
    # an unrelated partition keeps its files
    apply(spark, lake, raw, taxonomy, "2024-02-02 00:00:00",
          orders=[{"order_id": "o9", "customer_id": "c2", "order_status": "new", "purchased_at": "2016-05-05 00:00:00"}],
          order_items=[{"order_id": "o9", "order_item_id": "1", "product_id": "p1", "seller_id": "s1", "item_price": "1"}])
    kept = files(lake, "fact_order_item")
    apply(spark, lake, raw, taxonomy, "2024-02-03 00:00:00",
          order_items=[{"order_id": "o9", "order_item_id": "1", "product_id": "p2", "seller_id": "s1", "item_price": "2"}])
    assert {x for x in kept if "2018" in x[0]} <= files(lake, "fact_order_item") and before != kept
    assert_equal(spark, lake, raw, taxonomy)


def test_changed_dimensions_and_orders_reach_all_facts(spark, started):
    lake, raw, taxonomy = started
    # a state that needs escaping in a folder name, then a move away from it
    apply(spark, lake, raw, taxonomy, "2024-02-01 00:00:00", sellers=[{"seller_id": "s1", "seller_state": "A:1/%2f +x"}])
    assert_equal(spark, lake, raw, taxonomy)
    assert any("A%3A1" in f for f, _ in files(lake, "fact_order_item"))
    apply(spark, lake, raw, taxonomy, "2024-02-02 00:00:00", order_items=[
        {"order_id": "o1", "order_item_id": str(i), "product_id": "p1", "seller_id": "s2", "item_price": "1"} for i in (1, 2)])
    assert_equal(spark, lake, raw, taxonomy)
    # an order changes its year, a customer that orders referred to arrives, a product changes its category
    apply(spark, lake, raw, taxonomy, "2024-02-03 00:00:00",
          orders=[{"order_id": "o1", "customer_id": "c7", "order_status": "delivered", "purchased_at": "2020-01-05 10:00:00"}])
    assert_equal(spark, lake, raw, taxonomy)
    apply(spark, lake, raw, taxonomy, "2024-02-04 00:00:00", customers=[{"customer_id": "c7", "customer_state": "mg"}],
          products=[{"product_id": "pX", "product_category_name": "garden"}, {"product_id": "p1", "product_category_name": "toys"}],
          order_reviews=[{"review_id": "r1", "order_id": "o1", "review_score": "4", "review_creation_date": "2021-01-12 00:00:00"}],
          order_payments=[{"order_id": "o1", "payment_sequential": "2", "payment_type": "x", "payment_value": "5"}])
    assert_equal(spark, lake, raw, taxonomy)


def test_null_keys_are_keys(spark, started):
    lake, raw, taxonomy = started
    nothing = {"order_id": None, "order_item_id": "1", "product_id": "p1", "item_price": "1"}
    apply(spark, lake, raw, taxonomy, "2024-02-01 00:00:00", order_items=[nothing | {"seller_id": "s1"}],
          order_reviews=[{"review_id": None, "order_id": None, "review_score": "3"}])
    assert_equal(spark, lake, raw, taxonomy)
    apply(spark, lake, raw, taxonomy, "2024-02-02 00:00:00", order_items=[nothing | {"seller_id": "s2"}],
          orders=[{"order_id": None, "customer_id": "c1", "purchased_at": "2019-01-01 00:00:00"}])
    assert lake.snapshot().read("fact_order_item").where("order_id IS NULL").count() == 1
    assert_equal(spark, lake, raw, taxonomy)


def test_random_batches_equal_a_rebuild(spark, started):
    lake, raw, taxonomy = started
    rng = random.Random(8)
    pick = rng.choice
    for day in range(3):
        rows = {
            "order_items": [{"order_id": pick(["o1", "o2", "o5", "o6", None]), "order_item_id": str(rng.randrange(3)),
                             "product_id": pick(["p1", "p2", "p9", None]), "seller_id": pick(["s1", "s2", "s3", None]),
                             "item_price": str(rng.randrange(90)), "freight_cost": "1"} for _ in range(6)],
            "orders": [{"order_id": pick(["o2", "o5", "o6"]), "customer_id": pick(["c1", "c3", None]),
                        "purchased_at": pick(["2018-01-01 00:00:00", "2019-07-01 00:00:00", None])} for _ in range(2)],
            "sellers": [{"seller_id": pick(["s1", "s3"]), "seller_state": pick(["sp", "x=y", "é", None])}],
        }
        wanted = {n: rows[n] for n in rng.sample(sorted(rows), rng.randrange(1, 4))}
        apply(spark, lake, raw, taxonomy, f"2024-03-{rng.randrange(10, 28)} 00:00:00", **wanted)
    assert_equal(spark, lake, raw, taxonomy)


def test_empty_batch_publishes_the_same_rows(spark, started):
    lake, raw, taxonomy = started
    before = files(lake, "fact_order_item")
    apply(spark, lake, raw, taxonomy, "2024-02-01 00:00:00", order_items=[])
    assert files(lake, "fact_order_item") == before and lake.versions() == [1, 2]


def test_failed_checks_publish_nothing(spark, started, monkeypatch):
    lake, raw, taxonomy = started
    monkeypatch.setitem(L.GRAINS, "fact_order_item", ("order_id",))  # o1 has three items
    with pytest.raises(QualityGateError):
        apply(spark, lake, raw, taxonomy, "2024-02-01 00:00:00",
              order_items=[{"order_id": "o1", "order_item_id": "1", "product_id": "p3", "seller_id": "s1", "item_price": "2"}])
    assert lake.versions() == [1]
    assert lake.snapshot().read("fact_order_item").where("item_price = 2").count() == 0


def test_versions_conflicts_and_vacuum(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = spark.range(6).selectExpr("id", "id % 3 AS part", "CASE WHEN id < 3 THEN 'a:b' END AS name")
    first, second = lake.begin(), lake.begin()
    first.write("t", df, ["part", "name"])
    second.write("t", df.limit(1))
    assert first.publish() == 1
    with pytest.raises(VersionConflict):
        second.publish()
    old = lake.snapshot()
    change = lake.begin()
    gone = change.remove("t", spark.createDataFrame([(1,), (5,), (77,)], "id long"), ["id"])
    assert sorted(gone) == ["part=1/name=a%3Ab", "part=2/name=__HIVE_DEFAULT_PARTITION__"]
    change.append("t", spark.createDataFrame([(9, 0, None)], "id long, part long, name string"))
    change.publish(note="x")
    ids = {r.id for r in lake.snapshot().read("t").collect()}
    assert ids == {0, 2, 3, 4, 9} and lake.snapshot().notes == {"note": "x"}
    # a reader of the version before is not disturbed
    assert old.read("t").count() == 6 and lake.snapshot(1).read("t").count() == 6
    assert lake.snapshot().read("t", ["part=0/name=a%3Ab", "part=7"]).collect() == [(0, 0, "a:b")]
    # a run that claimed the next number and ended
    lake.files.claim(lake._manifest(3, "claim"))
    change = lake.begin()
    change.write("u", df)
    with pytest.raises(VersionConflict):
        change.publish()
    lake.withdraw()
    assert change.publish() == 3
    lake.vacuum(keep=1)
    assert lake.versions() == [3] and {r.id for r in lake.snapshot().read("t").collect()} == ids
    empty = lake.begin()
    assert empty.write("e", df.limit(0), ["part"]).count() == 0


def test_affected_files_name_every_file_with_a_key_and_no_file_without_a_zone(spark):
    rng = random.Random(2)
    rows = [(f"f{f}", None if rng.random() < 0.02 else rng.randrange(f * 40, f * 40 + 200)) for f in range(12) for _ in range(25)]
    keys = sorted(rng.sample(range(700), 9)) + [None]
    df = spark.createDataFrame(rows, "_file string, k long")
    wanted = spark.createDataFrame([(k,) for k in keys], "k long")
    zones = T.zone_map(df, "k", ["_file"], 4)
    got = {r[0] for r in T.affected_files(zones, wanted, "k", ["_file"], 4).collect()}
    assert got >= {f for f, k in rows if k in keys}
    bucket = {r.k: r.b for r in wanted.selectExpr("k", "CAST(pmod(xxhash64(k), 4) AS int) AS b").collect()}
    assert got == {z._file for z in zones.collect() for k in keys if bucket[k] == z._bucket and (
        z.nulls > 0 if k is None else z.low is not None and z.low <= k <= z.high)}
    assert T.affected_files(zones, wanted.limit(0), "k", ["_file"], 4).count() == 0
    assert T.affected_files(zones.limit(0), wanted, "k", ["_file"], 4).count() == 0


def test_stream_into_lake(spark, started, tmp_path):
    from tessera.sources.schemas import RAW_SCHEMAS
    from tessera.streaming.incremental_stream import stream_into_lake

    lake, raw, taxonomy = started
    landing = tmp_path / "landing"
    landing.mkdir()
    hdr = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,item_price,freight_cost\n"
    (landing / "b1.csv").write_text(hdr + "o1,3,p2,s2,,5.25,0.75\no4,1,p1,s1,,3.00,0.10\n")
    (landing / "b2.csv").write_text(hdr + "o4,1,p1,s1,,4.00,0.10\n")   # a later change of o4/1
    os.utime(landing / "b1.csv", (1_700_000_000, 1_700_000_000))
    os.utime(landing / "b2.csv", (1_700_000_100, 1_700_000_100))
    run = lambda: stream_into_lake(spark, str(landing), RAW_SCHEMAS["order_items"], lake, "order_items", taxonomy,
                                   str(tmp_path / "ckpt"), max_files_per_trigger=1, header=True)
    run()
    now = lake.begin()
    items = L.silver(now, "order_items")
    got = {(r.order_id, r.order_item_id): (r.seller_id, str(r.item_price)) for r in items.collect()}
    assert got[("o1", 3)] == ("s2", "5.25") and got[("o4", 1)] == ("s1", "4.00") and len(got) == 5
    silver = {n: L.silver(now, n) for n in L.BUCKET_KEYS}
    for name, df in build_star(silver).items():
        assert same(now.read(name), df), name
    versions = lake.versions()
    run()  # no new files, and a batch that is retried, change nothing
    assert lake.versions() == versions and len(versions) == 3
