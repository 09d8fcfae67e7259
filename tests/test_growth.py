"""What grows with the tables: shuffles that a plan must not hold."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tessera.operators import star as K
from tessera.operators.fingerprint import fingerprint
from tessera.plans import lake as L
from tessera.plans.pipeline import driver_star
from tessera.plans.publish import FACTS, stage_dimensions
from tessera.sources import driver_tables as D
from tessera.sources.versions import Lake


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled_by(df):
    """Columns of each hash exchange in the initial plan."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", df._jdf.queryExecution().executedPlan().toString())


def test_facts_on_bucketed_silver_are_not_shuffled_by_order(spark, tmp_path, no_broadcast):
    buckets = D.order_buckets(spark, SF001)
    silver = D.build_silver(spark, D.raw_tables(spark, SF001), buckets)
    written, star = stage_dimensions(spark, silver, str(tmp_path / "run"), buckets, placed=True)
    plain = driver_star(spark, SF001)
    assert not shuffled_by(star["fact_payment"])  # the customers were joined once, at the orders
    by = [columns for fact in ("fact_payment", "fact_order_item") for columns in shuffled_by(star[fact])]
    assert not [c for c in by if "order_id" in c or "customer_id" in c]
    assert sum("order_id" in c for c in shuffled_by(star["fact_review"])) == 1  # items, coming from the products
    for fact in FACTS:
        assert fingerprint(star[fact]).drop("table_name").first() == fingerprint(plain[fact]).drop("table_name").first()


def test_an_order_with_very_many_lines_is_not_bucketed(spark):
    assert D.order_buckets(spark, SF001) >= 8
    assert D.order_buckets(spark, SF001, hot_lines=1) is None


def test_silver_dealt_by_order_is_shuffled_once(spark):
    for name in ("order_items", "order_payments", "order_reviews", "orders"):
        assert len(shuffled_by(D.build_silver(spark, D.raw_tables(spark, SF001), 8)[name])) == 1


def _small_lake(spark, tmp_path, order_buckets=None):
    from tessera.operators.taxonomy import taxonomy_from_rows
    from test_lake import stamped
    from test_silver_star import TAX, market

    raw, taxonomy = stamped(market(spark)[0]), taxonomy_from_rows(spark, TAX)
    return L.build_lake(spark, raw, taxonomy, str(tmp_path / "lake"), buckets=4, order_buckets=order_buckets), raw, taxonomy


NEW_ITEMS = [{"order_id": "o1", "order_item_id": "1", "product_id": "p2", "seller_id": "s2", "item_price": "9.00"},
             {"order_id": "o2", "order_item_id": "7", "product_id": "p1", "seller_id": "s1", "item_price": "3.00"}]


def _plans_written(monkeypatch):
    """(table, whether its rows are dealt out anew for the write) of each run written from here on."""
    seen, write_run = [], Lake.write_run

    def spy(self, name, df, by, placed=False, dealt=None):
        seen.append((name, bool(by) and not placed and not dealt))
        return write_run(self, name, df, by, placed, dealt)

    monkeypatch.setattr(Lake, "write_run", spy)
    return seen


def test_a_small_batch_deals_out_no_kept_rows(spark, tmp_path, monkeypatch):
    from test_lake import apply, assert_equal

    lake, raw, taxonomy = _small_lake(spark, tmp_path, 3)
    seen = _plans_written(monkeypatch)
    apply(spark, lake, raw, taxonomy, "2024-02-01 00:00:00", order_items=NEW_ITEMS)
    # only the fresh rows of the facts are dealt out, by their partitions: one run each
    assert sorted(n for n, anew in seen if anew) == ["fact_order_item", "fact_review"]
    assert {"silver_order_items", "fact_order_item"} <= {n for n, anew in seen if not anew}
    assert_equal(spark, lake, raw, taxonomy)


def test_silver_and_facts_of_a_dealt_lake_are_shuffled_once(spark, tmp_path, no_broadcast):
    from test_lake import assert_equal

    lake, raw, taxonomy = _small_lake(spark, tmp_path, 3)
    assert_equal(spark, lake, raw, taxonomy)
    now = lake.begin()
    dims = L._dimensions(now)
    read, dealt = L._all_orders(now, dims, 3)
    assert dealt and not shuffled_by(L._fact("fact_payment", now, dims, read, dealt))
    assert not [c for c in shuffled_by(L._fact("fact_order_item", now, dims, read, dealt)) if "order_id" in c]


def test_facts_are_written_anew_where_a_large_backfill_touches_most_of_them(spark, tmp_path, no_broadcast, monkeypatch):
    from conftest import raw_df
    from test_lake import assert_equal

    for order_buckets in (3, None):  # dealt out by order, and not
        lake, raw, taxonomy = _small_lake(spark, tmp_path / str(order_buckets), order_buckets)
        change = lake.begin()
        late = raw_df(spark, "order_items", NEW_ITEMS, "2024-02-01 00:00:00").drop("batch_id")
        L.upsert(change, "order_items", late, taxonomy, {}, 4)
        change.publish()
        seen = _plans_written(monkeypatch)
        L.refresh_orders(lake, raw["orders"].select("order_id"))
        assert [n for n, _ in seen].count("fact_order_item") == 1  # nothing was taken out first
        raw["order_items"] = raw["order_items"].select(*late.columns).unionByName(late)
        assert_equal(spark, lake, raw, taxonomy)


def test_products_are_resolved_once_for_all_facts_of_a_dealt_lake(spark, tmp_path, no_broadcast):
    lake, raw, _ = _small_lake(spark, tmp_path, 3)
    now = lake.begin()
    read, dealt = L._all_orders(now, L._dimensions(now), 3)
    review = L._fact("fact_review", now, L._dimensions(now), read, dealt)
    assert not [c for c in shuffled_by(review) if "order_id" in c or "product_id" in c]
    assert now.aside and all(os.path.isdir(p) for p in now.aside.values())
    kept = list(now.aside.values())
    now.publish()
    assert not [p for p in kept if os.path.isdir(p)]
    # a batch too large to broadcast: only its order ids are dealt out, not the table
    rows = lake.dealt(now.entries["silver_order_items"])
    assert [len(shuffled_by(part)) for part in L._by_order(rows, raw["order_items"], 3, "order_id")[1:]] == [1]


def test_products_kept_by_order_give_the_same_facts(spark):
    from test_silver_star import market

    _, silver, gold = market(spark)
    base = silver["order_items"]
    items = base
    for n, (column, value) in enumerate((("product_id", None), ("product_id", "nowhere"), ("product_id", "nowhere else"), ("order_id", None)), 1):
        items = items.unionByName(base.withColumns({column: F.lit(value).cast("string"), "order_item_id": F.col("order_item_id") + 100 * n}))
    dims = [gold[n] for n in ("dim_customer", "dim_seller", "dim_product")]
    products = K.products_of_orders(items, gold["dim_product"], 3)
    pairs = [[K.fact_order_item(silver["orders"], items, *dims, p) for p in (None, products)],
             [K.fact_review(silver["order_reviews"], silver["orders"], items, dims[0], dims[2], bool(p), p) for p in (None, products)]]
    for plain, by_order in pairs:
        assert plain.count() > 0 and fingerprint(plain).first() == fingerprint(by_order).first()


def test_idempotency_check_leaves_no_build_behind(spark):
    from tessera.plans.catalog import QUERIES
    from tessera.session import SHUFFLES_GO, ensure_checkpoint_dir

    def builds():
        return {n for n in os.listdir(ensure_checkpoint_dir(spark)) if n.endswith("-build") or "-build-" in n}

    before, setting = builds(), spark.conf.get(SHUFFLES_GO)
    rows = QUERIES["idempotency_check"](spark, SF001).collect()
    assert len(rows) == 14 and all(r.equal and r.rows_a == r.rows_b for r in rows)
    assert builds() == before and spark.conf.get(SHUFFLES_GO) == setting
