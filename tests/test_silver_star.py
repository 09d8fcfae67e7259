"""Silver typing/dedupe and Gold star fixtures (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from conftest import raw_df
from tessera.operators import silver as S
from tessera.operators import star as K
from tessera.operators.fingerprint import fingerprint
from tessera.operators.taxonomy import taxonomy_from_rows
from tessera.plans.pipeline import build_star
from tessera.sources.io import read_raw

TAX = [("audio", "Audio", "Electronics"), ("garden", "Garden", "Home"), ("audio", "Audio", "Electronics")]


def market(spark, reviews_extra=(), items_extra=()):
    raw = {
        "customers": raw_df(spark, "customers", [
            {"customer_id": " c1 ", "customer_unique_id": "u1", "customer_zip_code_prefix": "01409",
             "customer_city": " são paulo ", "customer_state": "sp"},
            {"customer_id": "c2", "customer_unique_id": "u2", "customer_state": "rj"},
        ]),
        "sellers": raw_df(spark, "sellers", [
            {"seller_id": "s1", "seller_state": "sp"}, {"seller_id": "s2", "seller_state": None},
        ]),
        "products": raw_df(spark, "products", [
            {"product_id": "p1", "product_category_name": " audio ", "product_name_lenght": "12"},
            {"product_id": "p2", "product_category_name": "toys"},
            {"product_id": "p3", "product_category_name": None},
        ]),
        "orders": raw_df(spark, "orders", [
            {"order_id": "o1", "customer_id": "c1", "order_status": " Delivered ", "purchased_at": "2018-01-05 10:00:00",
             "delivered_at": "2018-01-10 10:00:00", "est_delivery_date": "2018-01-10 10:00:00"},
            {"order_id": "o2", "customer_id": "c2", "order_status": "delivered", "purchased_at": "2018-03-01 08:00:00",
             "delivered_at": "2018-02-27 08:00:00", "est_delivery_date": "2018-03-05 00:00:00"},
            {"order_id": "o3", "customer_id": None, "order_status": "shipped", "purchased_at": "2018-03-02 08:00:00"},
            {"order_id": "o4", "customer_id": "c1", "order_status": "canceled", "purchased_at": "2018-03-03 08:00:00"},
        ]),
        "order_items": raw_df(spark, "order_items", [
            {"order_id": "o1", "order_item_id": "1", "product_id": "p1", "seller_id": "s1", "item_price": "10.00", "freight_cost": "1.50"},
            {"order_id": "o1", "order_item_id": "2", "product_id": "p1", "seller_id": "s1", "item_price": "10.00", "freight_cost": "1.50"},
            {"order_id": "o1", "order_item_id": "3", "product_id": "p2", "seller_id": "s1", "item_price": "5.25", "freight_cost": "0.75"},
            {"order_id": "o2", "order_item_id": "1", "product_id": "pX", "seller_id": "s2", "item_price": "7.00", "freight_cost": "1.00"},
            *items_extra,
        ]),
        "order_payments": raw_df(spark, "order_payments", [
            {"order_id": "o1", "payment_sequential": "1", "payment_type": " Credit_Card ", "payment_value": "-1.00"},
            {"order_id": "o2", "payment_sequential": "1", "payment_type": "boleto", "payment_value": "0.00"},
            {"order_id": "o3", "payment_sequential": "1", "payment_type": "voucher", "payment_value": None},
        ]),
        "order_reviews": raw_df(spark, "order_reviews", [
            {"review_id": "r1", "order_id": "o1", "review_score": "1", "review_creation_date": "2018-01-12 00:00:00"},
            {"review_id": "r2", "order_id": "o4", "review_score": "5", "review_creation_date": "2018-03-04 00:00:00"},
            {"review_id": "r3", "order_id": "o1", "review_score": "x", "review_creation_date": "2018-01-13 00:00:00"},
            {"review_id": "r3", "order_id": "o2", "review_score": "x", "review_creation_date": "2018-03-06 00:00:00"},
            *reviews_extra,
        ]),
    }
    tax = taxonomy_from_rows(spark, TAX)
    silver = {
        "customers": S.silver_customers(raw["customers"]),
        "sellers": S.silver_sellers(raw["sellers"]),
        "products": S.silver_products(raw["products"], tax),
        "orders": S.silver_orders(raw["orders"]),
        "order_items": S.silver_order_items(raw["order_items"]),
        "order_payments": S.silver_order_payments(raw["order_payments"]),
        "order_reviews": S.silver_order_reviews(raw["order_reviews"]),
    }
    return raw, silver, build_star(silver)


def test_csv_quotes_and_leading_zero(spark, tmp_path):
    p = tmp_path / "reviews.csv"
    p.write_text(
        'review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'
        'r1,o1,5,t,"he said ""hi""\nline2",2018-01-01 00:00:00,\n', encoding="utf-8")
    df = read_raw(spark, str(p), "order_reviews")
    rows = df.collect()
    assert len(rows) == 1
    assert rows[0].review_comment_message == 'he said "hi"\nline2'
    c = tmp_path / "customers.csv"
    c.write_text("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc1,u1,01409,x,sp\n")
    silver = S.silver_customers(read_raw(spark, str(c), "customers"))
    assert silver.first().customer_zip_code_prefix == "01409"


def test_cleaning_and_types(spark):
    _, silver, _ = market(spark)
    c = {r.customer_id: r for r in silver["customers"].collect()}
    assert set(c) == {"c1", "c2"}
    assert c["c1"].customer_city == "SÃO PAULO" and c["c1"].customer_state == "SP"
    o = {r.order_id: r for r in silver["orders"].collect()}
    assert o["o1"].order_status == "delivered"
    pay = {r.order_id: r for r in silver["order_payments"].collect()}
    assert pay["o1"].payment_type == "credit_card"
    assert str(pay["o1"].payment_value) == "-1.00"
    assert dict(silver["products"].dtypes)["product_name_length"] == "int"


def test_bad_score_does_not_fail_and_is_counted(spark):
    from tessera.operators.quality import RowRule, row_rules

    raw = raw_df(spark, "order_reviews", [
        {"review_id": f"r{i}", "order_id": "o", "review_score": s} for i, s in enumerate(["x", "0", "6", None, "5"])
    ])
    reviews = S.silver_order_reviews(raw)
    scores = sorted((r.review_score for r in reviews.collect()), key=lambda v: (v is None, v))
    assert scores == [0, 5, 6, None, None]
    r = row_rules(reviews, [RowRule("score", F.col("review_score").isNull() | ~F.col("review_score").between(1, 5))]).first()
    assert (r.rows_evaluated, r.rows_failed) == (5, 4)


def test_latest_batch_wins_in_any_order(spark):
    b1 = raw_df(spark, "orders", [{"order_id": "o1", "order_status": "created"}], "2024-01-01 00:00:00")
    b2 = raw_df(spark, "orders", [{"order_id": "o1", "order_status": "shipped"}], "2024-01-02 00:00:00")
    for bronze in (b1.unionByName(b2), b2.unionByName(b1), b2.unionByName(b1).repartition(3)):
        rows = S.silver_orders(bronze).collect()
        assert [r.order_status for r in rows] == ["shipped"]
        assert "ingestion_ts" not in S.silver_orders(bronze).columns


def test_tied_batches_have_one_winner(spark):
    rows = [{"order_id": "o1", "order_status": s} for s in ("a", "b", "c")]
    bronze = raw_df(spark, "orders", rows, "2024-01-01 00:00:00")
    winners = {S.silver_orders(bronze.repartition(n)).first().order_status for n in (1, 2, 5)}
    assert winners == {"c"}


def test_same_batch_twice_changes_nothing(spark):
    raw = raw_df(spark, "order_reviews", [
        {"review_id": "r1", "order_id": "o1", "review_score": "4"},
        {"review_id": "r1", "order_id": "o2", "review_score": "4"},
    ], "2024-01-01 00:00:00")
    again = raw.unionByName(raw)
    fp1 = fingerprint(S.silver_order_reviews(raw)).first()
    fp2 = fingerprint(S.silver_order_reviews(again)).first()
    assert fp1 == fp2
    geo = raw_df(spark, "geolocation", [{"geolocation_zip_code_prefix": "01409", "geolocation_lat": "-23.5",
                                          "geolocation_city": " sao paulo "}], "2024-01-01 00:00:00")
    geo2 = geo.unionByName(raw_df(spark, "geolocation", [{"geolocation_zip_code_prefix": "01409", "geolocation_lat": "-23.5",
                                                            "geolocation_city": " sao paulo "}], "2024-01-02 00:00:00"))
    assert S.silver_geolocation(geo2).count() == 1
    assert S.silver_geolocation(geo2).first().geolocation_lat == -23.5


def test_null_keys_give_null_surrogate_keys(spark):
    _, _, gold = market(spark)
    foi = gold["fact_order_item"]
    fp = {r.order_id: r for r in gold["fact_payment"].collect()}
    assert fp["o3"].customer_key is None
    d = raw_df(spark, "customers", [{"customer_id": None, "customer_state": "sp"}])
    assert K.dim_customer(S.silver_customers(d)).first().customer_key is None
    assert foi.where(F.col("customer_key") == 42).count() == 0


def test_orphan_item_kept_with_null_product(spark):
    _, _, gold = market(spark)
    rows = {(r.order_id, r.order_item_id): r for r in gold["fact_order_item"].collect()}
    assert len(rows) == 4
    assert rows[("o2", 1)].product_key is None and rows[("o1", 1)].product_key is not None
    assert rows[("o2", 1)].seller_state is None


def test_review_fanout(spark):
    _, _, gold = market(spark)
    fr = gold["fact_review"].collect()
    r1 = [r for r in fr if r.review_id == "r1"]
    assert len(r1) == 2  # order o1: 3 items of 2 products
    r2 = [r for r in fr if r.review_id == "r2"]
    assert len(r2) == 1 and r2[0].product_key is None
    assert [r.category_family for r in r1 if r.category_family] == ["Electronics"]


def test_multi_order_review_histogram(spark):
    from tessera.operators.profile import duplicate_histogram

    raw, _, _ = market(spark)
    h = {r.distinct_values: r.ids for r in duplicate_histogram(raw["order_reviews"], "review_id", "order_id").collect()}
    assert h == {1: 2, 2: 1}


def test_taxonomy_enrich_coverage_and_gaps(spark):
    from tessera.operators.taxonomy import taxonomy_coverage, taxonomy_gaps

    raw, silver, _ = market(spark)
    products = silver["products"]
    assert products.count() == 3  # duplicated taxonomy row does not multiply
    p = {r.product_id: r for r in products.collect()}
    assert p["p1"].category_family == "Electronics"  # matched after trim
    assert p["p2"].category_family is None
    cov = taxonomy_coverage(products).first()
    assert (cov.categorised_products, cov.mapped_products, cov.null_category_products) == (2, 1, 1)
    tax_raw = spark.createDataFrame(TAX, "source_category string, normalized_category string, category_family string")
    gaps = {(r.category, r.status, r.taxonomy_rows) for r in taxonomy_gaps(products, tax_raw).collect()}
    assert gaps == {("toys", "missing_in_taxonomy", None), ("garden", "extra_in_taxonomy", None),
                    ("audio", "duplicate_in_taxonomy", 2)}


def test_dim_date_calendar(spark):
    _, _, gold = market(spark)
    d = {r.date_key: r for r in gold["dim_date"].collect()}
    r = d[20180105]
    assert (r.year, r.quarter, r.month, r.month_name, r.day_of_week, r.day_name) == (2018, 1, 1, "January", 6, "Friday")
    assert len(d) == 8  # 4 purchase dates + 4 review dates, all distinct


def test_bronze_batches_and_file_profile(spark, tmp_path):
    from datetime import datetime

    from tessera.operators.profile import profile_files
    from tessera.sources.io import ingest_batch, read_table

    hdr = "order_id,customer_id,order_status,purchased_at,approved_at,carrier_handoff_at,delivered_at,est_delivery_date\n"
    d1 = tmp_path / "drop1"
    d1.mkdir()
    (d1 / "orders_a.csv").write_text(hdr + "o1,c1,created,2018-01-01 10:00:00,,,,\no2,c2,created,2018-01-02 10:00:00,,,,\n")
    (d1 / "orders_b.csv").write_text(hdr + "o3,c3,created,2018-01-03 10:00:00,,,,\n")
    d2 = tmp_path / "drop2"
    d2.mkdir()
    (d2 / "orders.csv").write_text(hdr + "o1,c1,delivered,2018-01-01 10:00:00,,,2018-01-05 00:00:00,\n")
    bronze = str(tmp_path / "bronze")
    ingest_batch(spark, {"orders": str(d1)}, bronze, ("b1", datetime(2024, 1, 1)))
    ingest_batch(spark, {"orders": str(d2)}, bronze, ("b2", datetime(2024, 1, 2)))
    b = read_table(spark, bronze, "", "orders")
    assert b.count() == 4 and {r.batch_id for r in b.select("batch_id").distinct().collect()} == {"b1", "b2"}
    s = {r.order_id: r for r in S.silver_orders(b).collect()}
    assert s["o1"].order_status == "delivered" and len(s) == 3
    files = {r.file_name: r.row_count for r in profile_files(spark, str(d1), header=True).collect()}
    assert files == {"orders_a.csv": 2, "orders_b.csv": 1}
    # files of two headers, an odd name, a file without rows and one without a header: a branch per header
    (d1 / "odd a+b %1.csv").write_text("x,y\n1,\n,\n")
    (d1 / "none.csv").write_text("x,y\n")
    (d1 / "blank.csv").write_text("")
    profile = profile_files(spark, str(d1), header=True)
    got = {r.file_name: (r.row_count, r.column_count, r.null_cells, r.file_schema) for r in profile.collect()}
    assert got["odd a+b %1.csv"] == (2, 2, 3, "x string, y string") and got["none.csv"] == (0, 2, 0, "x string, y string")
    assert got["orders_a.csv"][:3] == (2, 8, 8) and got.get("blank.csv", (0, 0))[0] == 0
    scans = profile._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert scans <= 3


def test_malformed_csv_lines_are_kept_and_counted(spark, tmp_path):
    from datetime import datetime

    from tessera.operators.quality import malformed_rows_rule
    from tessera.sources.io import ingest_batch, read_table

    hdr = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    src = tmp_path / "c"
    src.mkdir()
    (src / "c.csv").write_text(hdr + "c1,u1,01409,x,sp\nc2,u2,1,2,3,4,5,6\nc3,u3,22000,y,rj\n")
    bronze = str(tmp_path / "bronze")
    ingest_batch(spark, {"customers": str(src)}, bronze, ("b1", datetime(2024, 1, 1)))
    b = read_table(spark, bronze, "", "customers")
    assert b.count() == 3
    r = malformed_rows_rule(b, "customers parse cleanly").first()
    assert (r.rows_evaluated, r.rows_failed) == (3, 1)
    assert S.silver_customers(b).count() == 3 and "_corrupt_record" not in S.silver_customers(b).columns


def _csv_sources(tmp_path, **changed):
    """A small clean marketplace as CSV files; ``changed`` replaces the text of data sets."""
    files = {
        "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                     "c1,u1,01409,sao paulo,sp\nc2,u2,22000,rio,rj\n",
        "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01000,sao paulo,sp\n",
        "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
                    "product_weight_g,product_length_cm,product_height_cm,product_width_cm\np1,audio,10,100,1,500,10,10,10\n",
        "orders": "order_id,customer_id,order_status,purchased_at,approved_at,carrier_handoff_at,delivered_at,est_delivery_date\n"
                  "o1,c1,delivered,2018-01-05 10:00:00,2018-01-05 11:00:00,2018-01-06 09:00:00,2018-01-09 10:00:00,2018-01-15 00:00:00\n",
        "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,item_price,freight_cost\n"
                       "o1,1,p1,s1,2018-01-08 00:00:00,10.50,2.25\n",
        "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,credit_card,2,12.75\n",
        "order_reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
                         "review_answer_timestamp\nr1,o1,5,,\"great, \"\"really\"\"\nthanks\",2018-01-10 00:00:00,2018-01-11 00:00:00\n",
        "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
                       "01409,-23.5,-46.6,sao paulo,sp\n",
    }
    sources = {}
    for name, text in (files | changed).items():
        p = tmp_path / "raw" / f"{name}.csv"
        p.parent.mkdir(exist_ok=True)
        p.write_text(text)
        sources[name] = str(p)
    tax = tmp_path / "taxonomy.csv"
    tax.write_text("source_category,normalized_category,category_family\naudio,Audio,Electronics\n")
    return sources, str(tax)


ITEM_HEADER = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,item_price,freight_cost\n"


@pytest.mark.parametrize("row, reason", [
    ("o1,2,p1,s1,2018-01-08 00:00:00\n", "lines parse"),
    ("o1,1,p1,s1,2018-01-08 00:00:00,ten,2.25\n", "values convert"),
    ("o9,1,p9,s9,2018-01-08 00:00:00,10.50,2.25\n", "is resolved"),
])
def test_csv_pipeline_refuses_broken_input_until_repaired(spark, tmp_path, row, reason):
    import os

    from tessera.operators.quality import QualityGateError
    from tessera.plans.pipeline import csv_pipeline
    from tessera.plans.publish import POINTER, quarantine, read_published

    good = "o1,1,p1,s1,2018-01-08 00:00:00,10.50,2.25\n"
    root = str(tmp_path / "lake")
    sources, tax = _csv_sources(tmp_path, order_items=ITEM_HEADER + ("" if reason == "values convert" else good) + row)
    with pytest.raises(QualityGateError, match=reason):
        csv_pipeline(spark, sources, tax, root, run_id="broken")
    assert not os.path.exists(os.path.join(root, POINTER))
    if reason == "is resolved":
        return  # the unknown order stays in Bronze until its order, product and seller arrive
    sources, tax = _csv_sources(tmp_path, order_items=ITEM_HEADER + good)
    if reason == "lines parse":  # the broken line stays in quarantine, and every run fails, until its batch is accepted
        with pytest.raises(QualityGateError, match=reason):
            csv_pipeline(spark, sources, tax, root, run_id="again")
        bronze = {"order_items": spark.read.parquet(os.path.join(root, "bronze", "order_items"))}
        line = quarantine(bronze).first()
        assert line.line == row.rstrip()
        csv_pipeline(spark, sources, tax, root, run_id="repaired", accepted_batches=[line.batch_id])
    else:
        csv_pipeline(spark, sources, tax, root, run_id="repaired")
    items = read_published(spark, root, "fact_order_item").collect()
    assert [(r.order_id, str(r.item_price)) for r in items] == [("o1", "10.50")]


def test_csv_timestamps_have_no_zone(spark):
    """A wall-clock time inside a daylight-saving gap stays as written, whatever the session zone."""
    raw = raw_df(spark, "orders", [{"order_id": "o1", "customer_id": "c1", "purchased_at": "2018-03-11 02:30:00"}])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        orders = S.silver_orders(raw)
        assert orders.schema["purchased_at"].dataType.typeName() == "timestamp_ntz"
        assert str(orders.first().purchased_at) == "2018-03-11 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_csv_pipeline_end_to_end(spark, tmp_path):
    from tessera.plans.pipeline import csv_pipeline
    from tessera.plans.publish import read_published

    sources, tax = _csv_sources(tmp_path)
    root = str(tmp_path / "lake")
    report = csv_pipeline(spark, sources, tax, root, run_id="first")
    assert report.count() == 16 and report.where("NOT passed").count() == 0
    fact = read_published(spark, root, "fact_order_item").first()
    assert str(fact.item_price) == "10.50" and fact.purchase_year == 2018 and fact.seller_state == "SP"
    review = read_published(spark, root, "fact_review").first()
    assert review.category_family == "Electronics"
    # re-running the same raw files (a duplicate Bronze batch) publishes identical Gold
    from tessera.operators.fingerprint import fingerprint

    before = {t: fingerprint(read_published(spark, root, t)).drop("table_name").first()
              for t in ("fact_order_item", "fact_review", "dim_customer")}
    csv_pipeline(spark, sources, tax, root, run_id="second")
    after = {t: fingerprint(read_published(spark, root, t)).drop("table_name").first() for t in before}
    assert before == after


def test_cast_failures_counts_bad_values(spark):
    from tessera.sources.schemas import SILVER_SPECS

    raw = raw_df(spark, "order_reviews", [
        {"review_id": "r1", "order_id": "o1", "review_score": "x", "review_creation_date": "2018-01-01 00:00:00"},
        {"review_id": "r2", "order_id": "o1", "review_score": "4", "review_creation_date": "not a date"},
        {"review_id": "r3", "order_id": "o1", "review_score": None, "review_creation_date": None},
    ])
    got = {r.column_name: (r.non_null_values, r.failed_casts)
           for r in S.cast_failures(raw, SILVER_SPECS["order_reviews"]).collect()}
    assert got["review_score"] == (2, 1)
    assert got["review_creation_date"] == (2, 1)
    assert got["review_answer_timestamp"] == (0, 0)
    items = raw_df(spark, "order_items", [{"order_id": "o", "order_item_id": "1", "item_price": "12,50"},
                                          {"order_id": "o", "order_item_id": "two", "item_price": "3.10"}])
    got = {r.column_name: r.failed_casts for r in S.cast_failures(items, SILVER_SPECS["order_items"]).collect()}
    assert got["item_price"] == 1 and got["order_item_id"] == 1


def test_marketplace_taxonomy_fixed_values(spark):
    from tessera.operators.taxonomy import enrich_taxonomy
    from tessera.sources.taxonomy_data import marketplace_taxonomy, marketplace_taxonomy_rows

    rows = marketplace_taxonomy_rows()
    assert len(rows) == 73 and len({r[0] for r in rows}) == 73 and len({r[1] for r in rows}) == 73
    assert len({r[2] for r in rows}) == 26
    tax = marketplace_taxonomy(spark)
    assert tax.count() == 73
    products = spark.createDataFrame([("p1", " alimentos "), ("p2", "unknown")], "product_id string, product_category_name string")
    got = {r.product_id: r.category_family for r in enrich_taxonomy(products, tax, "product_category_name").collect()}
    assert got == {"p1": "Food & Beverage", "p2": None}


def test_null_keys_and_orphans_are_reported(spark):
    from tessera.operators.profile import orphan_rows, orphan_summary
    from tessera.operators.quality import unresolved_fk_rates

    raw, silver, gold = market(spark)
    rates = {r.test_name: (r.rows_evaluated, r.rows_failed) for r in unresolved_fk_rates(gold).collect()}
    assert rates["fact_payment.customer_key is resolved"] == (3, 1)        # o3 has a NULL customer
    assert rates["fact_order_item.product_key is resolved"] == (4, 1)      # unknown product pX
    s = orphan_summary(silver["order_items"], "product_id", silver["products"], "product_id", "items -> products").first()
    assert (s.child_values, s.orphan_values) == (3, 1)
    rows = orphan_rows(silver["order_items"], "product_id", silver["products"], "product_id").collect()
    assert [(r.order_id, r.product_id) for r in rows] == [("o2", "pX")]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_analyses_run_on_wall_clock_and_zoned_timestamps(spark, kind):
    from pyspark.sql import functions as F

    from tessera.operators import analytics as N
    from tessera.operators import marts as M
    from tessera.operators import quality as Q

    raw, silver, gold = market(spark)
    assert dict(silver["orders"].dtypes)["purchased_at"] == "timestamp_ntz"  # as read from CSV
    if kind == "timestamp":  # a typed source with zoned timestamps
        orders = silver["orders"]
        silver = {**silver, "orders": orders.select(*(F.col(c).cast(kind) if t == "timestamp_ntz" else F.col(c)
                                                      for c, t in orders.dtypes))}
        gold = build_star(silver)
    outs = [
        N.late_delivery_rate(gold["fact_order_item"], gold["dim_seller"], gold["dim_product"], min_items=1),
        N.delivery_lag_by_state(gold["fact_order_item"], gold["dim_customer"]),
        N.negative_review_mom(gold["fact_review"]),
        N.order_value_anomalies(gold["fact_order_item"], gold["dim_product"]),
        N.category_value_ranking(gold["fact_order_item"], gold["dim_product"]),
        Q.dq_report(gold, silver["orders"], "purchased_at", F.lit("2018-03-03 12:00:00").cast("timestamp")),
        M.mart_delivery_performance(silver["orders"], silver["order_items"]),
        M.mart_customer_summary(silver["customers"], silver["orders"], silver["order_items"]),
    ]
    for df in outs:
        df.collect()
    late = outs[0].collect()
    assert [(r.seller_id, r.delivered_items, r.late_items) for r in late] == [("s1", 2, 0)]  # item 3 is unmapped
    lag = {r.customer_state: r.average_purchase_to_delivery_days for r in outs[1].collect()}
    assert lag == {"SP": 5.0, "RJ": -2.0}


def test_csv_columns_are_taken_by_name_and_breaking_headers_fail(spark, tmp_path):
    from datetime import datetime

    import pytest

    from tessera.sources.io import header_drift, ingest_batch, read_raw

    # reordered columns and an extra one: values must land in the right columns
    p = tmp_path / "c1"
    p.mkdir()
    (p / "c.csv").write_text("customer_state,extra,customer_id,customer_city,customer_unique_id,customer_zip_code_prefix\n"
                             "sp,x,c1,sao paulo,u1,01409\n")
    r = read_raw(spark, str(p), "customers").first()
    assert (r.customer_id, r.customer_state, r.customer_zip_code_prefix) == ("c1", "sp", "01409")
    drift = {(d.column_name, d.change, d.breaking) for d in header_drift(spark, str(p), "customers").collect()}
    assert drift == {("extra", "added", False)}
    # a missing declared column is a breaking change: nothing is appended
    q = tmp_path / "c2"
    q.mkdir()
    (q / "c.csv").write_text("customer_id,customer_unique_id,customer_city,customer_state\nc2,u2,rio,rj\n")
    bronze = str(tmp_path / "bronze")
    with pytest.raises(ValueError):
        ingest_batch(spark, {"customers": str(q)}, bronze, ("b1", datetime(2024, 1, 1)))
    import os

    assert not os.path.exists(os.path.join(bronze, "customers"))
    # the compatible source ingests
    ingest_batch(spark, {"customers": str(p)}, bronze, ("b2", datetime(2024, 1, 2)))
    assert spark.read.parquet(os.path.join(bronze, "customers")).count() == 1
