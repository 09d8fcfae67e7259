
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF01


def q(spark, name):
    return E.queries()[name](spark, SF01)


def test_star_sizes(spark):
    assert q(spark, "fact_order_item").count() == 45_832
    fr = q(spark, "fact_review")
    assert fr.count() == 46_059
    assert fr.where("product_resolved").count() == 45_802
    assert fr.where(F.col("category_family").isNotNull()).count() == 38_259
    assert q(spark, "dim_date").count() == 2_399
    assert q(spark, "fact_partition_sizes").count() == 175


def test_analysis_figures(spark):
    n1 = q(spark, "late_delivery_rate").collect()
    assert len(n1) == 159
    assert sum(r.delivered_items for r in n1) == 1_324 and sum(r.late_items for r in n1) == 63
    assert n1[0].late_delivery_rate_pct == 45.45
    n2 = q(spark, "delivery_lag_by_state").collect()
    assert len(n2) == 25 and sum(r.delivered_items for r in n2) == 45_832
    n3 = q(spark, "negative_review_mom").collect()
    assert len(n3) == 158 and max(r.mom_change_pct for r in n3) == 75.0
    n4 = q(spark, "order_value_anomalies").collect()
    assert len(n4) == 1_114 and n4[0].multiple_of_category_p95 == 2.01  # 2.008 rounded to 2 decimals
    n5 = {r.category_family: (r.orders, r.units_sold) for r in q(spark, "category_value_ranking").collect()}
    assert n5 == {"Core": (9_930, 14_968), "Sized": (12_377, 23_316)}


def test_temporal_check_figures(spark):
    rows = {r.check_no: r for r in q(spark, "dq_report").collect()}
    assert (rows[8].rows_evaluated, rows[8].rows_failed) == (45_832, 20_137)
