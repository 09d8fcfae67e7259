"""Plan-level guards: JVM-side execution, no pair-producing joins, map-side dedupe limit."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from tessera.plans.catalog import QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas")


# the optional text operators have their own guard next to their tests
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_jvm_side_without_pair_joins(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, (name, bad)


def test_dedupe_limits_rows_before_the_shuffle(spark):
    plan = E.queries()["silver_order_items"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    limit_rows = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchange_rows = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(order_id" in line]
    # the tree prints parents first: a WindowGroupLimit below (after) the exchange runs map-side
    assert exchange_rows and any(i > exchange_rows[0] for i in limit_rows), plan


def test_operators_do_not_collect_rows():
    import pathlib
    import re

    # report rows; and lists bounded by buckets (a tree's unequal nodes) and files (one header each)
    allowed = {"assert_passed", "assert_compatible", "validate_fact_grain", "validate_referential_integrity",
               "unequal_buckets", "_signatures"}
    root = pathlib.Path(__file__).resolve().parents[1] / "tessera" / "operators"
    for path in root.glob("*.py"):
        src = path.read_text()
        for m in re.finditer(r"def (\w+)\(", src):
            body = src[m.end():].split("\ndef ", 1)[0]
            if re.search(r"\.(collect|toPandas|take)\(", body):
                assert m.group(1) in allowed, (path.name, m.group(1))


@pytest.mark.parametrize("name", ["idempotency_check", "rule_violations", "table_fingerprint"])
def test_checks_of_the_star_read_staged_tables(spark, name):
    """Silver is deduplicated once and written; each check would derive it again otherwise."""
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and "lineitem.parquet" not in plan


def test_metrics_of_a_run_read_staged_items(spark, monkeypatch):
    from tessera.operators import metrics as H

    plans, record = [], H.record

    def noted(change, run, metrics):
        plans.append(metrics._jdf.queryExecution().executedPlan().toString())
        record(change, run, metrics)

    monkeypatch.setattr(H, "record", noted)
    E.queries()["run_metric_deltas"](spark, SF001)
    assert len(plans) == 2 and not any("l_linenumber" in p for p in plans)
