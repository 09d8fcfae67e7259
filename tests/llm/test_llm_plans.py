"""Plan guards of the text queries: no joins that produce all pairs; rules stay built-in."""

import pytest

from conftest import SF001
from tessera.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pair_joins(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if op in plan]
    assert not bad, (name, bad)
    if name == "op10_quality_rules":
        assert "Python" not in plan and "Arrow" not in plan
