"""Plan checks over every registered query: no cartesian product or nested-loop join
(all joins are equi-joins), no row-at-a-time Python UDF (only Arrow batches)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E

from .conftest import SMALL

QUERIES = E.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pair_product_or_row_udf(spark, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"
