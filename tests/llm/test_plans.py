"""Plan audit of the corpus queries: no pair joins, and no Python on the native ones' paths."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF001

NATIVE = ("op5_surrogates", "op6_quality_rules", "op13_url_filters")
PYTHON = ("Python", "Pandas", "MapInArrow", "ExistingRDD", "Scan OneRowRelation")


@pytest.mark.parametrize("name", sorted(E.llm_queries.queries()))
def test_plans(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", *(PYTHON if name in NATIVE else ())):
        assert op not in plan, op
