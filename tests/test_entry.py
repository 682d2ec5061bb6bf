"""Driver contract: entry smoke, registry completeness, and every query against its
DuckDB oracle on the smallest scale (row count, columns, order-insensitive values)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = ["lineitem", "events", "pages", "nation", "customer"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["year", "month", "reporting_airline"]


# the corpus queries are tested in tests/llm
OWN = sorted(set(E.queries()) - set([*E.llm_queries.queries(), "pipeline"] if E.llm_queries else []))


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


_BUILT: dict = {}


def _built(spark, name):
    """A query's DataFrame, built once: the jobs among the queries run when they are built."""
    if name not in _BUILT:
        _BUILT[name] = E.queries()[name](spark, SF001)
    return _BUILT[name]


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    df = _built(spark, name)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = duck.execute(E.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [c[0] for c in cur.description]
    assert sorted(scols) == sorted(dcols)
    assert _rows(scols, srows) == _rows(dcols, drows)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", OWN)
def test_plan_has_no_pair_joins_or_python(spark, name):
    """Scale audit of every registered query's physical plan."""
    plan = _built(spark, name)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"


def test_gold_scans_prune_columns_and_push_filters(spark):
    df = E.queries()["delay_cause_analysis"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(arrdelay)" in plan and "GreaterThan(arrdelay,15.0)" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "deptimeblk" not in scan and "origincityname" not in scan  # unused columns never read
