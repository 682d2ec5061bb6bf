"""Data-quality rules: one hand-made row per rule, boundary values, split/dedup properties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from runway.operators import dq
from conftest import canon

CASES = [
    ({"year": None}, ["DQ01: Null flight date"]),
    ({"dayofmonth": None}, ["DQ01: Null flight date"]),
    ({"reporting_airline": None}, ["DQ02: Null airline"]),
    ({"dest": None}, ["DQ03: Null route"]),
    ({"distance": None}, ["DQ04: Null distance"]),
    ({"month": 13}, ["DQ05: Invalid month"]),
    ({"month": 0}, ["DQ05: Invalid month"]),
    ({"month": 12}, []),
    ({"month": 1}, []),
    ({"dayofmonth": 32}, ["DQ06: Invalid dayofmonth"]),
    ({"dayofmonth": 0}, ["DQ06: Invalid dayofmonth"]),
    ({"distance": 0.0}, ["DQ07: Distance <= 0"]),
    ({"depdelay": -60.0}, []),
    ({"depdelay": -61.0}, ["DQ08: depdelay out of range"]),
    ({"depdelay": 1440.0}, []),
    ({"depdelay": 1441.0}, ["DQ08: depdelay out of range"]),
    ({"arrdelay": 1441.0}, ["DQ09: arrdelay out of range"]),
    ({"arrdelay": None}, []),
    ({"deptime": 2400}, []),
    ({"deptime": 2401}, ["DQ10: deptime invalid"]),
    ({"deptime": 0}, []),
    ({"arrtime": -1}, ["DQ10: arrtime invalid"]),
    ({"cancelled": 1.0, "deptime": None, "arrdelay": None}, ["DQ11: Cancelled flight has arrtime"]),
    ({"cancelled": 1.0, "deptime": None, "arrtime": None}, ["DQ12: Cancelled flight has arrdelay"]),
    ({"deptime": None}, ["DQ13: Operated flight has no deptime"]),
    ({"diverted": 1.0, "deptime": None}, []),
    ({"airtime": 331.0}, ["DQ14: airtime > actualelapsedtime"]),
    ({"airtime": None}, []),
    ({"dest": "JFK"}, ["DQ15: origin == dest"]),
    # NULL cancelled: neither DQ11/12 nor DQ13 (three-valued logic)
    ({"cancelled": None, "deptime": None}, []),
    # several rules in rule order
    ({"month": 13, "dayofmonth": 0, "dest": "JFK"},
     ["DQ05: Invalid month", "DQ06: Invalid dayofmonth", "DQ15: origin == dest"]),
]


@pytest.mark.parametrize("override,expected", CASES)
def test_rule_fires(make_flights, override, expected):
    row = dq.flag(make_flights([override])).select("rejection_reason").first()
    reason = row["rejection_reason"]
    if expected:
        assert reason == " | ".join(expected)
    else:
        assert reason is None


def test_thresholds_are_parameters(make_flights):
    rules = dq.default_rules(max_delay=100)
    reason = dq.flag(make_flights([{"depdelay": 101.0}]), rules).first()["rejection_reason"]
    assert reason == "DQ08: depdelay out of range"


def test_split_dedup_metrics_properties(make_flights):
    rows = [{}, {}, {}, {"dayofmonth": 11}, {"month": 13}, {"month": 13}, {"distance": None}]
    flagged = dq.flag(make_flights(rows))
    clean = dq.clean(flagged)
    rejected = dq.rejected(flagged)
    assert clean.count() == 2  # three copies collapse to one + the other day
    assert rejected.count() == 3  # duplicates kept in the rejected set
    m = dq.metrics(flagged, keys=()).first()
    assert m["total_rows"] == 7 and m["rejected_rows"] == 3 and m["clean_rows"] == 2
    assert m["dupes_removed"] == 2
    assert m["rejection_pct"] == pytest.approx(42.86)
    # counts-based outputs equal the direct operators
    counts = dq.copy_counts(flagged)
    assert canon(dq.clean_from_counts(counts).collect()) == canon(clean.collect())


def test_breakdown_forms_agree_and_cover_rejected(make_flights):
    rows = [{"month": 13, "dest": "JFK"}, {"distance": None}, {"dest": "JFK"}, {}]
    flagged = dq.flag(make_flights(rows))
    a = {r["reason"]: r["cnt"] for r in dq.breakdown(flagged).collect()}
    b = {r["reason"]: r["cnt"] for r in dq.breakdown_by_reason(flagged).collect()}
    assert a == b == {"DQ15: origin == dest": 2, "DQ05: Invalid month": 1, "DQ04: Null distance": 1}
    assert sum(a.values()) >= dq.rejected(flagged).count()


def test_severity_rollup(make_flights):
    flagged = dq.flag(make_flights([{"year": None}, {"distance": 0.0}, {"dest": "JFK"}]))
    got = {r["severity"]: r["cnt"] for r in dq.severity_rollup(flagged).collect()}
    assert got == {"Critical": 1, "Major": 1, "Logical": 1}


def test_duplicate_groups_and_alerts(make_flights):
    flagged = dq.flag(make_flights([{}, {}, {}, {"month": 13}]))
    clean_rows = flagged.where(F.col("rejection_reason").isNull()).drop("rejection_reason")
    g = dq.duplicate_groups(clean_rows).collect()
    assert len(g) == 1 and g[0]["copies_removed"] == 2
    m = dq.metrics(flagged)
    alerts = {(r["year"], r["month"]) for r in dq.alert_months(m).collect()}
    assert alerts == {(2024, 13)}


def test_fixture_counts_sf001(spark):
    """FIXTURES.md counts at sf0.01: rows, rejected, clean, deduped and rule firings."""
    from conftest import SF01
    from runway.sources import fixtures as fx

    raw = fx.flights(spark, SF01)
    flagged = dq.flag(raw)
    m = dq.metrics(flagged, keys=()).first()
    assert (m["total_rows"], m["rejected_rows"], m["clean_rows"]) == (60633, 3244, 56786)
    assert m["total_rows"] - m["rejected_rows"] == 57389
    fired = {r["reason"]: r["cnt"] for r in dq.breakdown(raw).collect()}
    assert fired["DQ09: arrdelay out of range"] == 444
    assert fired["DQ11: Cancelled flight has arrtime"] == 450
    assert fired["DQ10: arrtime invalid"] == 165
