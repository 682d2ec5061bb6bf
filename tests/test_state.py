"""Incremental-state operators on hand-made keyed inputs, plus properties on the fixture."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from runway.operators import state as st


def D(y, m):
    return dt.date(y, m, 1)


def months_df(spark, rows):
    return spark.createDataFrame(rows, "key string, month date, outcome string")


def marks_df(spark, rows):
    return spark.createDataFrame(rows, "key string, watermark date")


def test_month_calendar_and_empty_range(spark):
    b = spark.createDataFrame([("a", D(2024, 11), D(2025, 2)), ("b", D(2025, 3), D(2025, 1))],
                              "key string, start date, end date")
    got = [(r["key"], r["month"]) for r in st.month_calendar(b).orderBy("key", "month").collect()]
    assert got == [("a", D(2024, 11)), ("a", D(2024, 12)), ("a", D(2025, 1)), ("a", D(2025, 2))]


def test_work_window_modes_and_checks(spark):
    marks = marks_df(spark, [("a", D(2025, 1))])
    ceiling = F.lit(D(2025, 3))
    inc = [r["month"] for r in st.work_window(marks, ceiling).orderBy("month").collect()]
    assert inc == [D(2025, 2), D(2025, 3)]
    rep = [r["month"] for r in st.work_window(marks, ceiling, st.REPROCESS, "2024-12", "2025-01")
           .orderBy("month").collect()]
    assert rep == [D(2024, 12), D(2025, 1)]
    with pytest.raises(ValueError):
        st.work_window(marks, ceiling, st.REPROCESS, "2025-02", "2025-01")
    with pytest.raises(ValueError):
        st.work_window(marks, ceiling, st.REPROCESS, "2025-13")
    with pytest.raises(Exception):
        st.work_window(marks, ceiling, st.REPROCESS, "2025-01", "2025-06").collect()
    # bronze checks only start <= end
    assert st.work_window(marks, ceiling, st.REPROCESS, "2025-01", "2025-06", layer="bronze").count() == 6


def test_watermarks(spark):
    outcomes = months_df(spark, [
        ("a", D(2025, 1), "success"), ("a", D(2025, 2), "skipped"), ("a", D(2025, 3), "missing"),
        ("a", D(2025, 4), "success"),
        ("b", D(2025, 1), "failed"), ("b", D(2025, 2), "success"),
        ("c", D(2024, 6), "success"),
    ])
    marks = marks_df(spark, [("a", D(2024, 12)), ("b", D(2024, 12)), ("c", D(2024, 12)), ("d", D(2024, 12))])
    leap = {r["key"]: r["new_watermark"] for r in st.leapfrog_watermark(marks, outcomes).collect()}
    cont = {r["key"]: r["new_watermark"] for r in st.contiguous_watermark(marks, outcomes).collect()}
    assert leap == {"a": D(2025, 4), "b": D(2025, 2), "c": D(2024, 12), "d": D(2024, 12)}
    assert cont == {"a": D(2025, 2), "b": D(2024, 12), "c": D(2024, 12), "d": D(2024, 12)}
    for k in leap:  # contiguous <= leapfrog, neither moves backwards
        assert cont[k] <= leap[k] and leap[k] >= D(2024, 12)
    rep = {r["key"]: r["new_watermark"] for r in
           st.leapfrog_watermark(marks, outcomes, mode=st.REPROCESS).collect()}
    assert rep["a"] == D(2024, 12)


def test_gap_scan(spark):
    cal = spark.createDataFrame([("a", D(2025, m)) for m in (1, 2, 3, 4)], "key string, month date")
    done = spark.createDataFrame([("a", D(2025, 1)), ("a", D(2025, 4))], "key string, month date")
    markers = spark.createDataFrame([("a", D(2025, 2), "CODE"), ("a", D(2025, 3), "SOURCE")],
                                    "key string, month date, state string")
    got = {r["month"]: r["action"] for r in st.gap_scan(cal, done, markers).collect()}
    assert got == {D(2025, 2): "escalated", D(2025, 3): "retry"}


def _log(spark, unit, outcomes):
    base = dt.datetime(2024, 1, 1)
    return [(unit, i, base + dt.timedelta(hours=i), o) for i, o in enumerate(outcomes)]


def test_marker_state_transitions(spark):
    rows = (_log(spark, 1, ["SOURCE"] * 13)
            + _log(spark, 2, ["SOURCE"] * 16)
            + _log(spark, 3, ["SOURCE", "CODE", "SOURCE"])
            + _log(spark, 4, ["SOURCE", "CODE", "success"])
            + _log(spark, 5, ["CODE", "success", "SOURCE", "SOURCE"])
            + _log(spark, 6, ["skipped"]))
    log = spark.createDataFrame(rows, "unit bigint, seq bigint, attempt_ts timestamp, outcome string")
    s = {r["unit"]: r for r in st.marker_state(log, buckets=4).collect()}
    assert (s[1]["state"], s[1]["attempts"], s[1]["escalated"]) == ("SOURCE", 13, False)
    assert s[1]["first_seen"] == dt.datetime(2024, 1, 1)
    assert (s[2]["state"], s[2]["attempts"], s[2]["escalated"]) == ("CODE", 14, True)
    assert s[2]["escalated_at"] == dt.datetime(2024, 1, 1, 13)  # the 14th SOURCE attempt
    assert (s[3]["state"], s[3]["escalated"], s[3]["attempts"]) == ("CODE", False, None)
    assert s[4]["state"] == "none"
    assert (s[5]["state"], s[5]["attempts"]) == ("SOURCE", 2)
    assert s[6]["state"] == "none"
    body = {r["unit"]: r for r in st.parse_marker(st.marker_body(st.marker_state(log))).collect()}
    assert body[1]["kind"] == "SOURCE" and body[1]["parsed_attempts"] == 13
    assert body[1]["parsed_first_seen"] == "2024-01-01T00:00:00Z"
    assert body[2]["kind"] == "CODE" and body[2]["body"].startswith("CODE: Escalated after 14 attempts")
    assert body[4]["kind"] is None and body[4]["parsed_attempts"] == 0


def test_marker_state_fixture_counts(spark):
    """FIXTURES.md F4 at sf0.01: CODE 64, escalated 52, SOURCE 32, none 2."""
    from conftest import SF01
    from runway.sources import fixtures as fx

    s = st.marker_state(fx.attempt_log(spark, SF01))
    got = {(r["state"], r["escalated"]): r["n"] for r in s.groupBy("state", "escalated").agg(F.count("*").alias("n")).collect()}
    assert got == {("CODE", False): 64, ("CODE", True): 52, ("SOURCE", False): 32, ("none", False): 2}


def test_retryable_units(spark):
    work = spark.createDataFrame([(1,), (2,), (3,)], "unit bigint")
    markers = spark.createDataFrame([(1, "CODE"), (2, "SOURCE")], "unit bigint, state string")
    got = {r["unit"]: r["action"] for r in st.retryable_units(work, markers).collect()}
    assert got == {1: "blocked", 2: "run", 3: "run"}
    rep = {r["unit"]: r["action"] for r in st.retryable_units(work, markers, reprocess=True).collect()}
    assert rep == {1: "run", 2: "run", 3: "run"}


def test_classify_attempts(spark):
    rows = [(1, 200, None, 5000), (2, 404, None, 0), (3, 503, None, 0), (4, 403, None, 0), (5, 400, None, 0),
            (6, None, "network", 0), (7, None, "corrupt", 0), (8, None, "boom", 0), (9, 200, None, 100)]
    df = spark.createDataFrame(rows, "seq int, http_status int, error_kind string, size_bytes bigint")
    got = {r["seq"]: (r["outcome"], r["marker_class"]) for r in st.classify_attempts(df).collect()}
    assert got == {1: ("success", None), 2: ("missing", "SOURCE"), 3: ("missing", "SOURCE"),
                   4: ("failed", "CODE"), 5: ("failed", "CODE"), 6: ("missing", "SOURCE"),
                   7: ("missing", "SOURCE"), 8: ("failed", "CODE"), 9: ("missing", "SOURCE")}


@pytest.mark.parametrize("counts,mode,moved,status,total_failure", [
    ({"success": 2}, "incremental", True, "SUCCESS", False),
    ({"success": 1, "missing": 1}, "incremental", True, "PARTIAL SUCCESS — GAPS PRESENT", False),
    ({"success": 1, "failed": 1}, "incremental", False, "PARTIAL SUCCESS — WATERMARK STALLED", False),
    ({"missing": 2}, "incremental", False, "FAILED — WATERMARK STALLED", True),
    ({"skipped": 1}, "incremental", False, "SUCCESS", False),
    ({"failed": 1, "skipped": 1}, "reprocess", False, "REPROCESS FAILED", False),
    ({"failed": 1, "success": 1}, "reprocess", False, "REPROCESS PARTIAL", False),
    ({"success": 1}, "reprocess", False, "REPROCESS COMPLETE", False),
])
def test_run_status(spark, counts, mode, moved, status, total_failure):
    rows = [("a", D(2025, i + 1), o) for i, o in enumerate(o for o, n in counts.items() for _ in range(n))]
    outcomes = months_df(spark, rows)
    marks = spark.createDataFrame([("a", D(2024, 12), D(2025, 1) if moved else D(2024, 12))],
                                  "key string, old_watermark date, new_watermark date")
    r = st.run_status(outcomes, mode=mode, marks=marks).first()
    assert r["status"] == status and r["total_failure"] == total_failure


def test_run_status_bronze_flag(spark):
    outcomes = months_df(spark, [("a", D(2025, 1), "missing"), ("a", D(2025, 2), "failed")])
    assert st.run_status(outcomes, layer="bronze").first()["total_failure"] is False
    outcomes = months_df(spark, [("a", D(2025, 1), "failed")])
    assert st.run_status(outcomes, layer="bronze").first()["total_failure"] is True


def test_stale_years(spark):
    frontier = spark.createDataFrame([(2024, D(2024, 12)), (2025, D(2025, 3)), (2023, D(2023, 12))],
                                     "year int, latest_month date")
    markers = spark.createDataFrame([(2024, "latest_silver_month=2024-12\nprocessed_at=x"),
                                     (2025, "latest_silver_month=2025-02")], "year int, body string")
    got = {r["year"]: r["stale"] for r in st.stale_years(frontier, markers).collect()}
    assert got == {2023: True, 2024: False, 2025: True}


def test_gold_watermark_and_total_failure_guard(spark):
    yo = spark.createDataFrame([("g", 2024, "success", D(2024, 12)), ("g", 2025, "skipped", D(2025, 3)),
                                ("g", 2026, "failed", D(2026, 1))],
                               "key string, year int, outcome string, latest_month date")
    marks = marks_df(spark, [("g", D(2025, 1))])
    assert st.gold_watermark(marks, yo).first()["new_watermark"] == D(2025, 3)
    ok = months_df(spark, [("a", D(2025, 1), "success")])
    st.raise_on_total_failure(st.run_status(ok))
    bad = months_df(spark, [("a", D(2025, 1), "missing")])
    with pytest.raises(RuntimeError):
        st.raise_on_total_failure(st.run_status(bad))


def test_year_window(spark):
    marks = spark.createDataFrame([("g", 2023)], "key string, baseline int")
    years = lambda *a, **k: sorted(r["year"] for r in st.year_window(marks, F.lit(2025), *a, **k).collect())
    assert years() == [2023, 2024, 2025]
    assert years(st.REPROCESS, "2024") == [2024, 2025] and years(st.REPROCESS, "2023", "2024") == [2023, 2024]
    for bad in (("24",), ("x",), ("2025", "2024"), (None,)):
        with pytest.raises(ValueError):
            years(st.REPROCESS, *bad)
    with pytest.raises(Exception, match="exceeds ceiling"):
        years(st.REPROCESS, "2024", "2026")
