"""Brute-force checks: random small inputs, Spark operator vs a sequential Python fold
of the same rules (the loop a single-key driver would run)."""

from __future__ import annotations

import datetime as dt
import random

from runway.operators import dq
from runway.operators import state as st

MAX = st.MAX_SOURCE_RETRIES


def fold_marker(outcomes):
    """Apply attempts in order to a marker: (state, attempts, escalated, first_idx, esc_idx)."""
    marker = None  # (kind, attempts, escalated, first_idx, esc_idx)
    for i, o in enumerate(outcomes):
        if o in ("success", "skipped"):
            marker = None
        elif o == "CODE":
            marker = ("CODE", None, False, None, None)
        elif marker is None:
            marker = ("SOURCE", 1, False, i, None)
        elif marker[0] == "SOURCE":
            n = marker[1] + 1
            marker = ("CODE", MAX, True, marker[3], i) if n >= MAX else ("SOURCE", n, False, marker[3], None)
        # SOURCE on CODE: unchanged
    return marker


def test_marker_state_matches_fold(spark):
    rng = random.Random(7)
    rows, expect = [], {}
    base = dt.datetime(2024, 1, 1)
    for unit in range(60):
        n = rng.choice([0, 1, 5, 13, 14, 15, 30, 45])
        weights = rng.choice([(0.9, 0.05, 0.05), (0.6, 0.2, 0.2), (0.97, 0.0, 0.03)])
        outs = rng.choices(["SOURCE", "CODE", "success"], weights=weights, k=n)
        if not outs:
            outs = ["skipped"]
        seqs = sorted(rng.sample(range(10_000), len(outs)))
        for s, o in zip(seqs, outs):
            rows.append((unit, s, base + dt.timedelta(minutes=s), o))
        m = fold_marker(outs)
        ts = [base + dt.timedelta(minutes=s) for s in seqs]
        if m is None:
            expect[unit] = ("none", 0, False, None, None)
        else:
            expect[unit] = (m[0], m[1], m[2], ts[m[3]] if m[3] is not None else None,
                            ts[m[4]] if m[4] is not None else None)
    log = spark.createDataFrame(rows, "unit bigint, seq bigint, attempt_ts timestamp, outcome string")
    got = {r["unit"]: (r["state"], r["attempts"], r["escalated"], r["first_seen"], r["escalated_at"])
           for r in st.marker_state(log, buckets=8).collect()}
    assert got == expect


def fold_watermarks(old, outcomes):
    """Leapfrog: max ok month above old. Contiguous: walk month by month while ok."""
    ok = {m for m, o in outcomes.items() if o in ("success", "skipped")}
    leap = max([old] + [m for m in ok if m > old])
    cur, nxt = old, old + 1
    while nxt in outcomes and outcomes[nxt] in ("success", "skipped"):
        cur, nxt = nxt, nxt + 1
    return leap, cur


def idx_to_date(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


def test_watermarks_match_fold(spark):
    rng = random.Random(11)
    out_rows, mark_rows, expect = [], [], {}
    for k in range(40):
        old = rng.randint(0, 30)
        months = sorted(rng.sample(range(0, 60), rng.randint(0, 25)))
        outcomes = {m: rng.choice(["success", "skipped", "missing", "failed"]) for m in months}
        for m, o in outcomes.items():
            out_rows.append((f"k{k}", idx_to_date(m), o))
        mark_rows.append((f"k{k}", idx_to_date(old)))
        leap, cont = fold_watermarks(old, outcomes)
        expect[f"k{k}"] = (idx_to_date(leap), idx_to_date(cont))
    outcomes_df = spark.createDataFrame(out_rows, "key string, month date, outcome string")
    marks = spark.createDataFrame(mark_rows, "key string, watermark date")
    leap = {r["key"]: r["new_watermark"] for r in st.leapfrog_watermark(marks, outcomes_df).collect()}
    cont = {r["key"]: r["new_watermark"] for r in st.contiguous_watermark(marks, outcomes_df).collect()}
    assert {k: (leap[k], cont[k]) for k in expect} == expect


def py_reason(r):
    fired = []

    def nn(*xs):
        return all(x is not None for x in xs)

    if r["year"] is None or r["month"] is None or r["dayofmonth"] is None:
        fired.append("DQ01: Null flight date")
    if r["reporting_airline"] is None:
        fired.append("DQ02: Null airline")
    if r["origin"] is None or r["dest"] is None:
        fired.append("DQ03: Null route")
    if r["distance"] is None:
        fired.append("DQ04: Null distance")
    if nn(r["month"]) and (r["month"] < 1 or r["month"] > 12):
        fired.append("DQ05: Invalid month")
    if nn(r["dayofmonth"]) and (r["dayofmonth"] < 1 or r["dayofmonth"] > 31):
        fired.append("DQ06: Invalid dayofmonth")
    if nn(r["distance"]) and r["distance"] <= 0:
        fired.append("DQ07: Distance <= 0")
    if nn(r["depdelay"]) and (r["depdelay"] < -60 or r["depdelay"] > 1440):
        fired.append("DQ08: depdelay out of range")
    if nn(r["arrdelay"]) and (r["arrdelay"] < -60 or r["arrdelay"] > 1440):
        fired.append("DQ09: arrdelay out of range")
    if nn(r["deptime"]) and (r["deptime"] < 0 or r["deptime"] > 2400):
        fired.append("DQ10: deptime invalid")
    if nn(r["arrtime"]) and (r["arrtime"] < 0 or r["arrtime"] > 2400):
        fired.append("DQ10: arrtime invalid")
    if r["cancelled"] == 1 and r["arrtime"] is not None:
        fired.append("DQ11: Cancelled flight has arrtime")
    if r["cancelled"] == 1 and r["arrdelay"] is not None:
        fired.append("DQ12: Cancelled flight has arrdelay")
    if r["cancelled"] == 0 and r["diverted"] == 0 and r["deptime"] is None:
        fired.append("DQ13: Operated flight has no deptime")
    if nn(r["airtime"], r["actualelapsedtime"]) and r["airtime"] > r["actualelapsedtime"]:
        fired.append("DQ14: airtime > actualelapsedtime")
    if nn(r["origin"], r["dest"]) and r["origin"] == r["dest"]:
        fired.append("DQ15: origin == dest")
    return " | ".join(fired) or None


def test_flags_match_python_rules(make_flights):
    rng = random.Random(3)

    def maybe(v, p=0.15):
        return None if rng.random() < p else v

    rows = []
    for _ in range(300):
        rows.append({
            "year": maybe(2024), "month": maybe(rng.choice([0, 1, 6, 12, 13])),
            "dayofmonth": maybe(rng.choice([0, 1, 15, 31, 32])),
            "reporting_airline": maybe("AA"), "origin": maybe(rng.choice(["JFK", "LAX"])),
            "dest": maybe(rng.choice(["JFK", "LAX"])), "distance": maybe(rng.choice([-1.0, 0.0, 499.0, 2000.0])),
            "depdelay": maybe(rng.choice([-61.0, -60.0, 0.0, 1440.0, 1441.0])),
            "arrdelay": maybe(rng.choice([-61.0, 15.0, 1441.0])),
            "deptime": maybe(rng.choice([-1, 0, 2400, 2401])), "arrtime": maybe(rng.choice([-5, 1200, 2500])),
            "cancelled": maybe(rng.choice([0.0, 1.0])), "diverted": maybe(rng.choice([0.0, 1.0])),
            "airtime": maybe(rng.choice([10.0, 400.0])), "actualelapsedtime": maybe(rng.choice([50.0, 300.0])),
        })
    df = make_flights(rows)
    got = [r["rejection_reason"] for r in dq.flag(df).collect()]
    want = [py_reason(r.asDict()) for r in df.collect()]
    assert got == want


def test_marker_state_with_one_hot_unit(spark):
    """A unit holding most of the log (5,000 attempts) is still exact: its island
    is spread over the seq buckets and only 14 candidates per bucket are kept."""
    base = dt.datetime(2024, 1, 1)
    hot = ["SOURCE"] * 5000
    hot[100] = "success"  # the island starts after seq 100
    rows = [(0, i, base + dt.timedelta(seconds=i), o) for i, o in enumerate(hot)]
    rows += [(1, i, base, "SOURCE") for i in range(3)]
    log = spark.createDataFrame(rows, "unit bigint, seq bigint, attempt_ts timestamp, outcome string")
    s = {r["unit"]: r for r in st.marker_state(log, buckets=16).collect()}
    assert (s[0]["state"], s[0]["escalated"], s[0]["attempts"]) == ("CODE", True, MAX)
    assert s[0]["first_seen"] == base + dt.timedelta(seconds=101)
    assert s[0]["escalated_at"] == base + dt.timedelta(seconds=100 + MAX)
    assert (s[1]["state"], s[1]["attempts"]) == ("SOURCE", 3)


def test_hot_duplicate_group_stays_whole(make_flights):
    """One clean row copied 3,000 times and one rejected row copied 2,000 times."""
    rows = [{}] * 3000 + [{"month": 13}] * 2000 + [{"dayofmonth": 11}]
    flagged = dq.flag(make_flights(rows).repartition(8))
    assert dq.clean(flagged).count() == 2
    assert dq.rejected(flagged).count() == 2000
    m = {(r["month"]): r for r in dq.metrics(flagged).collect()}
    assert m[5]["dupes_removed"] == 2999 and m[5]["clean_rows"] == 2 and m[13]["rejected_rows"] == 2000
