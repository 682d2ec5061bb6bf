"""Mergeable states, trend continuation, log folds and digest-first duplicates against the direct forms."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import canon
from runway.operators import dq, gold, rollup, state


def _flights(make_flights, seed, n=400):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        cancelled = float(r.random() < .1)
        rows.append({"year": r.choice([2022, 2023, 2024]), "month": r.randint(1, 12), "dayofmonth": r.randint(1, 3),
                     "reporting_airline": r.choice(["AA", "BB", "CC"]), "origin": r.choice(["JFK", "LAX", "SFO"]),
                     "dest": r.choice(["ORD", "SEA", None]), "cancelled": cancelled, "diverted": float(r.random() < .05),
                     "arrdelay": None if cancelled or r.random() < .1 else float(r.randint(-20, 200)),
                     "depdelay": None if cancelled else float(r.randint(-5, 90)), "distance": r.choice([100.0, 700.0, 2000.0, None])})
    return make_flights(rows)


def test_states_merge_to_the_direct_tables(make_flights):
    df = _flights(make_flights, 1)
    half = F.pmod(F.xxhash64("origin", "arrdelay"), F.lit(2)) == 0
    parts = [df.where(half), df.where(~half)]
    states = parts[0].transform(rollup.kpi_states).unionAll(rollup.kpi_states(parts[1]))
    delays = rollup.delay_histogram(parts[0]).unionAll(rollup.delay_histogram(parts[1]))
    want = gold.airline_monthly_kpi(df)
    got = rollup.kpi_from_states(states, delays).select(*want.columns)
    assert canon(got.collect()) == canon(want.collect())
    year = rollup.kpi_from_states(states, delays, ("year",)).orderBy("year").collect()
    direct = gold.airline_monthly_kpi(df.withColumns({"month": F.lit(1), "reporting_airline": F.lit("x")})).orderBy("year").collect()
    assert [tuple(r[c] for c in want.columns[3:]) for r in year] == [tuple(r)[3:] for r in direct]


def test_connectivity_rollup(make_flights):
    df = _flights(make_flights, 2)
    roles = gold.airport_roles(df)
    got = rollup.connectivity_rollup(rollup.connectivity_bitmaps(
        df, rollup.numbered(df, "reporting_airline"), rollup.numbered(roles, "peer_airport")))
    for grain, keys in (("day", 5), ("month", 4), ("year", 3)):
        keys = list(rollup.ROLLUP_KEYS[:keys])
        want = roles.groupBy(*keys).agg(F.count_distinct("reporting_airline").alias("num_carriers"), F.count_distinct("peer_airport").alias("n"))
        assert canon(got.where(F.col("grain") == grain).select(*keys, "num_carriers", "num_connected_airports").collect()) == canon(want.collect())


def test_trend_continues_from_its_tail(make_flights):
    kpi = gold.airline_monthly_kpi(_flights(make_flights, 3))
    want = gold.monthly_trend(kpi)
    tail, got = None, []
    for year in (2022, 2023, 2024):
        own = kpi.where(F.col("year") == year)
        tail = kpi.limit(0) if tail is None else tail
        got += rollup.continued_trend(own, tail).select(*want.columns).collect()
        tail = rollup.trend_tail(own, tail)
    assert canon(got) == canon(want.collect())
    assert tail.groupBy("reporting_airline").count().agg(F.max("count")).first()[0] == rollup.TAIL


@pytest.mark.parametrize("seed", [1, 2])
def test_marker_snapshots_fold_at_any_cut(spark, seed):
    r = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    log = [(r.randint(1, 6), i, t0 + dt.timedelta(minutes=i), r.choices(["SOURCE", "CODE", "success", "skipped"], [30, 1, 1, 1])[0]) for i in range(220)]
    df = spark.createDataFrame(log, "unit int, seq long, attempt_ts timestamp, outcome string")
    want = canon(state.marker_state(df).collect())
    for cut in (-1, 20, 110, 219):
        parts = [state.marker_snapshot(df.where(F.col("seq") <= cut)), state.marker_snapshot(df.where(F.col("seq") > cut))]
        assert canon(state.marker_of(state.merge_snapshots(*parts)).collect()) == want


def test_clean_by_digest(spark, make_flights):
    df = _flights(make_flights, 4, 150)
    flagged = dq.flag(df.unionAll(df.where("month < 4")).unionAll(df.where("month = 1")))
    want = canon(dq.clean(flagged).collect())
    assert canon(dq.clean_by_digest(flagged).collect()) == want
    # every digest equal, and a handful of marks: the same rows by whole comparison
    same = lambda columns: (F.lit(7).cast("long"), F.lit(7).cast("long"))
    assert canon(dq.clean_by_digest(flagged, digest=same).collect()) == want
    assert canon(dq.clean_by_digest(flagged, bits=3).collect()) == want
    # only repeated rows are unsure
    rows = spark.range(5000).unionAll(spark.range(40, 60)).unionAll(spark.range(40, 41))
    told = dq.unsure_rows(rows)
    assert {r.id for r in told.where("_unsure").collect()} == set(range(40, 60)) and told.count() == 5021
