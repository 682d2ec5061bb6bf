"""Gold tables: band and hour edges, labels, NULL handling, trend windows, equivalences."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from runway.operators import gold
from conftest import canon


def by(rows, key):
    return {r[key]: r for r in rows}


def test_delay_band_edges(make_flights):
    delays = [-5.0, 0.0, 1.0, 15.0, 16.0, 60.0, 61.0, 120.0, 121.0]
    df = make_flights([{"arrdelay": d} for d in delays] + [{"arrdelay": None}])
    r = gold.airline_monthly_kpi(df).first()
    assert r["flights_early_or_ontime"] == 2
    assert r["flights_delayed_1_to_15"] == 2
    assert r["flights_delayed_16_to_60"] == 2
    assert r["flights_delayed_61_to_120"] == 2
    assert r["flights_delayed_over_120"] == 1
    # NULL arrdelay on an operated flight: in the denominator, not the numerator
    assert r["operated_flights"] == 10 and r["on_time_flights"] == 4
    assert r["on_time_pct"] == 40.0


def test_distance_bands_and_otp(make_flights):
    rows = [{"distance": d, "arrdelay": a} for d, a in
            [(499.0, 0.0), (500.0, 20.0), (1499.0, 0.0), (1500.0, 0.0), (2000.0, 30.0)]]
    r = gold.airline_monthly_kpi(make_flights(rows)).first()
    assert (r["operated_short_haul"], r["operated_medium_haul"], r["operated_long_haul"]) == (1, 2, 2)
    assert (r["otp_short_haul"], r["otp_medium_haul"], r["otp_long_haul"]) == (100.0, 50.0, 50.0)


def test_cancelled_and_diverted_scopes(make_flights):
    rows = [{}, {"cancelled": 1.0, "arrtime": None, "arrdelay": None, "depdelay": None, "distance": 100.0},
            {"diverted": 1.0, "arrdelay": None, "depdelay": 30.0}]
    r = gold.airline_monthly_kpi(make_flights(rows)).first()
    assert r["total_flights"] == 3 and r["operated_flights"] == 1
    assert r["cancellation_rate"] == 33.33 and r["completion_factor"] == 33.33
    assert r["avg_dep_delay_min"] == 15.0  # includes the diverted flight
    assert r["total_miles_flown"] == 4950.0  # non-cancelled incl. diverted
    assert r["p50_arr_delay_min"] == 0.0


def test_time_block_edges(make_flights):
    blocks = ["0500-0559", "0600-0659", "0900-0959", "1000-1059", "1400-1459", "1500-1559",
              "1900-1959", "2000-2059", "0001-0559", "xx00-xx59", "", None]
    rows = gold.time_block_performance(make_flights([{"deptimeblk": b} for b in blocks])).collect()
    got = {r["dep_time_block"]: (r["dep_hour"], r["time_period"]) for r in rows}
    assert "" not in got and None not in got
    assert got["0500-0559"] == (5, "Off-Peak (20-5)")
    assert got["0600-0659"] == (6, "Morning Peak (6-9)")
    assert got["0900-0959"] == (9, "Morning Peak (6-9)")
    assert got["1000-1059"] == (10, "Midday (10-14)")
    assert got["1400-1459"] == (14, "Midday (10-14)")
    assert got["1500-1559"] == (15, "Evening Peak (15-19)")
    assert got["1900-1959"] == (19, "Evening Peak (15-19)")
    assert got["2000-2059"] == (20, "Off-Peak (20-5)")
    assert got["0001-0559"] == (0, "Off-Peak (20-5)")
    assert got["xx00-xx59"] == (None, "Off-Peak (20-5)")


def test_cancellation_reasons_and_equivalence(make_flights):
    codes = ["A", "B", "C", "D", "E", None, "A"]
    rows = [{"cancelled": 1.0, "cancellationcode": c, "arrtime": None, "arrdelay": None} for c in codes]
    rows += [{}, {}, {}]
    df = make_flights(rows)
    w = gold.cancellation_analysis(df).collect()
    j = gold.cancellation_join_form(df).collect()
    assert canon(w) == canon(j)
    reasons = {r["cancellation_code"]: r["cancellation_reason"] for r in w}
    assert reasons == {"A": "Carrier", "B": "Weather", "C": "National Air System", "D": "Security",
                       "E": "Unknown", None: "Unknown"}
    a = [r for r in w if r["cancellation_code"] == "A"][0]
    assert a["cancelled_flights"] == 2 and a["airline_total_flights"] == 10
    assert a["airline_total_cancelled"] == 7 and a["reason_share_pct"] == 28.57


def test_route_summary_name_variation_and_equivalence(make_flights):
    # same route, two city-name spellings: carrier count spans both name groups
    rows = ([{"origincityname": "New York"}] * 3 + [{"origincityname": "NYC"}]
            + [{"reporting_airline": "BB"}] * 2 + [{"distance": None}])
    df = make_flights(rows)
    a = canon(gold.route_summary(df).collect())
    b = canon(gold.route_summary_window_form(df).collect())
    assert a == b
    rows_a = gold.route_summary(df).collect()
    nyc = [r for r in rows_a if r["origin_city"] == "NYC"][0]
    assert nyc["top_carrier_market_share"] == 500.0  # AA flew 5 on the route, 1 in this name group
    assert nyc["distance_group"] == "Long-haul (>1500 mi)"


def test_distance_group_null_average_is_long_haul(make_flights):
    r = gold.route_monthly_kpi(make_flights([{"distance": None}])).first()
    assert r["distance_group"] == "Long-haul (>1500 mi)"
    r = gold.route_monthly_kpi(make_flights([{"distance": 499.0}, {"distance": 501.0}])).first()
    assert r["distance_group"] == "Medium-haul (500-1500 mi)"


def test_airport_roles_and_day_names(make_flights):
    df = make_flights([{"dayofweek": 6}, {"dayofweek": 9}, {"dayofweek": None}])
    roles = gold.airport_roles(df)
    assert canon(roles.collect()) == canon(gold.airport_roles_union_form(df).collect())
    ops = gold.airport_daily_ops(df).collect()
    dep = {r["day_of_week_name"] for r in ops if r["direction"] == "Departure"}
    arr = {r["day_of_week_name"] for r in ops if r["direction"] == "Arrival"}
    assert dep == {"Saturday", "Unknown"} and arr == {"Saturday", None}
    assert {r["is_weekend"] for r in ops if r["day_of_week_name"] == "Saturday"} == {"Weekend"}
    d = [r for r in ops if r["airport"] == "JFK" and r["day_of_week_name"] == "Saturday"][0]
    assert d["num_connected_airports"] == 1 and d["num_carriers"] == 1


def test_delay_causes(make_flights):
    rows = [{"arrdelay": 30.0, "carrierdelay": 30.0, "weatherdelay": 0.0, "nasdelay": 0.0,
             "securitydelay": 0.0, "lateaircraftdelay": 0.0},
            {"arrdelay": 20.0, "carrierdelay": None, "weatherdelay": 20.0, "nasdelay": None,
             "securitydelay": None, "lateaircraftdelay": None},
            {"arrdelay": 10.0}]
    r = gold.delay_cause_analysis(make_flights(rows)).first()
    assert r["total_delayed_flights"] == 2
    assert r["avg_carrier_delay_min"] == 30.0 and r["avg_weather_delay_min"] == 10.0
    assert r["total_controllable_delay_min"] == 30.0 and r["total_uncontrollable_delay_min"] == 20.0
    assert r["controllable_delay_pct"] == 60.0
    assert r["flights_carrier_delay"] == 1 and r["flights_weather_delay"] == 1


def _kpi_rows(spark, rows):
    schema = "year int, month int, reporting_airline string, on_time_pct double, cancellation_rate double, " \
             "avg_arr_delay_min double, total_flights bigint"
    return spark.createDataFrame(rows, schema)


def test_trend_lag_is_row_offset_and_ranks(spark):
    # airline X has 14 months with a hole (month 3 of year 1 missing)
    months = [(2020, m) for m in range(1, 13) if m != 3] + [(2021, 1), (2021, 2), (2021, 3)]
    rows = [(y, m, "X", float(10 * i), 1.0, 5.0, 100 + i) for i, (y, m) in enumerate(months)]
    rows += [(2021, 3, "Y", 200.0, 1.0, 5.0, 113), (2021, 3, "Z", None, 0.5, 5.0, 50)]
    t = gold.monthly_trend(_kpi_rows(spark, rows)).collect()
    x = {(r["year"], r["month"]): r for r in t if r["reporting_airline"] == "X"}
    last = x[(2021, 3)]
    assert last["yoy_otp"] == 10.0  # 12 rows back (2020-02), not calendar month 2020-03
    assert last["prev_month_otp"] == 120.0 and last["mom_otp_change"] == 10.0
    assert last["otp_trend_direction"] == "Improving"
    assert x[(2020, 1)]["otp_trend_direction"] == "Stable" and x[(2020, 1)]["prev_month_otp"] is None
    ranks = {r["reporting_airline"]: r for r in t if (r["year"], r["month"]) == (2021, 3)}
    assert ranks["Y"]["otp_rank"] == 1 and ranks["X"]["otp_rank"] == 2 and ranks["Z"]["otp_rank"] == 3
    assert ranks["Z"]["cancellation_rank"] == 1 and ranks["X"]["cancellation_rank"] == 2
    assert ranks["Y"]["cancellation_rank"] == 2  # tie keeps a hole after it
    assert ranks["X"]["volume_rank"] == 1 and ranks["Y"]["volume_rank"] == 1 and ranks["Z"]["volume_rank"] == 3


def test_trend_direction_is_strict(spark):
    rows = [(2020, 1, "X", 50.0, 1.0, 1.0, 10), (2020, 2, "X", 51.0, 1.0, 1.0, 0), (2020, 3, "X", 49.5, 1.0, 1.0, 5)]
    t = {r["month"]: r for r in gold.monthly_trend(_kpi_rows(spark, rows)).collect()}
    assert t[2]["otp_trend_direction"] == "Stable"  # exactly +1 is not improving
    assert t[3]["otp_trend_direction"] == "Declining"
    assert t[3]["mom_volume_change_pct"] is None  # previous volume 0
    assert t[2]["mom_volume_change_pct"] == -100.0


def test_empty_input_gives_empty_tables(make_flights):
    empty = make_flights([{}]).where(F.lit(False))
    for fn in gold.PER_YEAR_TABLES.values():
        assert fn(empty).count() == 0


def test_pct_is_decimal_half_up(spark):
    from runway.functions.measures import pct
    r = spark.range(1).select(pct(F.lit(1), F.lit(8)).alias("a"), pct(F.lit(1), F.lit(0)).alias("b"),
                              pct(F.lit(-1), F.lit(32)).alias("c")).first()
    assert r["a"] == 12.5 and r["b"] is None and r["c"] == -3.13
    assert isinstance(r["a"], float)


def test_flightdate_passthrough(make_flights):
    ops = gold.airport_daily_ops(make_flights([{}])).first()
    assert ops["flight_date"] == dt.date(2024, 5, 10)
