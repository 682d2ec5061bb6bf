"""The eight Gold tables as DataFrame functions over the Silver (clean) set.

Each table is ``filter → groupBy(keys).agg(measures) → select`` with
built-in expressions only, so one hash aggregate with map-side partial
aggregation does the work (percentile sketches and distinct sets merge
partially too). Two shapes are rewritten for scale, each with the direct
form kept as a tested equivalent:

* ``cancellation_analysis`` groups all rows once by (keys, code) and takes
  both totals by a window over the *aggregated* rows, instead of joining
  two aggregates of two scans (``cancellation_join_form``).
* ``route_summary`` computes the per-carrier route count on rows
  pre-aggregated by carrier, then joins the per-name-group maximum back on
  a struct key (NULL names match; both sides already partitioned by it),
  instead of a window over raw rows where one hot route would land in one
  task (``route_summary_window_form``).
* ``airport_daily_ops`` emits the departure and arrival role of a flight
  with ``inline(array(struct, struct))``: one scan instead of a union of two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runway.functions import measures as M
from runway.functions import scalars as S

KPI_KEYS = ["year", "month", "reporting_airline"]
ROUTE_NAME_KEYS = ["year", "month", "origin", "origincityname", "originstatename",
                   "dest", "destcityname", "deststatename"]


def _int(c: str) -> Column:
    return F.col(c).cast("int").alias(c)


def _cnt() -> Column:
    return F.count(F.lit(1))


# ------------------------------------------------------------ GT-1 pieces

def kpi_counts() -> dict[str, Column]:
    op = M.operated()
    return {
        "total_flights": _cnt(),
        "operated_flights": M.count_when(op),
        "cancelled_flights": M.count_when(M.is_cancelled()),
        "diverted_flights": M.count_when(M.is_diverted()),
        "on_time_flights": M.count_when(M.on_time()),
    }


def haul_counts() -> dict[str, Column]:
    op = M.operated()
    ot = M.on_time()
    return {
        "operated_short_haul": M.count_when(M.short_haul() & op),
        "operated_medium_haul": M.count_when(M.medium_haul() & op),
        "operated_long_haul": M.count_when(M.long_haul() & op),
        "_ot_short": M.count_when(M.short_haul() & ot),
        "_ot_medium": M.count_when(M.medium_haul() & ot),
        "_ot_long": M.count_when(M.long_haul() & ot),
    }


def _aliased(d: dict[str, Column]) -> list[Column]:
    return [c.alias(k) for k, c in d.items()]


def airline_monthly_kpi(silver: DataFrame) -> DataFrame:
    """GT-1: one row per (year, month, airline), 31 columns."""
    nc = M.not_cancelled()
    op = M.operated()
    aggs = {
        **kpi_counts(),
        "_avg_dep": M.avg_when("depdelay", nc),
        "_avg_arr": M.avg_when("arrdelay", nc),
        "_p50": M.pctl_when("arrdelay", 0.50, op),
        "_p90": M.pctl_when("arrdelay", 0.90, op),
        **M.delay_bands(),
        "_taxi_out": M.avg_when("taxiout", nc),
        "_taxi_in": M.avg_when("taxiin", nc),
        "_airtime": M.avg_when("airtime", nc),
        "_distance": M.avg_when("distance", nc),
        "_miles": F.sum(F.when(nc, F.col("distance")).otherwise(F.lit(0.0))),
        **haul_counts(),
    }
    g = silver.groupBy(*KPI_KEYS).agg(*_aliased(aggs))
    c = F.col
    return g.select(
        _int("year"), _int("month"), "reporting_airline",
        "total_flights", "operated_flights", "cancelled_flights", "diverted_flights", "on_time_flights",
        M.pct(c("on_time_flights"), c("operated_flights")).alias("on_time_pct"),
        M.pct(c("cancelled_flights"), c("total_flights")).alias("cancellation_rate"),
        M.pct(c("operated_flights"), c("total_flights")).alias("completion_factor"),
        M.r2(c("_avg_dep")).alias("avg_dep_delay_min"),
        M.r2(c("_avg_arr")).alias("avg_arr_delay_min"),
        M.r2(c("_p50")).alias("p50_arr_delay_min"),
        M.r2(c("_p90")).alias("p90_arr_delay_min"),
        *M.delay_bands().keys(),
        M.r2(c("_taxi_out")).alias("avg_taxi_out_min"),
        M.r2(c("_taxi_in")).alias("avg_taxi_in_min"),
        M.r2(c("_airtime")).alias("avg_airtime_min"),
        M.r2(c("_distance")).alias("avg_distance_miles"),
        M.r2(c("_miles"), 0).alias("total_miles_flown"),
        "operated_short_haul", "operated_medium_haul", "operated_long_haul",
        M.pct(c("_ot_short"), c("operated_short_haul")).alias("otp_short_haul"),
        M.pct(c("_ot_medium"), c("operated_medium_haul")).alias("otp_medium_haul"),
        M.pct(c("_ot_long"), c("operated_long_haul")).alias("otp_long_haul"),
    )


def conditional_counts(silver: DataFrame) -> DataFrame:
    """AG-03: operated / cancelled / diverted / on-time counts per airline-month."""
    return silver.groupBy(*KPI_KEYS).agg(*_aliased(kpi_counts())).select(
        _int("year"), _int("month"), "reporting_airline", *kpi_counts().keys())


def delay_bands(silver: DataFrame) -> DataFrame:
    """AG-10: arrival-delay histogram (5 bands) per airline-month."""
    bands = M.delay_bands()
    return silver.groupBy(*KPI_KEYS).agg(*_aliased(bands)).select(
        _int("year"), _int("month"), "reporting_airline", *bands.keys())


def distance_bands(silver: DataFrame) -> DataFrame:
    """AG-10: operated flights and on-time percent per distance band."""
    c = F.col
    return silver.groupBy(*KPI_KEYS).agg(*_aliased(haul_counts())).select(
        _int("year"), _int("month"), "reporting_airline",
        "operated_short_haul", "operated_medium_haul", "operated_long_haul",
        M.pct(c("_ot_short"), c("operated_short_haul")).alias("otp_short_haul"),
        M.pct(c("_ot_medium"), c("operated_medium_haul")).alias("otp_medium_haul"),
        M.pct(c("_ot_long"), c("operated_long_haul")).alias("otp_long_haul"),
    )


def delay_percentiles(silver: DataFrame) -> DataFrame:
    """AG-06: p50 / p90 arrival delay of operated flights per airline-month."""
    op = M.operated()
    return silver.groupBy(*KPI_KEYS).agg(
        M.pctl_when("arrdelay", 0.50, op).alias("_p50"),
        M.pctl_when("arrdelay", 0.90, op).alias("_p90"),
    ).select(_int("year"), _int("month"), "reporting_airline",
             M.r2(F.col("_p50")).alias("p50_arr_delay_min"),
             M.r2(F.col("_p90")).alias("p90_arr_delay_min"))


# ---------------------------------------------------------- GT-2 / GT-3

def _route_key() -> Column:
    """The route name group as one struct key: NULL names group (and join) as equal,
    and both aggregates hash-partition on the same single key, so their join
    reuses that partitioning instead of re-shuffling on eight null-safe keys."""
    return F.struct(*ROUTE_NAME_KEYS).alias("rk")


def _route_measures(with_cancelled: bool) -> dict[str, Column]:
    nc = M.not_cancelled()
    op = M.operated()
    d = {
        "_avg_distance_all": F.avg("distance"),
        "total_flights": _cnt(),
        "operated_flights": M.count_when(op),
        "cancelled_flights": M.count_when(M.is_cancelled()),
        "_on_time": M.count_when(M.on_time()),
        "_avg_dep": M.avg_when("depdelay", nc),
        "_avg_arr": M.avg_when("arrdelay", nc),
        "_p90": M.pctl_when("arrdelay", 0.90, op),
        "_airtime": M.avg_when("airtime", nc),
        "_distance": M.avg_when("distance", nc),
    }
    return d


def _route_head() -> list[Column]:
    return [
        _int("year"), _int("month"), "origin",
        M.city("origincityname", "origin").alias("origin_city"),
        M.state("originstatename").alias("origin_state"),
        "dest",
        M.city("destcityname", "dest").alias("dest_city"),
        M.state("deststatename").alias("dest_state"),
        F.concat(F.col("origin"), F.lit("-"), F.col("dest")).alias("route"),
    ]


def _route_tail(with_cancelled: bool) -> list[Column]:
    c = F.col
    out = ["total_flights", "operated_flights"]
    if with_cancelled:
        out.append("cancelled_flights")
    return out + [
        M.pct(c("_on_time"), c("operated_flights")).alias("on_time_pct"),
        M.pct(c("cancelled_flights"), c("total_flights")).alias("cancellation_rate"),
        M.r2(c("_avg_dep")).alias("avg_dep_delay_min"),
        M.r2(c("_avg_arr")).alias("avg_arr_delay_min"),
        M.r2(c("_p90")).alias("p90_arr_delay_min"),
        M.r2(c("_airtime")).alias("avg_airtime_min"),
        M.r2(c("_distance")).alias("avg_distance_miles"),
    ]


def route_monthly_kpi(silver: DataFrame) -> DataFrame:
    """GT-2: per (month, route with raw names, airline); names coalesced after grouping."""
    g = silver.groupBy(_route_key(), "reporting_airline").agg(*_aliased(_route_measures(False)))
    g = g.select("rk.*", *[c for c in g.columns if c != "rk"])
    return g.select(*_route_head(), "reporting_airline",
                    M.distance_group(F.col("_avg_distance_all")).alias("distance_group"),
                    *_route_tail(False))


def carrier_route_counts(silver: DataFrame) -> DataFrame:
    """Rows per (route name group, carrier) with ``carrier_flights``: the carrier's
    count over the route regardless of names (WN-01 on pre-aggregated rows)."""
    per = silver.groupBy(*ROUTE_NAME_KEYS, "reporting_airline").agg(_cnt().alias("n"))
    w = Window.partitionBy("year", "month", "origin", "dest", "reporting_airline")
    return per.withColumn("carrier_flights", F.sum("n").over(w))


def top_carrier_counts(silver: DataFrame) -> DataFrame:
    """Per route name group (``rk``): the largest ``carrier_flights`` among its carriers.

    Carriers are counted per name group first (partial aggregation), the
    route-wide carrier count is a window over those few rows, and the max is
    taken per group — no window ever sees raw rows.
    """
    per = silver.groupBy(_route_key(), "reporting_airline").agg(_cnt().alias("n"))
    w = Window.partitionBy(F.col("rk.year"), F.col("rk.month"), F.col("rk.origin"), F.col("rk.dest"),
                           "reporting_airline")
    return (per.withColumn("carrier_flights", F.sum("n").over(w))
            .groupBy("rk").agg(F.max("carrier_flights").alias("top_carrier_flights"),
                               F.count("reporting_airline").alias("num_carriers"), F.sum("n").alias("total_flights")))


def route_summary(silver: DataFrame) -> DataFrame:
    """GT-3: per (month, route with raw names), all carriers together."""
    carriers = top_carrier_counts(silver).drop("total_flights")  # a row a carrier before, so its count is distinct
    g = silver.groupBy(_route_key()).agg(*_aliased(_route_measures(True))).join(carriers, "rk")
    g = g.select("rk.*", *[c for c in g.columns if c != "rk"])
    return g.select(*_route_head(),
                    M.distance_group(F.col("_avg_distance_all")).alias("distance_group"),
                    *_route_tail(True),
                    "num_carriers",
                    M.pct(F.col("top_carrier_flights"), F.col("total_flights")).alias("top_carrier_market_share"))


def route_summary_window_form(silver: DataFrame) -> DataFrame:
    """GT-3 with the window over raw rows (the direct form, for equivalence tests)."""
    w = Window.partitionBy("year", "month", "origin", "dest", "reporting_airline")
    rows = silver.withColumn("carrier_flights", F.count(F.lit(1)).over(w))
    aggs = _route_measures(True)
    aggs["num_carriers"] = F.count_distinct("reporting_airline")
    aggs["top_carrier_flights"] = F.max("carrier_flights")
    g = rows.groupBy(*ROUTE_NAME_KEYS).agg(*_aliased(aggs))
    return g.select(*_route_head(),
                    M.distance_group(F.col("_avg_distance_all")).alias("distance_group"),
                    *_route_tail(True),
                    "num_carriers",
                    M.pct(F.col("top_carrier_flights"), F.col("total_flights")).alias("top_carrier_market_share"))


def top_carrier_share(silver: DataFrame) -> DataFrame:
    """AG-09: per route name group, top carrier's route count and its share."""
    j = top_carrier_counts(silver).select("rk.*", "total_flights", "top_carrier_flights")
    return j.select(_int("year"), _int("month"), "origin", "origincityname", "originstatename",
                    "dest", "destcityname", "deststatename", "total_flights", "top_carrier_flights",
                    M.pct(F.col("top_carrier_flights"), F.col("total_flights")).alias("top_carrier_market_share"))


def carrier_flights_window(silver: DataFrame) -> DataFrame:
    """WN-01: per (route name group, carrier) the carrier's flights on the route."""
    return carrier_route_counts(silver).select(
        _int("year"), _int("month"), "origin", "origincityname", "originstatename",
        "dest", "destcityname", "deststatename", "reporting_airline",
        F.col("n").alias("group_flights"), F.col("carrier_flights").cast("bigint").alias("carrier_flights"))


# ---------------------------------------------------------------- GT-4

def airport_roles(silver: DataFrame) -> DataFrame:
    """PRJ-04: each flight as a Departure row and an Arrival row (one scan)."""
    dow = F.col("dayofweek").try_cast("int")
    common = {
        "year": F.col("year").cast("int"),
        "month": F.col("month").cast("int"),
        "dayofmonth": F.col("dayofmonth").cast("int"),
        "flight_date": F.col("flightdate"),
        "is_weekend": S.weekend_flag(dow),
        "cancelled": F.col("cancelled"),
        "diverted": F.col("diverted"),
        "reporting_airline": F.col("reporting_airline"),
    }

    def role(direction, airport, city, st, peer, delay, taxi, day_default):
        return F.struct(
            *[v.alias(k) for k, v in common.items()],
            S.day_of_week_name(dow, day_default).alias("day_of_week_name"),
            F.col(airport).alias("airport"),
            M.city(city, airport).alias("airport_city"),
            M.state(st).alias("airport_state"),
            F.col(peer).alias("peer_airport"),
            F.lit(direction).alias("direction"),
            F.col(delay).alias("delay"),
            F.col(taxi).alias("taxi"),
        )

    dep = role("Departure", "origin", "origincityname", "originstatename", "dest", "depdelay", "taxiout", "Unknown")
    arr = role("Arrival", "dest", "destcityname", "deststatename", "origin", "arrdelay", "taxiin", None)
    return silver.select(F.inline(F.array(dep, arr)))


def airport_roles_union_form(silver: DataFrame) -> DataFrame:
    """PRJ-04 as ``UNION ALL`` of two projections (for equivalence tests)."""
    full = airport_roles(silver)
    dep = full.where(F.col("direction") == "Departure")
    arr = full.where(F.col("direction") == "Arrival")
    return dep.unionAll(arr)


AIRPORT_KEYS = ["year", "month", "dayofmonth", "flight_date", "day_of_week_name", "is_weekend",
                "airport", "airport_city", "airport_state", "direction"]


def _airport_key() -> Column:
    """The ten airport-day-direction keys as one struct key (same groups, NULLs equal)."""
    return F.struct(*AIRPORT_KEYS).alias("ak")


def airport_daily_ops(silver: DataFrame) -> DataFrame:
    """GT-4: per airport, day and direction."""
    nc = M.not_cancelled()
    op = M.operated()
    c = F.col
    def known(column):
        return F.when(nc, F.col(column))

    # sums and counts by (key, airline, peer) re-aggregate, so the two distinct
    # counts are taken over these few rows and raw rows are read once
    pairs = airport_roles(silver).groupBy(_airport_key(), "reporting_airline", "peer_airport").agg(
        _cnt().alias("_n"),
        M.count_when(op).alias("_op"),
        M.count_when(M.is_cancelled()).alias("_canc"),
        M.count_when(M.on_time("delay")).alias("_ot"),
        F.sum(known("delay")).alias("_delay"), F.count(known("delay")).alias("_n_delay"),
        F.sum(known("taxi")).alias("_taxi"), F.count(known("taxi")).alias("_n_taxi"),
    )
    g = pairs.groupBy("ak").agg(
        F.sum("_n").alias("total_flights"),
        F.sum("_op").alias("operated_flights"),
        F.sum("_canc").alias("cancelled_flights"),
        F.sum("_ot").alias("_on_time"),
        (F.sum("_delay") / F.sum("_n_delay")).alias("_avg_delay"),
        (F.sum("_taxi") / F.sum("_n_taxi")).alias("_avg_taxi"),
        F.size(F.collect_set("reporting_airline")).cast("bigint").alias("num_carriers"),
        F.size(F.collect_set("peer_airport")).cast("bigint").alias("num_connected_airports"),
    )
    return g.select(*[c(f"ak.{k}").alias(k) for k in AIRPORT_KEYS],
                    "total_flights", "operated_flights", "cancelled_flights",
                    M.pct(c("_on_time"), c("operated_flights")).alias("on_time_pct"),
                    M.r2(c("_avg_delay")).alias("avg_delay_min"),
                    M.r2(c("_avg_taxi")).alias("avg_taxi_min"),
                    "num_carriers", "num_connected_airports")


def airport_connectivity(silver: DataFrame) -> DataFrame:
    """AG-07: distinct carriers and distinct connected airports per airport-day-direction."""
    # airlines and airports of one airport are bounded sets; raw rows collapse to pairs first
    pairs = airport_roles(silver).select(_airport_key(), "reporting_airline", "peer_airport").distinct()
    g = pairs.groupBy("ak").agg(F.size(F.collect_set("reporting_airline")).cast("bigint").alias("num_carriers"),
                                F.size(F.collect_set("peer_airport")).cast("bigint").alias("num_connected_airports"))
    return g.select(*[F.col(f"ak.{k}").alias(k) for k in AIRPORT_KEYS], "num_carriers", "num_connected_airports")


# ---------------------------------------------------------------- GT-5

# Delay-cause columns and their output stems, controllable first.
CAUSES = (("carrierdelay", "carrier"), ("weatherdelay", "weather"), ("nasdelay", "nas"),
          ("securitydelay", "security"), ("lateaircraftdelay", "late_aircraft"))
CONTROLLABLE = ("carrier", "late_aircraft")
UNCONTROLLABLE = ("weather", "nas", "security")


def delayed_operated() -> Column:
    return (F.col("arrdelay") > M.ON_TIME_MAX_DELAY) & M.operated()


def delay_cause_analysis(silver: DataFrame) -> DataFrame:
    """GT-5: delay minutes by cause for delayed operated flights per airline-month."""
    aggs = [_cnt().alias("total_delayed_flights")]
    for col, stem in CAUSES:
        aggs += [F.avg(col).alias(f"_avg_{stem}"),
                 F.sum(F.coalesce(F.col(col), F.lit(0.0))).alias(f"_sum_{stem}"),
                 M.count_when(F.col(col) > 0).alias(f"flights_{stem}_delay")]
    g = silver.where(delayed_operated()).groupBy(*KPI_KEYS).agg(*aggs)
    s = {stem: F.col(f"_sum_{stem}") for _, stem in CAUSES}
    ctrl = s["carrier"] + s["late_aircraft"]
    unctrl = s["weather"] + s["nas"] + s["security"]
    allsum = s["carrier"] + s["weather"] + s["nas"] + s["security"] + s["late_aircraft"]
    return g.select(
        _int("year"), _int("month"), "reporting_airline", "total_delayed_flights",
        *[M.r2(F.col(f"_avg_{stem}")).alias(f"avg_{stem}_delay_min") for _, stem in CAUSES],
        *[M.r2(s[stem], 0).alias(f"total_{stem}_delay_min") for _, stem in CAUSES],
        *[f"flights_{stem}_delay" for _, stem in CAUSES],
        M.r2(ctrl, 0).alias("total_controllable_delay_min"),
        M.r2(unctrl, 0).alias("total_uncontrollable_delay_min"),
        M.pct_double(ctrl, allsum).alias("controllable_delay_pct"),
    )


# ---------------------------------------------------------------- GT-6

def time_block_performance(silver: DataFrame) -> DataFrame:
    """GT-6: per airline-month and departure time block (blank blocks excluded)."""
    nc = M.not_cancelled()
    c = F.col
    g = silver.where(S.nonblank("deptimeblk")).groupBy(*KPI_KEYS, "deptimeblk").agg(
        _cnt().alias("total_flights"),
        M.count_when(M.operated()).alias("operated_flights"),
        M.count_when(M.on_time()).alias("_on_time"),
        M.avg_when("depdelay", nc).alias("_avg_dep"),
        M.avg_when("arrdelay", nc).alias("_avg_arr"),
        M.avg_when("taxiout", nc).alias("_taxi_out"),
        M.count_when(M.is_cancelled()).alias("_cancelled"),
    )
    hour = S.block_hour("deptimeblk")
    return g.select(
        _int("year"), _int("month"), "reporting_airline",
        c("deptimeblk").alias("dep_time_block"),
        hour.alias("dep_hour"),
        S.time_period(hour).alias("time_period"),
        "total_flights", "operated_flights",
        M.pct(c("_on_time"), c("operated_flights")).alias("on_time_pct"),
        M.r2(c("_avg_dep")).alias("avg_dep_delay_min"),
        M.r2(c("_avg_arr")).alias("avg_arr_delay_min"),
        M.r2(c("_taxi_out")).alias("avg_taxi_out_min"),
        M.pct(c("_cancelled"), c("total_flights")).alias("cancellation_rate"),
    )


def scalar_time_block(silver: DataFrame) -> DataFrame:
    """SC-01/02/08: distinct blocks with their hour and period (blank excluded)."""
    hour = S.block_hour("deptimeblk")
    return (silver.where(S.nonblank("deptimeblk")).select("deptimeblk").distinct()
            .select(F.col("deptimeblk").alias("dep_time_block"), hour.alias("dep_hour"),
                    S.time_period(hour).alias("time_period")))


def scalar_day_names(silver: DataFrame) -> DataFrame:
    """SC-03: flights per ISO weekday with its name and weekend flag."""
    dow = F.col("dayofweek")
    return silver.groupBy(dow.alias("dayofweek")).agg(_cnt().alias("flights")).select(
        "dayofweek", S.day_of_week_name(F.col("dayofweek")).alias("day_of_week_name"),
        S.weekend_flag(F.col("dayofweek")).alias("is_weekend"), "flights")


# ---------------------------------------------------------------- GT-7

def _cancellation_out(df: DataFrame) -> DataFrame:
    c = F.col
    return df.select(
        _int("year"), _int("month"), "reporting_airline",
        S.cancellation_reason(c("cancellationcode")).alias("cancellation_reason"),
        c("cancellationcode").alias("cancellation_code"),
        c("cancelled_flights").cast("bigint").alias("cancelled_flights"),
        M.pct(c("cancelled_flights"), c("airline_total_flights")).alias("cancellation_rate_pct"),
        M.pct(c("cancelled_flights"), c("airline_total_cancelled")).alias("reason_share_pct"),
        c("airline_total_flights").cast("bigint").alias("airline_total_flights"),
        c("airline_total_cancelled").cast("bigint").alias("airline_total_cancelled"),
    )


def cancellation_analysis(silver: DataFrame) -> DataFrame:
    """GT-7: cancelled flights per code with shares, one aggregate + window.

    Rows are grouped once by (year, month, airline, code) with the group
    size and its cancelled count; the airline-month totals are window sums
    over those few aggregated rows. Keys must be non-NULL (as an inner join
    on them would require).
    """
    keys_ok = F.col("year").isNotNull() & F.col("month").isNotNull() & F.col("reporting_airline").isNotNull()
    g = silver.where(keys_ok).groupBy(*KPI_KEYS, "cancellationcode").agg(
        _cnt().alias("n"), M.count_when(M.is_cancelled()).alias("cancelled_flights"))
    w = Window.partitionBy(*KPI_KEYS)
    g = (g.withColumn("airline_total_flights", F.sum("n").over(w))
          .withColumn("airline_total_cancelled", F.sum("cancelled_flights").over(w))
          .where(F.col("cancelled_flights") > 0))
    return _cancellation_out(g)


def cancellation_join_form(silver: DataFrame) -> DataFrame:
    """GT-7 as the join of two aggregates (the direct form)."""
    canc = (silver.where(M.is_cancelled()).groupBy(*KPI_KEYS, "cancellationcode")
            .agg(_cnt().alias("cancelled_flights")))
    totals = silver.groupBy(*KPI_KEYS).agg(
        _cnt().alias("airline_total_flights"),
        M.count_when(M.is_cancelled()).alias("airline_total_cancelled"))
    return _cancellation_out(canc.join(totals, KPI_KEYS, "inner"))


# ---------------------------------------------------------------- GT-8

TREND_ORDER = ["year", "month"]


def _airline_window():
    return Window.partitionBy("reporting_airline").orderBy(*TREND_ORDER)


def trend_columns(kpi: DataFrame) -> dict[str, Column]:
    """WN-02…WN-07 over GT-1 rows: lags are row offsets, not calendar offsets."""
    w = _airline_window()
    month_w = Window.partitionBy("year", "month")
    otp, canc = F.col("on_time_pct"), F.col("cancellation_rate")
    arr, vol = F.col("avg_arr_delay_min"), F.col("total_flights")
    prev_otp = F.lag(otp, 1).over(w)
    prev_vol = F.lag(vol, 1).over(w)
    otp_delta = otp - prev_otp
    return {
        "prev_month_otp": prev_otp,
        "mom_otp_change": M.r2(otp_delta),
        "mom_cancel_rate_change": M.r2(canc - F.lag(canc, 1).over(w)),
        "mom_arr_delay_change": M.r2(arr - F.lag(arr, 1).over(w)),
        "mom_volume_change_pct": M.pct(vol - prev_vol, prev_vol),
        "yoy_otp": F.lag(otp, 12).over(w),
        "yoy_otp_change": M.r2(otp - F.lag(otp, 12).over(w)),
        "otp_rank": F.rank().over(month_w.orderBy(otp.desc_nulls_last())),
        "cancellation_rank": F.rank().over(month_w.orderBy(canc.asc_nulls_first())),
        "volume_rank": F.rank().over(month_w.orderBy(vol.desc_nulls_last())),
        "otp_trend_direction": (F.when(otp_delta > 1, "Improving")
                                .when(otp_delta < -1, "Declining").otherwise("Stable")),
    }


def monthly_trend(kpi: DataFrame) -> DataFrame:
    """GT-8: GT-1 rows of all years plus month-over-month, year-over-year and ranks.

    Two window partitionings (airline; year-month) over the small GT-1
    table; Catalyst shares each window spec across its columns.
    """
    return kpi.select("*", *[c.alias(k) for k, c in trend_columns(kpi).items()])


def _trend_subset(kpi: DataFrame, names) -> DataFrame:
    cols = trend_columns(kpi)
    return kpi.select("year", "month", "reporting_airline", *[cols[n].alias(n) for n in names])


def trend_mom(kpi):
    return _trend_subset(kpi, ["prev_month_otp", "mom_otp_change", "mom_cancel_rate_change",
                               "mom_arr_delay_change"])


def trend_yoy(kpi):
    return _trend_subset(kpi, ["yoy_otp", "yoy_otp_change"])


def trend_volume_change(kpi):
    return _trend_subset(kpi, ["mom_volume_change_pct"])


def trend_ranks(kpi):
    return _trend_subset(kpi, ["otp_rank", "cancellation_rank", "volume_rank"])


def trend_direction(kpi):
    return _trend_subset(kpi, ["otp_trend_direction"])


# ------------------------------------------------------------- registry

PER_YEAR_TABLES = {
    "airline_monthly_kpi": airline_monthly_kpi,
    "route_monthly_kpi": route_monthly_kpi,
    "route_summary": route_summary,
    "airport_daily_ops": airport_daily_ops,
    "delay_cause_analysis": delay_cause_analysis,
    "time_block_performance": time_block_performance,
    "cancellation_analysis": cancellation_analysis,
}
CROSS_YEAR_TABLES = {"monthly_trend": monthly_trend}
