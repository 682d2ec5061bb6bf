"""Measures as mergeable states: what is kept of a month is enough for every
coarser grain, so a late month costs one month and a year is merged, not rescanned.

* **KPI states** (GT-1): sums and counts a (year, month, airline), and beside them
  the histogram of arrival delays, from which percentiles of any grain are exact.
* **Distinct counts** (AG-07): airlines and airports get dense numbers; a day's
  sets are bitmaps, which are or-ed to months and years.
* **Trend tail** (GT-8): the last twelve rows of each airline carry the
  month-over-month and year-over-year columns into the next year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runway.functions import measures as M
from runway.operators import gold

STATE_KEYS = ("year", "month", "reporting_airline")
# averaged columns of GT-1 by output name, over flights that were not cancelled
AVERAGES = {"avg_dep_delay_min": "depdelay", "avg_arr_delay_min": "arrdelay", "avg_taxi_out_min": "taxiout",
            "avg_taxi_in_min": "taxiin", "avg_airtime_min": "airtime", "avg_distance_miles": "distance"}
PERCENTILES = {"p50_arr_delay_min": 0.5, "p90_arr_delay_min": 0.9}


def _additive() -> dict[str, Column]:
    flown = M.not_cancelled()
    out = {**gold.kpi_counts(), **M.delay_bands(), **gold.haul_counts(),
           "miles": F.sum(F.when(flown, F.col("distance")).otherwise(F.lit(0.0)))}
    for x in AVERAGES.values():
        out[f"sum_{x}"] = F.sum(F.when(flown, F.col(x)))
        out[f"n_{x}"] = F.count(F.when(flown, F.col(x)))
    return out


def kpi_states(silver: DataFrame) -> DataFrame:
    """Additive states a (year, month, airline): one partial aggregate of the scan."""
    return silver.groupBy(*[F.col(k).cast("int").alias(k) if k != "reporting_airline" else F.col(k) for k in STATE_KEYS]).agg(
        *[c.alias(k) for k, c in _additive().items()])


def delay_histogram(silver: DataFrame) -> DataFrame:
    """(year, month, airline, delay, n): arrival delays of operated flights. As many
    rows as there are different delays, however many flights."""
    rows = silver.where(M.operated() & F.col("arrdelay").isNotNull())
    return rows.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), "reporting_airline",
                        F.col("arrdelay").alias("delay")).agg(F.count(F.lit(1)).alias("n"))


def merge_kpi_states(states: DataFrame, keys) -> DataFrame:
    """States of a coarser grain."""
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _additive()])


def exact_percentiles(histogram: DataFrame, keys) -> DataFrame:
    """The element at place ceil(p n) of the merged histogram, for each of ``PERCENTILES``."""
    merged = histogram.groupBy(*keys, "delay").agg(F.sum("n").alias("n"))
    upto = W.partitionBy(*keys).orderBy("delay").rowsBetween(W.unboundedPreceding, 0)  # rows: different delays of a key
    ranked = merged.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(W.partitionBy(*keys)))
    return ranked.groupBy(*keys).agg(*[
        M.r2(F.min(F.when(F.col("_upto") >= F.ceil(F.lit(p) * F.col("_all")), F.col("delay")))).alias(name) for name, p in PERCENTILES.items()])


def kpi_from_states(states: DataFrame, histogram: DataFrame, keys=STATE_KEYS) -> DataFrame:
    """GT-1's measures for any grain whose keys the states hold."""
    c = F.col
    merged = merge_kpi_states(states, keys)
    both = [merged[k].eqNullSafe(c(f"h.{k}")) for k in keys]
    joined = merged.join(exact_percentiles(histogram, keys).alias("h"), both, "left")
    return joined.select(
        *[merged[k] for k in keys], *gold.kpi_counts(),
        M.pct(c("on_time_flights"), c("operated_flights")).alias("on_time_pct"),
        M.pct(c("cancelled_flights"), c("total_flights")).alias("cancellation_rate"),
        M.pct(c("operated_flights"), c("total_flights")).alias("completion_factor"),
        *[M.r2(c(f"sum_{x}") / F.nullif(c(f"n_{x}"), F.lit(0))).alias(name) for name, x in AVERAGES.items()],
        *[c(f"h.{p}") for p in PERCENTILES], *M.delay_bands(),
        M.r2(c("miles"), 0).alias("total_miles_flown"),
        "operated_short_haul", "operated_medium_haul", "operated_long_haul",
        *[M.pct(c(f"_ot_{h}"), c(f"operated_{h}_haul")).alias(f"otp_{h}_haul") for h in ("short", "medium", "long")])


# ------------------------------------------------------------ distinct counts

def numbered(codes: DataFrame, code: str) -> DataFrame:
    """(code, id): dense numbers from 0 of a dimension's codes (airlines, airports: a
    set that does not grow with the flights)."""
    return codes.where(F.col(code).isNotNull()).select(F.col(code).alias("code")).distinct().select(
        "code", (F.row_number().over(W.orderBy("code")) - 1).cast("long").alias("id"))


ROLLUP_KEYS = ("airport", "direction", "year", "month", "dayofmonth")


def connectivity_bitmaps(silver: DataFrame, airlines: DataFrame, airports: DataFrame) -> DataFrame:
    """(keys, what, bucket, bits) a day: which airlines and which other airports an airport
    has met. ``what`` is ``carrier`` or ``peer``; both come from one scan."""
    roles = gold.airport_roles(silver).select(
        *ROLLUP_KEYS, F.inline(F.array(F.struct(F.lit("carrier").alias("what"), F.col("reporting_airline").alias("code")),
                                       F.struct(F.lit("peer").alias("what"), F.col("peer_airport").alias("code")))))
    ids = airlines.select(F.lit("carrier").alias("what"), "code", "id").unionAll(airports.select(F.lit("peer").alias("what"), "code", "id"))
    met = roles.distinct().join(ids, ["what", "code"], "left")  # a null code counts for no one, but keeps its keys
    return met.groupBy(*ROLLUP_KEYS, "what", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def connectivity_counts(bitmaps: DataFrame, keys) -> DataFrame:
    """Exact distinct counts for any grain, or-ed from the days' bitmaps."""
    merged = bitmaps.groupBy(*keys, "what", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    n = F.bitmap_count("bits")
    return merged.groupBy(*keys).agg(
        F.sum(F.when(F.col("what") == "carrier", n).otherwise(0)).cast("bigint").alias("num_carriers"),
        F.sum(F.when(F.col("what") == "peer", n).otherwise(0)).cast("bigint").alias("num_connected_airports"))


def connectivity_rollup(bitmaps: DataFrame) -> DataFrame:
    """Day, month and year counts of every airport and direction."""
    out = None
    for grain, width in (("day", 5), ("month", 4), ("year", 3)):
        keys = ROLLUP_KEYS[:width]
        part = connectivity_counts(bitmaps, keys).select(
            F.lit(grain).alias("grain"), *keys, *[F.lit(None).cast("int").alias(k) for k in ROLLUP_KEYS[width:]],
            "num_carriers", "num_connected_airports")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------ trend

TAIL = 12  # rows an airline's trend looks back


def trend_tail(kpi: DataFrame, tail: DataFrame | None = None) -> DataFrame:
    """The last rows of each airline after ``kpi``, which follows ``tail``."""
    rows = kpi if tail is None else tail.unionByName(kpi)
    last = W.partitionBy("reporting_airline").orderBy(F.desc("year"), F.desc("month"))
    return rows.withColumn("_nth", F.row_number().over(last)).where(F.col("_nth") <= TAIL).drop("_nth")


def continued_trend(kpi: DataFrame, tail: DataFrame) -> DataFrame:
    """GT-8 for the rows of ``kpi`` (the months after ``tail``'s), from these two alone."""
    rows = tail.select(*kpi.columns, F.lit(False).alias("_new")).unionByName(kpi.withColumn("_new", F.lit(True)))
    trend = rows.select("*", *[c.alias(k) for k, c in gold.trend_columns(rows).items()])
    return trend.where("_new").drop("_new")
