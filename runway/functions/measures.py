"""Reusable ``Column`` builders for flight measures.

Everything here is a built-in expression (JVM-side, codegen'd); nothing
runs Python per row. Predicates keep SQL three-valued logic: a NULL
operand makes a predicate NULL, and ``count_if``/``when`` treat NULL as
false, which is what the conditional counts of the Gold tables need.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# On-time threshold (minutes, inclusive), distance band edges
# (miles) and the arrival-delay histogram edges (minutes).
ON_TIME_MAX_DELAY = 15
SHORT_HAUL_MAX = 500
MEDIUM_HAUL_MAX = 1500
DELAY_BAND_EDGES = (0, 15, 60, 120)

HUNDRED = Decimal("100.0")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def operated() -> Column:
    """Flight neither cancelled nor diverted."""
    return (F.col("cancelled") == 0) & (F.col("diverted") == 0)


def not_cancelled() -> Column:
    return F.col("cancelled") == 0


def is_cancelled() -> Column:
    return F.col("cancelled") == 1


def is_diverted() -> Column:
    return F.col("diverted") == 1


def on_time(delay="arrdelay") -> Column:
    """Operated and arrived within the on-time threshold (inclusive)."""
    return (col(delay) <= ON_TIME_MAX_DELAY) & operated()


def count_when(pred: Column) -> Column:
    """``SUM(CASE WHEN p THEN 1 ELSE 0 END)``; 0 for an all-false group."""
    return F.count_if(pred)


def avg_when(x, pred: Column) -> Column:
    """``AVG(CASE WHEN p THEN x END)``."""
    return F.avg(F.when(pred, col(x)))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """Zero-safe percentage of two counts, ``ROUND(100.0 * num / NULLIF(den, 0), digits)``.

    Computed in DECIMAL like SQL's ``100.0 * SUM(int)`` (exact half-up
    rounding, no binary-fraction ties), returned as DOUBLE. NULL when the
    denominator is 0.
    """
    return F.round(F.lit(HUNDRED) * num / F.nullif(den, F.lit(0)), digits).cast("double")


def pct_double(num: Column, den: Column, digits: int = 2) -> Column:
    """Zero-safe percentage of two DOUBLE sums (plain double arithmetic)."""
    return F.round(F.lit(100.0) * num / F.nullif(den, F.lit(0.0)), digits).cast("double")


def r2(x: Column, digits: int = 2) -> Column:
    return F.round(x, digits).cast("double")


def pctl_when(x, p: float, pred: Column) -> Column:
    """Approximate percentile of ``x`` over rows where ``pred`` holds.

    ``percentile_approx`` is a mergeable sketch, so it aggregates partially
    before the shuffle like ``sum``; it returns an element of the input.
    """
    return F.percentile_approx(F.when(pred, col(x)), F.lit(p))


def short_haul() -> Column:
    return F.col("distance") < SHORT_HAUL_MAX


def medium_haul() -> Column:
    return (F.col("distance") >= SHORT_HAUL_MAX) & (F.col("distance") < MEDIUM_HAUL_MAX)


def long_haul() -> Column:
    return F.col("distance") >= MEDIUM_HAUL_MAX


def delay_bands(delay="arrdelay") -> dict[str, Column]:
    """Histogram of arrival delay over operated flights, one count per band."""
    d = col(delay)
    e0, e1, e2, e3 = DELAY_BAND_EDGES
    op = operated()
    return {
        "flights_early_or_ontime": count_when((d <= e0) & op),
        "flights_delayed_1_to_15": count_when((d > e0) & (d <= e1) & op),
        "flights_delayed_16_to_60": count_when((d > e1) & (d <= e2) & op),
        "flights_delayed_61_to_120": count_when((d > e2) & (d <= e3) & op),
        "flights_delayed_over_120": count_when((d > e3) & op),
    }


# Distance-group labels.
DISTANCE_GROUPS = ("Short-haul (<500 mi)", "Medium-haul (500-1500 mi)", "Long-haul (>1500 mi)")


def distance_group(avg_distance: Column) -> Column:
    """Classify a route by its average distance; a NULL average is long-haul."""
    return (F.when(avg_distance < SHORT_HAUL_MAX, DISTANCE_GROUPS[0])
            .when(avg_distance < MEDIUM_HAUL_MAX, DISTANCE_GROUPS[1])
            .otherwise(DISTANCE_GROUPS[2]))


def city(name_col: str, code_col: str) -> Column:
    """City name falling back to the airport code."""
    return F.coalesce(F.col(name_col), F.col(code_col))


def state(name_col: str) -> Column:
    """State name falling back to the empty string."""
    return F.coalesce(F.col(name_col), F.lit(""))
