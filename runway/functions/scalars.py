"""Scalar ``Column`` builders: labels, time blocks, month keys, marker fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO weekday names (1 = Monday … 7 = Sunday) and weekend days.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
WEEKEND_DAYS = (6, 7)

# Cancellation codes and their reasons; any other code is Unknown.
CANCELLATION_REASONS = (("A", "Carrier"), ("B", "Weather"), ("C", "National Air System"),
                        ("D", "Security"))
UNKNOWN_REASON = "Unknown"

# Departure-hour periods (inclusive hour ranges); anything
# else, including a NULL or non-numeric hour, is off-peak.
TIME_PERIODS = (((6, 9), "Morning Peak (6-9)"), ((10, 14), "Midday (10-14)"),
                ((15, 19), "Evening Peak (15-19)"))
OFF_PEAK = "Off-Peak (20-5)"


def day_of_week_name(dow, default: str | None = "Unknown") -> Column:
    """Simple CASE over the ISO weekday; ``default`` for anything else (may be None)."""
    d = F.col(dow).try_cast("int") if isinstance(dow, str) else dow
    expr = None
    for i, name in enumerate(DAY_NAMES, start=1):
        expr = F.when(d == i, name) if expr is None else expr.when(d == i, name)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def weekend_flag(dow) -> Column:
    d = F.col(dow).try_cast("int") if isinstance(dow, str) else dow
    return F.when(d.isin(*WEEKEND_DAYS), "Weekend").otherwise("Weekday")


def cancellation_reason(code="cancellationcode") -> Column:
    c = F.col(code) if isinstance(code, str) else code
    expr = None
    for k, reason in CANCELLATION_REASONS:
        expr = F.when(c == k, reason) if expr is None else expr.when(c == k, reason)
    return expr.otherwise(UNKNOWN_REASON)


def block_hour(block="deptimeblk") -> Column:
    """Hour of a ``HH00-HH59`` block: first two characters as INT, NULL if not numeric."""
    b = F.col(block) if isinstance(block, str) else block
    return F.substring(b, 1, 2).try_cast("int")


def time_period(hour: Column) -> Column:
    expr = None
    for (lo, hi), label in TIME_PERIODS:
        expr = F.when(hour.between(lo, hi), label) if expr is None else expr.when(hour.between(lo, hi), label)
    return expr.otherwise(OFF_PEAK)


def nonblank(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return x.isNotNull() & (x != "")


def blank_to_null(c) -> Column:
    """``NULL`` when the trimmed value is empty, else the value."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(F.trim(x) == "", F.lit(None)).otherwise(x)


def first_of_month(year="year", month="month") -> Column:
    """DATE of the first of the month; NULL for a month outside 1..12 (no ANSI error)."""
    m = F.col(month)
    return F.when((m >= 1) & (m <= 12), F.make_date(F.col(year), m, F.lit(1)))


def ym_string(month: Column) -> Column:
    """DATE (first of month) → ``YYYY-MM``."""
    return F.date_format(month, "yyyy-MM")


def parse_ym(s: Column) -> Column:
    """``YYYY-MM`` → DATE (first of month), NULL when malformed."""
    return F.when(s.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), F.try_to_date(F.concat(s, F.lit("-01")), "yyyy-MM-dd"))


def is_year_string(s: Column) -> Column:
    return s.rlike(r"^\d{4}$")


def marker_field(body: Column, field: str) -> Column:
    """Value of ``field=<value>`` in a marker body (value ends at space or ``|``); NULL if absent."""
    return F.nullif(F.regexp_extract(body, rf"{field}=([^\s|]+)", 1), F.lit(""))


def marker_attempts(body: Column) -> Column:
    """``attempts=N`` as INT; 0 when absent."""
    return F.coalesce(F.nullif(F.regexp_extract(body, r"attempts=(\d+)", 1), F.lit("")).cast("int"), F.lit(0))


def marker_kind(body: Column) -> Column:
    """``SOURCE`` / ``CODE`` by prefix; NULL for no marker or anything else."""
    return (F.when(body.startswith("SOURCE:"), "SOURCE")
            .when(body.startswith("CODE:"), "CODE"))
