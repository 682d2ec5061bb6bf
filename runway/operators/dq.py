"""Declarative data-quality rules: flag, split, deduplicate, measure, explain.

A rule is ``(id, message, predicate, severity, columns)``; the predicate is
a built-in ``Column`` built from thresholds, so every rule runs inside one
codegen'd projection. Predicates are three-valued: a NULL operand never
fires a range rule.

Operators (all lazy, DataFrame → DataFrame):

* ``flag``        — adds ``rejection_reason``: fired messages joined by
  ``' | '`` in rule order, NULL when none fired.
* ``clean``       — rows with no reason, exact duplicates removed (DQ16).
* ``rejected``    — rows with a reason (duplicates kept).
* ``copy_counts`` — one row per distinct flagged row with ``copies``; the
  single all-column aggregate from which the clean set and the metrics
  derive (one shuffle). The rejected set is a narrow filter of the flagged
  rows, so however many copies a rejected row has, they stay spread over
  the input's tasks.
* ``metrics``     — per key: rows, clean, rejected, dupes, rate.
* ``breakdown``   — firings per rule (sum may exceed rejected rows).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runway.functions.measures import pct
from runway.functions.scalars import blank_to_null

# Rule thresholds (minutes; HHMM ceiling).
MAX_DELAY = 1440
MIN_DELAY = -60
MAX_TIME = 2400

# Fixed value: separator between fired messages.
REASON_SEP = " | "

# Fixed value: rejection-rate alert threshold in percent.
ALERT_PCT = 10.0

# Columns that identify a flight in rule reports.
ID_COLUMNS = ["year", "month", "dayofmonth", "reporting_airline", "origin", "dest"]


@dataclass(frozen=True)
class Rule:
    id: str
    message: str
    predicate: Column
    severity: str
    columns: tuple = field(default=())


def _c(name):
    return F.col(name)


def _outside(x: str, lo, hi) -> Column:
    return _c(x).isNotNull() & ((_c(x) < lo) | (_c(x) > hi))


def default_rules(max_delay=MAX_DELAY, min_delay=MIN_DELAY, max_time=MAX_TIME) -> list[Rule]:
    """The sixteen row rules in evaluation order (DQ10 has two fragments)."""
    operated = (_c("cancelled") == 0) & (_c("diverted") == 0)
    # Rule ids, messages and severities.
    return [
        Rule("DQ01", "DQ01: Null flight date",
             _c("year").isNull() | _c("month").isNull() | _c("dayofmonth").isNull(), "Critical",
             ("year", "month", "dayofmonth")),
        Rule("DQ02", "DQ02: Null airline", _c("reporting_airline").isNull(), "Critical",
             ("reporting_airline",)),
        Rule("DQ03", "DQ03: Null route", _c("origin").isNull() | _c("dest").isNull(), "Critical",
             ("origin", "dest")),
        Rule("DQ04", "DQ04: Null distance", _c("distance").isNull(), "Major", ("distance",)),
        Rule("DQ05", "DQ05: Invalid month", (_c("month") < 1) | (_c("month") > 12), "Critical", ("month",)),
        Rule("DQ06", "DQ06: Invalid dayofmonth", (_c("dayofmonth") < 1) | (_c("dayofmonth") > 31), "Critical",
             ("dayofmonth",)),
        Rule("DQ07", "DQ07: Distance <= 0", _c("distance").isNotNull() & (_c("distance") <= 0), "Major",
             ("distance",)),
        Rule("DQ08", "DQ08: depdelay out of range", _outside("depdelay", min_delay, max_delay), "Major",
             ("depdelay",)),
        Rule("DQ09", "DQ09: arrdelay out of range", _outside("arrdelay", min_delay, max_delay), "Major",
             ("arrdelay",)),
        Rule("DQ10a", "DQ10: deptime invalid", _outside("deptime", 0, max_time), "Major", ("deptime",)),
        Rule("DQ10b", "DQ10: arrtime invalid", _outside("arrtime", 0, max_time), "Major", ("arrtime",)),
        Rule("DQ11", "DQ11: Cancelled flight has arrtime", (_c("cancelled") == 1) & _c("arrtime").isNotNull(),
             "Logical", ("cancelled", "arrtime")),
        Rule("DQ12", "DQ12: Cancelled flight has arrdelay", (_c("cancelled") == 1) & _c("arrdelay").isNotNull(),
             "Logical", ("cancelled", "arrdelay")),
        Rule("DQ13", "DQ13: Operated flight has no deptime", operated & _c("deptime").isNull(), "Logical",
             ("cancelled", "diverted", "deptime")),
        Rule("DQ14", "DQ14: airtime > actualelapsedtime",
             _c("airtime").isNotNull() & _c("actualelapsedtime").isNotNull()
             & (_c("airtime") > _c("actualelapsedtime")), "Logical", ("airtime", "actualelapsedtime")),
        Rule("DQ15", "DQ15: origin == dest",
             _c("origin").isNotNull() & _c("dest").isNotNull() & (_c("origin") == _c("dest")), "Logical",
             ("origin", "dest")),
    ]


# Fixed value: the dedup rule, reported separately (it removes, not rejects).
DEDUP_RULE = ("DQ16", "DQ16: Exact duplicate", "Major")


def rule_by_id(rule_id: str, rules=None) -> Rule:
    for r in default_rules() if rules is None else rules:
        if r.id == rule_id:
            return r
    raise KeyError(rule_id)


def reason_column(rules=None) -> Column:
    """Fired messages joined in rule order; NULL when none fired."""
    rules = default_rules() if rules is None else rules
    if not rules:
        return F.lit(None).cast("string")
    joined = F.concat_ws(REASON_SEP, *[F.when(r.predicate, F.lit(r.message)) for r in rules])
    return blank_to_null(joined)


def flag(df: DataFrame, rules=None, reason_col: str = "rejection_reason") -> DataFrame:
    """All columns + ``rejection_reason`` (one narrow projection)."""
    return df.withColumn(reason_col, reason_column(rules))


def rejected(flagged: DataFrame, reason_col: str = "rejection_reason") -> DataFrame:
    return flagged.where(F.col(reason_col).isNotNull())


def clean(flagged: DataFrame, reason_col: str = "rejection_reason") -> DataFrame:
    """Rows without a reason, exact duplicates over all columns removed (DQ16).

    ``dropDuplicates`` is a hash aggregate with map-side partial
    aggregation: a hot group of copies collapses to one row per input
    partition before the shuffle.
    """
    return flagged.where(F.col(reason_col).isNull()).drop(reason_col).dropDuplicates()


MARK_BITS = 1 << 26  # marks of repeated digests: 8 MB, whatever the number of rows
_BITMAP = 1 << 15  # bits of one bitmap


def row_digest(columns) -> tuple[Column, Column]:
    """128 bits of a row's values; equal rows (NULL equal to NULL, 0.0 to -0.0) have equal ones."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


def unsure_rows(rows: DataFrame, digest=row_digest, bits: int = MARK_BITS) -> DataFrame:
    """``rows`` with ``_unsure``: whether another row may be equal. Digests that occur twice
    set a mark among ``bits``; a row under a mark is unsure, any other is the only one of
    its kind. Only digests are shuffled, after partial counts; the marks are a bitmap
    of bounded size, which is broadcast."""
    first, second = digest([F.col(f"`{c}`") for c in rows.columns])
    again = rows.select(first.alias("h1"), second.alias("h2")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    mark = F.pmod(F.col("h1"), F.lit(bits))
    marks = again.select(mark.alias("mark")).groupBy(F.expr(f"mark div {_BITMAP}").alias("_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("_marks"))  # at most bits / 2^15 rows of 4 KB
    own = rows.withColumn("_mark", F.pmod(first, F.lit(bits)))
    own = own.withColumn("_block", F.expr(f"_mark div {_BITMAP}")).join(F.broadcast(marks), "_block", "left")
    at = F.bitmap_bit_position("_mark").cast("int")
    byte = F.conv(F.hex(F.substring("_marks", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # shifts by a column: divide by the power of two
    set_ = F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))).cast("int").bitwiseAND(F.lit(1)) == 1
    return own.withColumn("_unsure", F.coalesce(set_, F.lit(False))).drop("_mark", "_block", "_marks")


def clean_by_digest(flagged: DataFrame, reason_col: str = "rejection_reason", digest=row_digest, bits: int = MARK_BITS) -> DataFrame:
    """``clean``, by digest first: rows without an equal go from the scan to the result, and
    only those that may have one are shuffled whole and compared on all columns.

    Worth its extra passes over a narrow projection where few rows are repeated and
    rows are wide. Equal digests of different rows, and shared marks, cost a
    shuffle of these rows and nothing else.
    """
    rows = flagged.where(F.col(reason_col).isNull()).drop(reason_col)
    told = unsure_rows(rows, digest, bits)
    return told.where(~F.col("_unsure")).drop("_unsure").unionAll(told.where("_unsure").drop("_unsure").dropDuplicates())


def copy_counts(flagged: DataFrame) -> DataFrame:
    """One row per distinct flagged row with ``copies`` = multiplicity.

    Grouped on one struct of all columns (NULL fields group together, floats
    are normalised — the same groups as grouping by each column); the single
    wide key keeps the generated partial-aggregation code JIT-sized.
    """
    cols = flagged.columns
    return (flagged.groupBy(F.struct(*cols).alias("_row")).agg(F.count(F.lit(1)).alias("copies"))
            .select(*[F.col(f"_row.{c}").alias(c) for c in cols], "copies"))


def clean_from_counts(counts: DataFrame, reason_col: str = "rejection_reason") -> DataFrame:
    return counts.where(F.col(reason_col).isNull()).drop(reason_col, "copies")


def metrics_from_counts(counts: DataFrame, keys=("year", "month"),
                        reason_col: str = "rejection_reason") -> DataFrame:
    """rows, clean, rejected, dupes and rejection rate per key, from ``copy_counts``."""
    is_clean = F.col(reason_col).isNull()
    cp = F.col("copies")
    m = counts.groupBy(*keys).agg(
        F.sum(cp).alias("rows"),
        F.sum(F.when(is_clean, cp).otherwise(0)).alias("clean_before_dedup"),
        F.count_if(is_clean).alias("clean"),
        F.sum(F.when(~is_clean, cp).otherwise(0)).alias("rejected"),
    )
    return m.select(
        *keys,
        F.col("rows").cast("bigint").alias("total_rows"),
        F.col("clean").cast("bigint").alias("clean_rows"),
        F.col("rejected").cast("bigint").alias("rejected_rows"),
        (F.col("clean_before_dedup") - F.col("clean")).cast("bigint").alias("dupes_removed"),
        pct(F.col("rejected"), F.greatest(F.col("rows"), F.lit(1))).alias("rejection_pct"),
    )


def metrics(flagged: DataFrame, keys=("year", "month"), reason_col: str = "rejection_reason") -> DataFrame:
    """Per-key Silver metrics in one job (all months at once)."""
    return metrics_from_counts(copy_counts(flagged), keys, reason_col)


def alert_months(metrics_df: DataFrame, pct: float = ALERT_PCT) -> DataFrame:
    """Keys whose rejection rate is above ``pct`` percent."""
    return metrics_df.where(F.col("rejection_pct") > pct)


def _firing_rows(df: DataFrame, rules, keys, weight: Column | None):
    w = weight if weight is not None else F.lit(1)
    aggs = [F.sum(F.when(r.predicate, w).otherwise(0)).cast("bigint").alias(f"_r{i}")
            for i, r in enumerate(rules)]
    wide = df.groupBy(*keys).agg(*aggs) if aggs else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    # unpivot: one (rule_id, reason, severity, cnt) row per rule and key; texts are
    # literals, never SQL, so a message may hold any character
    entries = [F.struct(F.lit(r.id).alias("rule_id"), F.lit(r.message).alias("reason"), F.lit(r.severity).alias("severity"),
                        F.col(f"_r{i}").alias("cnt")) for i, r in enumerate(rules)]
    if not entries:
        none = "array<struct<rule_id:string,reason:string,severity:string,cnt:bigint>>"
        return wide.select(*keys, F.inline(F.array().cast(none)))
    return wide.select(*keys, F.inline(F.array(*entries)))


def breakdown(df: DataFrame, rules=None, keys=(), weight: Column | None = None) -> DataFrame:
    """Firings per rule message, fired rules only, most frequent first.

    One aggregate of one conditional sum per rule (partial aggregation, no
    explode of strings), then an unpivot; a rule's count is the number of
    rows on which it fired, so the sum can exceed the rejected rows.
    ``weight`` counts each row that many times (for ``copy_counts`` input).
    """
    rules = default_rules() if rules is None else rules
    out = _firing_rows(df, rules, keys, weight).where(F.col("cnt") > 0)
    return out.select(*keys, "reason", "cnt").orderBy(*keys, F.desc("cnt"), F.asc("reason"))


def breakdown_by_reason(flagged: DataFrame, reason_col: str = "rejection_reason") -> DataFrame:
    """Breakdown from the joined reason string (``explode(split(...))``).

    Equivalent to ``breakdown``; kept for rejected sets that were stored
    with the reason text only (no source columns to re-evaluate).
    """
    parts = F.explode(F.split(F.col(reason_col), r" \| "))
    return (flagged.where(F.col(reason_col).isNotNull() & (F.col(reason_col) != ""))
            .select(parts.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc("reason")))


def severity_rollup(df: DataFrame, rules=None) -> DataFrame:
    """Firings per severity (rule severities are fixed values of the rule list)."""
    rules = default_rules() if rules is None else rules
    fired = _firing_rows(df, rules, (), None)
    return (fired.groupBy("severity").agg(F.sum("cnt").cast("bigint").alias("cnt"))
            .where(F.col("cnt") > 0))


def rule_violations(df: DataFrame, rule: Rule, id_columns=ID_COLUMNS) -> DataFrame:
    """Rows on which ``rule`` fires: identifying columns plus the columns it reads."""
    cols = list(dict.fromkeys(list(id_columns) + list(rule.columns)))
    return df.where(rule.predicate).select(*cols)


def duplicate_groups(clean_rows: DataFrame, id_columns=ID_COLUMNS) -> DataFrame:
    """DQ16 report: groups of exact duplicates with the number of copies removed.

    Grouped on one struct of all columns (same semantics as grouping by each
    column: NULL fields group together, floats are normalised); one wide key
    keeps the generated aggregate code small enough for the JIT.
    """
    g = (clean_rows.groupBy(F.struct(*clean_rows.columns).alias("_row"))
         .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1))
    return g.select(*[F.col(f"_row.{c}").alias(c) for c in id_columns],
                    (F.col("_n") - 1).cast("bigint").alias("copies_removed"))
