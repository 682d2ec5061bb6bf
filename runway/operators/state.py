"""Incremental-state operators as keyed DataFrame operators.

A loader tracks, per *key* (an airline, a feed, a layer) and *unit* (a
month or a year), whether the unit's output exists, what happened on each
attempt, and a high-water mark. Instead of a driver loop over one key,
every operator here takes tables of keys/units and returns a table, so
the work distributes over keys and months:

* calendar and work window  — ``explode(sequence(start, end, 1 month))``
* gap scan                  — calendar ``left_anti`` done units, then the
  marker state decides retry vs escalated
* watermarks                — leapfrog (max ok month) and contiguous
  (gaps-and-islands run after the old mark)
* marker state              — the failure marker implied by an attempt
  log: only attempts after the last success count; any CODE failure
  wins; 14 SOURCE failures escalate to CODE
* status / report           — counts per outcome → status text per key

Everything is aggregates, joins and windows over small per-key partitions
(units per key are bounded by the calendar); no group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runway.functions import scalars as S

# Outcome vocabulary, marker kinds and the SOURCE retry budget.
SUCCESS, SKIPPED, MISSING, FAILED = "success", "skipped", "missing", "failed"
OK_OUTCOMES = (SUCCESS, SKIPPED)
SOURCE, CODE = "SOURCE", "CODE"
MAX_SOURCE_RETRIES = 14

# Minimum landing size in bytes.
MIN_FILE_SIZE = 1024

# Run modes and layer flags.
INCREMENTAL, REPROCESS = "incremental", "reprocess"
LAYERS = ("bronze", "silver", "gold")


def add_months(c: Column, n: int | Column) -> Column:
    return F.add_months(c, n)


# ------------------------------------------------------------ ST-01 / 02

def month_calendar(bounds: DataFrame, start: str = "start", end: str = "end",
                   keys=("key",), step_months: int = 1) -> DataFrame:
    """(keys…, month) for every month in each row's inclusive [start, end].

    ``bounds`` holds one row per key with first-of-month DATE bounds; an
    empty range (start > end) yields no rows.
    """
    seq = F.sequence(F.col(start), F.col(end), F.expr(f"INTERVAL {int(step_months)} MONTH"))
    return (bounds.where(F.col(start) <= F.col(end))
            .select(*keys, F.explode(seq).alias("month")))


def year_calendar(bounds: DataFrame, start: str = "start", end: str = "end", keys=("key",)) -> DataFrame:
    """(keys…, year) for every year in each row's inclusive [start, end] (INT years)."""
    return (bounds.where(F.col(start) <= F.col(end))
            .select(*keys, F.explode(F.sequence(F.col(start), F.col(end))).alias("year")))


def work_window(marks: DataFrame, ceiling: Column, mode: str = INCREMENTAL,
                start: str | None = None, end: str | None = None, keys=("key",),
                mark_col: str = "watermark", layer: str = "silver") -> DataFrame:
    """Months to attempt per key.

    Incremental: ``next(watermark) … ceiling``. Reprocess: ``start … end``
    (``end`` defaults to the ceiling); ``start > end`` raises, and for the
    silver/gold layers so does ``end`` beyond the upstream ceiling (checked
    per key: offending keys make the job raise when the result is used).
    """
    if mode == INCREMENTAL:
        b = marks.select(*keys, add_months(F.col(mark_col), 1).alias("start"), ceiling.alias("end"))
        return month_calendar(b, keys=keys)
    if mode != REPROCESS:
        raise ValueError(f"unknown mode {mode!r}")
    if not start:
        raise ValueError("reprocess requires start (YYYY-MM)")
    s = _ym_literal(start, "start")
    e = _ym_literal(end, "end") if end else ceiling
    if end and start > end:
        raise ValueError(f"start {start} is after end {end}")
    b = marks.select(*keys, s.alias("start"), e.alias("end"), ceiling.alias("ceiling"))
    if layer != "bronze":
        b = b.withColumn("end", F.when(F.col("end") <= F.col("ceiling"), F.col("end"))
                         .otherwise(F.raise_error(F.concat(F.lit("end exceeds ceiling "),
                                                           S.ym_string(F.col("ceiling"))))))
    return month_calendar(b.drop("ceiling"), keys=keys)


def year_window(marks: DataFrame, ceiling: Column, mode: str = INCREMENTAL, start: str | None = None,
                end: str | None = None, keys=("key",), baseline_col: str = "baseline") -> DataFrame:
    """Years to attempt per key: the month windows of ``work_window`` from one
    January to the next, seen as years.

    ``marks`` holds a first year per key (``baseline_col``, INT) and ``ceiling``
    is the last year with input. Reprocess takes ``start`` … ``end`` (YYYY),
    checked as ``work_window`` checks its bounds.
    """
    def january(year: Column) -> Column:
        return F.make_date(year, F.lit(1), F.lit(1))

    for label, value in (("start", start), ("end", end)):
        if value and not str(value).isdigit():
            raise ValueError(f"{label} must be YYYY, got {value!r}")
    months = work_window(
        marks.withColumn("_mark", add_months(january(F.col(baseline_col)), -1)), january(ceiling), mode,
        start and f"{start}-01", end and f"{end}-01", keys, "_mark", "gold")
    return months.where(F.month("month") == 1).select(*keys, F.year("month").alias("year"))


def _ym_literal(ym: str, label: str) -> Column:
    import datetime as _dt
    try:
        d = _dt.datetime.strptime(ym, "%Y-%m").date()
    except (TypeError, ValueError) as e:
        raise ValueError(f"{label} must be YYYY-MM, got {ym!r}") from e
    return F.lit(d)


# ---------------------------------------------------------------- ST-14

def done_units(manifest: DataFrame, min_rows: Column | int = 1) -> DataFrame:
    """Units whose output holds at least ``min_rows`` rows (any object counts)."""
    return manifest.where(F.col("n") >= min_rows).select("key", "month")


# ---------------------------------------------------------------- ST-03

def gap_scan(calendar: DataFrame, done: DataFrame, markers: DataFrame | None,
             keys=("key",)) -> DataFrame:
    """Units of ``calendar`` without output: ``retry`` unless a CODE marker → ``escalated``.

    ``calendar`` already holds only the months to scan (baseline … watermark);
    ``markers`` is (keys…, month, state) from ``marker_state``.
    """
    on = [*keys, "month"]
    gaps = calendar.join(done, on, "left_anti")
    if markers is not None:
        gaps = gaps.join(markers.select(*on, "state"), on, "left")
    else:
        gaps = gaps.withColumn("state", F.lit(None).cast("string"))
    return gaps.select(*on, F.when(F.col("state") == CODE, "escalated").otherwise("retry").alias("action"))


# ------------------------------------------------------------ ST-04/05/07

def leapfrog_watermark(marks: DataFrame, outcomes: DataFrame, keys=("key",),
                       mark_col: str = "watermark", mode: str = INCREMENTAL,
                       month_col: str = "month") -> DataFrame:
    """New mark = max(old, max ``month_col`` with an ok outcome); never moves backwards.

    One union and one aggregate per key (no join): the old mark and the ok
    months meet in the same group. Keys come from ``marks``. Reprocess runs
    never move the mark.
    """
    k = list(keys)
    typ = marks.schema[mark_col].dataType
    none = F.lit(None).cast(typ)
    old = marks.select(*k, F.col(mark_col).alias("_old"), none.alias("_ok"), F.lit(True).alias("_has"))
    ok = (outcomes.where(F.col("outcome").isin(*OK_OUTCOMES))
          .select(*k, none.alias("_old"), F.col(month_col).cast(typ).alias("_ok"), F.lit(False).alias("_has")))
    g = (old.unionByName(ok).groupBy(*k)
         .agg(F.max("_old").alias("_old"), F.max("_ok").alias("_best"), F.max("_has").alias("_has"))
         .where(F.col("_has")))
    new = F.col("_old") if mode == REPROCESS else F.coalesce(F.greatest(F.col("_old"), F.col("_best")),
                                                             F.col("_old"))
    return g.select(*k, F.col("_old").alias("old_watermark"), new.alias("new_watermark"))


def gold_watermark(marks: DataFrame, year_outcomes: DataFrame, keys=("key",),
                   mark_col: str = "watermark", mode: str = INCREMENTAL) -> DataFrame:
    """ST-07: the Gold mark is the largest input month recorded by a year that
    succeeded or was skipped (``year_outcomes``: keys…, year, outcome, latest_month)."""
    return leapfrog_watermark(marks, year_outcomes, keys, mark_col, mode, month_col="latest_month")


def _month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def contiguous_watermark(marks: DataFrame, outcomes: DataFrame, keys=("key",),
                         mark_col: str = "watermark", mode: str = INCREMENTAL) -> DataFrame:
    """New mark = last month of the unbroken run of ok months right after the old mark.

    Gaps and islands without a join: each key's mark row and ok months share
    one window partition (bounded by the key's calendar); among ok months
    after the mark, numbered in order, the run starting at mark+1 is the set
    whose month index minus its number equals the mark's index. A union with
    the mark rows and one aggregate per key give (old, new).
    """
    k = list(keys)
    typ = marks.schema[mark_col].dataType
    none = F.lit(None).cast(typ)
    # a month that occurs more than once is ok when any of its outcomes is
    rows = (marks.select(*k, F.col(mark_col).alias("month"), F.lit(True).alias("_m"))
            .unionByName(outcomes.where(F.col("outcome").isin(*OK_OUTCOMES))
                         .select(*k, F.col("month").cast(typ).alias("month"), F.lit(False).alias("_m")).distinct()))
    rows = rows.withColumn("_old", F.max(F.when(F.col("_m"), F.col("month"))).over(Window.partitionBy(*k)))
    after = rows.where(~F.col("_m") & (F.col("month") > F.col("_old")))
    w = Window.partitionBy(*k).orderBy("month")
    run = (after.withColumn("_grp", _month_index(F.col("month")) - F.row_number().over(w))
           .where(F.col("_grp") == _month_index(F.col("_old"))))
    both = (rows.where(F.col("_m")).select(*k, F.col("month").alias("_o"), none.alias("_e"))
            .unionByName(run.select(*k, none.alias("_o"), F.col("month").alias("_e"))))
    g = both.groupBy(*k).agg(F.max("_o").alias("_o"), F.max("_e").alias("_e"))
    new = F.col("_o") if mode == REPROCESS else F.coalesce(F.col("_e"), F.col("_o"))
    return g.select(*k, F.col("_o").alias("old_watermark"), new.alias("new_watermark"))


# ---------------------------------------------------------------- ST-06

def frontier_by_year(silver: DataFrame, keys=()) -> DataFrame:
    """Latest month (first-of-month DATE) present per year."""
    return (silver.where(F.col("year").isNotNull() & F.col("month").isNotNull())
            .groupBy(*keys, F.col("year").cast("int").alias("year"))
            .agg(F.max(S.first_of_month()).alias("latest_month")))


def stale_years(frontier: DataFrame, markers: DataFrame) -> DataFrame:
    """Per year: latest input month vs the month recorded when output was last built.

    ``markers`` is (year, body) with ``latest_silver_month=YYYY-MM`` in the
    body; a year is stale when it has no marker or the months differ.
    """
    m = markers.select("year", S.parse_ym(S.marker_field(F.col("body"), "latest_silver_month"))
                       .alias("marker_month"))
    j = frontier.join(m, "year", "left")
    return j.select("year", "latest_month", "marker_month",
                    (~F.col("latest_month").eqNullSafe(F.col("marker_month"))).alias("stale"))


# ---------------------------------------------------------------- ST-08

def marker_snapshot(log: DataFrame, unit_cols=("unit",), buckets: int = 64) -> DataFrame:
    """What an attempt log (unit…, seq, attempt_ts, outcome) says of each unit, as a state
    that merges with that of a later part of the log (``merge_snapshots``).

    ``last_ok`` (seq of the unit's last ok attempt) and, of the attempts after it (the
    island), ``n_code``, ``n_source``, ``last_attempt_ts`` and ``early``: the first 14
    SOURCE attempts (seq, attempt_ts). One row per unit of the log.

    Skew: a unit's log is dealt over ``buckets`` by seq before the join with its
    last ok attempt and reduced there to a count, a first failure and its first
    14 SOURCE attempts; only these meet per unit.
    """
    u = list(unit_cols)
    salt = F.pmod(F.col("seq"), F.lit(buckets)).cast("int")
    is_ok = F.col("outcome").isin(*OK_OUTCOMES)
    last_ok = log.groupBy(*u).agg(F.max(F.when(is_ok, F.col("seq"))).alias("last_ok"))
    every = last_ok.select(*u, "last_ok", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_salt"))
    # dealt by (unit, bucket): partitioning by unit alone would also satisfy what follows
    dealt = log.withColumn("_salt", salt).repartition(*u, "_salt")
    island = (dealt.join(every, [*u, "_salt"], "inner")
              .where(F.col("last_ok").isNull() | (F.col("seq") > F.col("last_ok"))))
    src = F.col("outcome") == SOURCE
    wb = Window.partitionBy(*u, "_salt").orderBy(F.desc(src), "seq")
    # per bucket: its first 14 SOURCE attempts as a bounded list, the rest as counts
    part = (island.withColumn("_rb", F.row_number().over(wb)).groupBy(*u, "_salt").agg(
        F.count_if(F.col("outcome") == CODE).alias("_code"), F.count_if(src).alias("_source"),
        F.max("attempt_ts").alias("_last"),
        F.collect_list(F.when(src & (F.col("_rb") <= MAX_SOURCE_RETRIES), F.struct("seq", "attempt_ts"))).alias("_early")))
    agg = part.groupBy(*u).agg(
        F.sum("_code").alias("n_code"), F.sum("_source").alias("n_source"), F.max("_last").alias("last_attempt_ts"),
        _first_attempts(F.flatten(F.collect_list("_early"))).alias("early"))  # at most 14 a bucket
    # last_ok has one row per unit (all units), so it is the unit list too
    none = F.array().cast(agg.schema["early"].dataType)
    return last_ok.join(agg, u, "left").select(
        *u, "last_ok", F.coalesce("n_code", F.lit(0)).alias("n_code"), F.coalesce("n_source", F.lit(0)).alias("n_source"),
        "last_attempt_ts", F.coalesce("early", none).alias("early"))


def _first_attempts(attempts: Column) -> Column:
    return F.slice(F.sort_array(attempts), 1, MAX_SOURCE_RETRIES)


def merge_snapshots(before: DataFrame, after: DataFrame, unit_cols=("unit",)) -> DataFrame:
    """The snapshot of a log from those of its part up to some seq and of the rest. An ok
    attempt in the later part ends the earlier island; without one the islands join.
    Associative, so a log may be folded in parts of any size."""
    u = list(unit_cols)
    x, y = F.col("x"), F.col("y")
    names = [c for c in before.columns if c not in u]
    both = before.select(*u, F.struct(*names).alias("x")).join(after.select(*u, F.struct(*names).alias("y")), u, "full")
    alone = x.isNull() | y["last_ok"].isNotNull()
    joined = {"last_ok": x["last_ok"], "n_code": x["n_code"] + y["n_code"], "n_source": x["n_source"] + y["n_source"],
              "last_attempt_ts": F.greatest(x["last_attempt_ts"], y["last_attempt_ts"]),
              "early": _first_attempts(F.concat(x["early"], y["early"]))}
    return both.select(*u, *[F.when(y.isNull(), x[c]).when(alone, y[c]).otherwise(joined[c]).alias(c) for c in names])


def marker_of(snapshot: DataFrame, unit_cols=("unit",)) -> DataFrame:
    """The failure marker that a snapshot implies (see ``marker_state``)."""
    u = list(unit_cols)
    first, nth = F.get(F.col("early"), F.lit(0)), F.get(F.col("early"), F.lit(MAX_SOURCE_RETRIES - 1))
    n_code, n_src = F.col("n_code"), F.col("n_source")
    escalated = (n_code == 0) & (n_src >= MAX_SOURCE_RETRIES)
    state = (F.when(n_code > 0, CODE).when(escalated, CODE).when(n_src > 0, SOURCE).otherwise("none"))
    return snapshot.select(
        *u,
        state.alias("state"),
        escalated.alias("escalated"),
        F.when(n_code > 0, F.lit(None).cast("int"))
        .when(escalated, F.lit(MAX_SOURCE_RETRIES))
        .otherwise(n_src.cast("int")).alias("attempts"),
        F.when((n_code == 0) & (n_src > 0), first["attempt_ts"]).alias("first_seen"),
        F.when(escalated, nth["attempt_ts"]).alias("escalated_at"),
        F.col("last_attempt_ts"),
    )


def marker_state(log: DataFrame, unit_cols=("unit",), buckets: int = 64) -> DataFrame:
    """Failure marker implied by an attempt log (unit…, seq, attempt_ts, outcome).

    Only attempts after the unit's last ok attempt count (the island).
    Any CODE failure in the island → ``CODE`` (a CODE write overwrites and
    SOURCE never downgrades it); else ``n`` SOURCE failures → ``SOURCE`` with
    ``attempts = n`` and ``first_seen`` = first failure, escalated to
    ``CODE`` at the 14th (``escalated_at`` = its time). No island → ``none``.
    """
    return marker_of(marker_snapshot(log, unit_cols, buckets), unit_cols)


ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def marker_body(state: DataFrame, reason: str = "Input not found or empty") -> DataFrame:
    """Render the marker text a loader would store for each state (NULL for none)."""
    first = F.date_format("first_seen", ISO)
    body = (F.when(F.col("state") == SOURCE,
                   F.concat(F.lit(f"SOURCE: {reason} | attempts="), F.col("attempts").cast("string"),
                            F.lit(" | first_seen="), first))
            .when(F.col("escalated"),
                  F.concat(F.lit(f"CODE: Escalated after {MAX_SOURCE_RETRIES} attempts — {reason} (first_seen="),
                           first, F.lit(", escalated_at="), F.date_format("escalated_at", ISO), F.lit(")")))
            .when(F.col("state") == CODE, F.lit("CODE: failure needs a code fix")))
    return state.withColumn("body", body)


def parse_marker(df: DataFrame, body: str = "body") -> DataFrame:
    """SC-13/14: kind by prefix, ``attempts=`` and ``first_seen=`` fields of a marker body."""
    b = F.col(body)
    return df.select("*", S.marker_kind(b).alias("kind"),
                     S.marker_attempts(b).alias("parsed_attempts"),
                     S.marker_field(b, "first_seen").alias("parsed_first_seen"))


# ---------------------------------------------------------------- ST-09

def retryable_units(work: DataFrame, markers: DataFrame, unit_cols=("unit",),
                    reprocess: bool = False) -> DataFrame:
    """Work units with ``run`` or ``blocked`` (a CODE marker blocks unless reprocessing)."""
    u = list(unit_cols)
    j = work.join(markers.select(*u, "state"), u, "left")
    blocked = F.lit(False) if reprocess else F.coalesce(F.col("state") == CODE, F.lit(False))
    return j.select(*[c for c in work.columns],
                    F.when(blocked, "blocked").otherwise("run").alias("action"))


# ---------------------------------------------------------------- ST-10

def classify_attempts(attempts: DataFrame, status: str = "http_status", error: str = "error_kind",
                      size: str = "size_bytes", min_size: int = MIN_FILE_SIZE) -> DataFrame:
    """Outcome and marker class of each landing attempt.

    404 or 5xx, network errors, corrupt archives and too-small files are
    ``missing`` with a SOURCE marker (may appear later); 403 and any other
    HTTP or unexpected error are ``failed`` with a CODE marker; otherwise
    ``success``.
    """
    st, err, sz = F.col(status), F.col(error), F.col(size)
    http_fail = st.isNotNull() & (st != 200)
    source_http = (st == 404) | ((st >= 500) & (st < 600))
    reason = (F.when(http_fail & source_http, F.concat(F.lit("SOURCE: HTTP "), st.cast("string")))
              .when(st == 403, F.lit("CODE: HTTP 403 Forbidden"))
              .when(http_fail, F.concat(F.lit("CODE: HTTP "), st.cast("string")))
              .when(err == "network", F.lit("SOURCE: network error"))
              .when(err == "corrupt", F.lit("SOURCE: Corrupt archive"))
              .when(err.isNotNull(), F.concat(F.lit("CODE: "), err))
              .when(sz < min_size, F.lit("SOURCE: File too small")))
    kind = S.marker_kind(reason)
    outcome = F.when(kind == SOURCE, MISSING).when(kind == CODE, FAILED).otherwise(SUCCESS)
    return attempts.select("*", outcome.alias("outcome"), kind.alias("marker_class"), reason.alias("reason"))


def landing_size_check(df: DataFrame, size: Column, min_size: int = MIN_FILE_SIZE) -> DataFrame:
    """SRC-07: ``missing`` when the landed object is below the minimum size, else ``ok``."""
    return df.withColumn("size_bytes", size.cast("bigint")).withColumn(
        "outcome", F.when(F.col("size_bytes") < min_size, MISSING).otherwise("ok"))


# ------------------------------------------------------------ ST-11/13

def run_status(outcomes: DataFrame, keys=("key",), mode: str = INCREMENTAL, layer: str = "silver",
               marks: DataFrame | None = None) -> DataFrame:
    """Per key: counts per outcome, the status text and the total-failure flag.

    ``marks`` (keys…, old_watermark, new_watermark) lists the keys and tells
    whether the mark moved; a key without outcomes gets the status of an empty
    run. Without it the mark is taken as moved.
    """
    k = list(keys)
    counts = outcomes.groupBy(*k).agg(*[F.count_if(F.col("outcome") == o).cast("bigint").alias(o)
                                       for o in (SUCCESS, SKIPPED, MISSING, FAILED)])
    if marks is not None:
        counts = marks.select(*k, (~F.col("old_watermark").eqNullSafe(F.col("new_watermark"))).alias("_moved")).join(
            counts, k, "left").fillna(0, [SUCCESS, SKIPPED, MISSING, FAILED])
    else:
        counts = counts.withColumn("_moved", F.lit(True))
    s, sk, mi, fa = (F.col(c) for c in (SUCCESS, SKIPPED, MISSING, FAILED))
    total = s + sk + mi + fa
    bad = (mi + fa) > 0
    stalled = F.lit(mode == INCREMENTAL) & (total > 0) & ~F.coalesce(F.col("_moved"), F.lit(False))
    nothing = "NO YEARS IN WINDOW" if layer == "gold" else "NO NEW DATA"
    if mode == REPROCESS:
        status = (F.when(total == 0, nothing)
                  .when((s == 0) & bad, "REPROCESS FAILED")
                  .when(bad, "REPROCESS PARTIAL").otherwise("REPROCESS COMPLETE"))
    else:
        status = (F.when(total == 0, nothing)
                  .when((s == 0) & (sk == 0),
                        F.concat(F.lit("FAILED"), F.when(stalled, F.lit(" — WATERMARK STALLED")).otherwise(F.lit(""))))
                  .when(bad, F.concat(F.lit("PARTIAL SUCCESS"),
                                      F.when(stalled, F.lit(" — WATERMARK STALLED"))
                                      .otherwise(F.lit(" — GAPS PRESENT"))))
                  .otherwise("SUCCESS"))
    if layer == "bronze":
        total_failure = (total > 0) & (s == 0) & (sk == 0) & (mi == 0) & (fa > 0)
    else:
        total_failure = (total > 0) & (s == 0) & (sk == 0) & bad
    return counts.select(*k, SUCCESS, SKIPPED, MISSING, FAILED, status.alias("status"),
                         total_failure.alias("total_failure"))


def raise_on_total_failure(status: DataFrame) -> None:
    """ST-13: fail the job when any key's run was a total failure.

    The error says how many and names the first of them.
    """
    bad = status.where(F.col("total_failure"))
    row = bad.agg(F.count(F.lit(1)).alias("n"), F.min(F.col(status.columns[0]).cast("string")).alias("first")).first()
    if row["n"]:
        raise RuntimeError(f"TOTAL FAILURE — no unit succeeded for {row['n']} key(s), first: {row['first']}")


# ---------------------------------------------------------------- ST-12

def run_report(outcomes: DataFrame, metrics: DataFrame, keys=("key",)) -> DataFrame:
    """One line per unit: outcome plus Silver metrics for units that succeeded."""
    on = [*keys, "month"]
    j = outcomes.join(metrics, on, "left")
    ok = F.col("outcome") == SUCCESS
    mcols = [c for c in metrics.columns if c not in on]
    return j.select(*on, "outcome", *[F.when(ok, F.col(c)).alias(c) for c in mcols])


def report_breakdown(outcomes: DataFrame, breakdown: DataFrame, keys=("key",)) -> DataFrame:
    """ST-12 detail lines: the rule breakdown (reason, cnt) under each unit that succeeded.

    ``breakdown`` is ``dq.breakdown`` keyed by (keys…, month); the join is on
    unit keys of two per-unit tables (no raw rows).
    """
    on = [*keys, "month"]
    ok = outcomes.where(F.col("outcome") == SUCCESS).select(*on)
    return ok.join(breakdown.select(*on, "reason", "cnt"), on, "inner")
