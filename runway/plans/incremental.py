"""Incremental runs: the state operators composed with a control table.

Control data lives in Parquet under ``control_root``:

* ``marks``    (layer, key, watermark DATE) — one high-water mark per layer/key
* ``attempts`` (layer, key, month, seq, attempt_ts, outcome) — the attempt log;
  failure markers are *derived* from it (``marker_state``), never stored

A Silver increment for one dataset key:

1. the window — ``next(mark) … ceiling`` (incremental) or ``start … end``
   (reprocess) — plus, incrementally, the gap scan of ``baseline … mark``
   (months without output: retry, or escalated when a CODE marker blocks);
2. CODE-blocked units are ``failed`` without an attempt (unless reprocessing),
   units already done are ``skipped`` (incremental only);
3. the remaining units run as Silver jobs over many months each, ``BATCH_BYTES`` of
   input a core: the raw layout is filtered by the unit list on (year, month), so
   only those partitions are read, every month of a job is processed in parallel,
   and the disk holds the shuffles of one job, however many months there are;
4. outcomes (success / missing / failed / skipped) are appended to the attempt
   log, the mark moves to the contiguous high-water mark (incremental only),
   and a status row is produced per key.

The Gold increment follows the same shape by year: stale years (latest input
month differs from the month recorded at the last build) are rebuilt in one
job, the trend is recomputed when any year succeeded, and the mark moves to
the largest input month of the years that succeeded or were skipped.
"""

from __future__ import annotations

import datetime as dt
import logging
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.functions import scalars as S
from runway.operators import dq
from runway.operators import state as st
from runway.plans.gold import recompute_trend, run_gold
from runway.plans.silver import run_silver
from runway.plans.sinks import batches, stored_bytes, stored_units, unit_folder
from runway.sources.scans import of_months, read_flights, readable_flights

log = logging.getLogger(__name__)

BATCH_BYTES = 32 << 20  # stored input a core that one Silver job takes; of gzipped CSV, its shuffles are some eight times as large

MARKS_SCHEMA = "layer string, key string, watermark date"
METRICS_SCHEMA = ("total_rows bigint, clean_rows bigint, rejected_rows bigint, dupes_removed bigint,"
                  " rejection_pct double, year int, month int")
ATTEMPTS_SCHEMA = "layer string, key string, month date, seq bigint, attempt_ts timestamp, outcome string"


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    from runway.plans.sinks import path_exists

    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _month(ym: str) -> dt.date:
    return dt.datetime.strptime(ym, "%Y-%m").date()


def read_marks(spark, control_root, layer, key, default: dt.date) -> DataFrame:
    marks = _read_or_empty(spark, f"{control_root}/marks", MARKS_SCHEMA)
    mine = marks.where((F.col("layer") == layer) & (F.col("key") == key)).select("key", "watermark")
    fallback = spark.createDataFrame([(key, default)], "key string, watermark date")
    # one row per key: the stored mark, else the default
    return (fallback.join(mine.withColumnRenamed("watermark", "_stored"), "key", "left")
            .select("key", F.coalesce("_stored", "watermark").alias("watermark")))


def _write_marks(spark, control_root, layer, new_marks: DataFrame) -> None:
    out = new_marks.select(F.lit(layer).alias("layer"), "key", F.col("new_watermark").alias("watermark"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("layer", "key").parquet(f"{control_root}/marks"))


def _append_attempts(spark, control_root, layer, attempted: DataFrame) -> None:
    """Append this run's attempts; ``seq`` continues after the log's largest value.

    A missing input is a SOURCE attempt, a failure of the job a CODE attempt; a
    skipped unit is logged too, as it ends the unit's run of failures.
    """
    attempts = _read_or_empty(spark, f"{control_root}/attempts", ATTEMPTS_SCHEMA)
    base = attempts.where(F.col("layer") == layer).agg(F.max("seq")).first()[0] or 0
    rows = attempted.select(
        F.lit(layer).alias("layer"), "key", "month",
        (F.lit(base + 1) + F.monotonically_increasing_id()).cast("bigint").alias("seq"),
        F.current_timestamp().alias("attempt_ts"),
        F.when(F.col("outcome") == st.MISSING, st.SOURCE).when(F.col("outcome") == st.FAILED, st.CODE)
        .otherwise(F.col("outcome")).alias("outcome"))
    rows.write.mode("append").parquet(f"{control_root}/attempts")


def markers_for(spark, control_root, layer) -> DataFrame:
    """(key, month, state) of every unit with attempts, from the attempt log."""
    attempts = _read_or_empty(spark, f"{control_root}/attempts", ATTEMPTS_SCHEMA).where(F.col("layer") == layer)
    return st.marker_state(attempts.drop("layer"), unit_cols=("key", "month"))


def silver_increment(spark: SparkSession, bronze_root: str, silver_root: str, control_root: str,
                     key: str = "flights", baseline: str = "2020-01", mode: str = st.INCREMENTAL,
                     start: str | None = None, end: str | None = None, fmt: str = "parquet",
                     fail_on_total_failure: bool = True) -> dict:
    """One Silver run for dataset ``key``; returns outcomes, status and marks (DataFrames).

    Attempts, marks and status are stored before a total failure raises.
    """
    base = _month(baseline)
    ym = S.first_of_month()
    # the folder names tell the latest month; no file is opened for it
    months: dict[tuple, list[str]] = {}
    for u in stored_units(spark, bronze_root):
        if u["year"].isdigit() and u["month"].isdigit() and 1 <= int(u["month"]) <= 12:
            months.setdefault((int(u["year"]), int(u["month"])), []).append(unit_folder(bronze_root, u))
    ceiling = F.lit(dt.date(*max(months), 1) if months else None).cast("date")
    marks = read_marks(spark, control_root, "silver", key, (base - dt.timedelta(days=1)).replace(day=1))
    metrics = _read_or_empty(spark, f"{silver_root}/_metrics", METRICS_SCHEMA)
    done = metrics.where(F.col("total_rows") > 0).select(F.lit(key).alias("key"), ym.alias("month"))
    markers = markers_for(spark, control_root, "silver")

    window = st.work_window(marks, ceiling, mode, start, end)
    units = window.withColumn("_src", F.lit("window"))
    escalated = spark.createDataFrame([], "key string, month date")
    if mode == st.INCREMENTAL:
        cal = st.month_calendar(marks.select("key", F.lit(base).alias("start"), F.col("watermark").alias("end")))
        gaps = st.gap_scan(cal, done, markers)
        units = units.unionByName(gaps.where(F.col("action") == "retry").select(
            "key", "month", F.lit("gap").alias("_src")))
        escalated = gaps.where(F.col("action") == "escalated").select("key", "month")
    units = units.dropDuplicates(["key", "month"])
    guarded = st.retryable_units(units, markers, unit_cols=("key", "month"), reprocess=(mode == st.REPROCESS))
    already = done.withColumn("_done", F.lit(True))
    guarded = guarded.join(already, ["key", "month"], "left")
    skip = F.lit(mode == st.INCREMENTAL) & F.coalesce(F.col("_done"), F.lit(False))
    plan = guarded.select("key", "month",
                          F.when(F.col("action") == "blocked", st.FAILED).when(skip, st.SKIPPED)
                          .otherwise("run").alias("step")).checkpoint(eager=True)

    to_run = [(r["month"].year, r["month"].month) for r in
              plan.where(F.col("step") == "run").select("month").distinct().collect()]  # the run's units
    # only these months' files are opened; a month with a file that cannot be read fails alone
    bronze, unreadable = readable_flights(spark, bronze_root, fmt, keep=of_months(to_run))
    produced: list[dict] = []

    def silver(units: list) -> None:
        """One job for the units."""
        produced.extend(run_silver(spark, bronze.where(_in_months(units)), silver_root).units)

    sizes = {u: sum(stored_bytes(spark, f) for f in months.get(u, ())) for u in sorted(to_run) if u not in unreadable}
    broken = set(unreadable)
    for some in batches(sizes, BATCH_BYTES * spark.sparkContext.defaultParallelism):
        broken |= isolate(silver, some)
    done_now = {(u["year"], u["month"]) for u in produced}
    results = [(dt.date(y, m, 1), st.FAILED if (y, m) in broken else st.SUCCESS if (y, m) in done_now else st.MISSING)
               for y, m in to_run]
    ran = plan.where(F.col("step") == "run").select("key", "month").join(
        spark.createDataFrame(results, "month date, outcome string"), "month").select("key", "month", "outcome")
    attempted = ran.unionByName(plan.where(F.col("step") == st.SKIPPED).select("key", "month", F.col("step").alias("outcome")))
    outcomes = (attempted.unionByName(plan.where(F.col("step") == st.FAILED).select("key", "month", F.col("step").alias("outcome")))
                .unionByName(escalated.withColumn("outcome", F.lit(st.FAILED)))).checkpoint(eager=True)
    _append_attempts(spark, control_root, "silver", attempted)
    new_marks = st.contiguous_watermark(marks, outcomes, mode=mode).checkpoint(eager=True)
    status = st.run_status(outcomes, mode=mode, layer="silver", marks=new_marks).checkpoint(eager=True)
    if mode == st.INCREMENTAL:
        _write_marks(spark, control_root, "silver", new_marks)
    written = _read_or_empty(spark, f"{silver_root}/_metrics", METRICS_SCHEMA)
    ran_months = spark.createDataFrame(sorted(done_now), "year int, month int")
    metrics = written.join(ran_months, ["year", "month"], "left_semi")
    good = bronze.where(_in_months(sorted(done_now)))
    if fail_on_total_failure:
        st.raise_on_total_failure(status)
    return {"outcomes": outcomes, "status": status, "marks": new_marks, "metrics": metrics,
            "breakdown": dq.breakdown(good, keys=("year", "month"))}


def _in_months(units: list) -> Column:
    """Literal partition filter of a list of (year, month): folders of other months are
    not opened, so a broken file there does not matter."""
    return reduce(or_, [(F.col("year") == y) & (F.col("month") == m) for y, m in units], F.lit(False))


def isolate(job, units: list) -> set:
    """Run ``job`` over all units at once; on failure over the halves, down to
    the units that fail alone. Returns these (log2 more jobs a bad unit)."""
    if not units:
        return set()
    try:
        job(units)
        return set()
    except Exception as e:  # noqa: BLE001  any failure is the unit's outcome, not the run's end
        if len(units) == 1:
            log.error("unit %s failed: %s", units[0], e)
            return set(units)
        half = len(units) // 2
        return isolate(job, units[:half]) | isolate(job, units[half:])


BUILDS_SCHEMA = "year int, latest_month date, built_at timestamp"


def gold_increment(spark: SparkSession, silver_root: str, gold_root: str, control_root: str,
                   key: str = "flights", mode: str = st.INCREMENTAL, years=None,
                   baseline_year: int | None = None, start_year: str | None = None,
                   end_year: str | None = None, fail_on_total_failure: bool = True) -> dict:
    """One Gold run: rebuild stale (or requested) years in one job, then the trend.

    The year window is ``baseline … ceiling`` (ceiling = latest Silver year;
    baseline defaults to the earliest) or, when reprocessing, the validated
    ``start_year … end_year``, every year of which is rebuilt. Latest months
    come from the Silver manifest. A year of the window without input is
    ``missing`` (a SOURCE attempt), one with a CODE marker ``failed`` unless
    reprocessing. Builds are recorded in an append-only log (year,
    latest_month, built_at); a year's marker is its latest build.
    """
    clean = read_flights(spark, f"{silver_root}/cleaned")
    manifest = _read_or_empty(spark, f"{silver_root}/_metrics", METRICS_SCHEMA).where("clean_rows > 0")
    frontier = st.frontier_by_year(manifest)
    lo, hi = frontier.agg(F.min("year"), F.max("year")).first()  # two scalars
    if hi is None:
        raise RuntimeError("no Silver data: nothing to build")
    first = spark.createDataFrame([(key, int(baseline_year if baseline_year is not None else lo))], "key string, baseline int")
    window = st.year_window(first, F.lit(int(hi)), mode, start_year, end_year or (str(hi) if start_year else None))
    if years is not None:
        window = window.where(F.col("year").isin(list(years)) | F.lit(mode == st.INCREMENTAL))
    builds = _read_or_empty(spark, f"{control_root}/gold_builds", BUILDS_SCHEMA)
    last = builds.groupBy("year").agg(F.max_by("latest_month", "built_at").alias("latest_month"))
    bodies = last.select("year", F.concat(F.lit("latest_silver_month="), S.ym_string(F.col("latest_month")))
                         .alias("body"))
    stale = st.stale_years(frontier, bodies)
    january = F.make_date("year", F.lit(1), F.lit(1))
    units = window.withColumn("month", january)
    guarded = st.retryable_units(units, markers_for(spark, control_root, "gold"), ("key", "month"), mode == st.REPROCESS)
    wanted = F.lit(False) if years is None else F.col("year").isin(list(years))
    step = (F.when(F.col("action") == "blocked", st.FAILED).when(F.col("latest_month").isNull(), st.MISSING)
            .when(F.lit(mode == st.REPROCESS) | F.col("stale") | wanted, "run").otherwise(st.SKIPPED))
    plan = guarded.join(stale, "year", "left").select("key", "year", "month", "latest_month", step.alias("step")).checkpoint(eager=True)
    to_run = sorted(r["year"] for r in plan.where(F.col("step") == "run").select("year").collect())  # a short list of years
    broken = isolate(lambda ys: run_gold(spark, clean, gold_root, years=ys), to_run)
    rebuilt = [y for y in to_run if y not in broken]
    if rebuilt:
        recompute_trend(spark, gold_root)
        (plan.where(F.col("year").isin(rebuilt)).select("year", "latest_month", F.current_timestamp().alias("built_at"))
         .write.mode("append").parquet(f"{control_root}/gold_builds"))
    outcome = (F.when(F.col("step") != "run", F.col("step")).when(F.col("year").isin(sorted(broken)) if broken else F.lit(False), st.FAILED)
               .otherwise(st.SUCCESS))
    outcomes = plan.select("key", "year", "month", "latest_month", "step", outcome.alias("outcome")).checkpoint(eager=True)
    # a blocked year was not attempted
    _append_attempts(spark, control_root, "gold", outcomes.where(F.col("step") != st.FAILED))
    outcomes = outcomes.drop("month", "step")
    marks = read_marks(spark, control_root, "gold", key, dt.date(1900, 1, 1))
    new_marks = st.gold_watermark(marks, outcomes, mode=mode).checkpoint(eager=True)
    status = st.run_status(outcomes, mode=mode, layer="gold", marks=new_marks).checkpoint(eager=True)
    if mode == st.INCREMENTAL:
        _write_marks(spark, control_root, "gold", new_marks)
    if fail_on_total_failure:
        st.raise_on_total_failure(status)
    return {"outcomes": outcomes, "status": status, "marks": new_marks, "rebuilt": rebuilt}
