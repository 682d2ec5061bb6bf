"""The jobs end to end on the fixture's flights: each scenario runs real writes
under a folder of its own and returns what a reader finds afterwards."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.functions import scalars as S
from runway.operators import dq, gold, rollup, state
from runway.plans.gold import build_states, extend_trend, recompute_trend, refresh_months, rolled_up_kpi, run_gold
from runway.plans.incremental import gold_increment, silver_increment
from runway.plans.silver import KEYS, run_silver
from runway.plans.sinks import batches, prepare, replace_units, settle, stored_units, write_partitioned, write_text
from runway.session import checkpoint_dir
from runway.sources import fixtures as fx
from runway.sources.landing import landing_outcomes, read_landing
from runway.sources.scans import read_flights, read_table, scan_month
from runway.sources.schema import FLIGHTS_COLUMNS, FLIGHTS_SCHEMA, GUARDED_COLUMNS
from runway.streaming.silver_stream import silver_stream

YEAR = 1998  # the year that scenarios build anew (a parameter)
BATCH_ROWS = 2_500_000  # flights a core that one write of a large layout shuffles, some 85 bytes each


def own_rules() -> list[dq.Rule]:
    """Rules with messages that SQL text would have to escape."""
    return [dq.Rule("DQ90", "DQ90: Carrier's \"delay\" > 30, it's late", F.col("carrierdelay") > 30, "Major"),
            dq.Rule("DQ91", "DQ91: dest \\ origin swapped?", F.col("dest") < F.col("origin"), "Logical")]


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/scenario-{name}-{uuid.uuid4().hex}"


def _dated(df: DataFrame) -> DataFrame:
    return df.where("year IS NOT NULL AND month IS NOT NULL")


def _per_month(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("n"))


def _write_csv(raw: DataFrame, rows: dict, path: str) -> None:
    """Flights of some months, of which ``rows`` has the numbers, as gzipped CSV partitions:
    consecutive months at a time, so that the disk holds the shuffle of these alone."""
    at = F.col("year") * 12 + F.col("month")
    for some in batches(dict(sorted(rows.items())), BATCH_ROWS * raw.sparkSession.sparkContext.defaultParallelism):
        (y, m), (to_y, to_m) = some[0], some[-1]
        write_partitioned(raw.where(at.between(y * 12 + m, to_y * 12 + to_m)), path, fmt="csv", compression="gzip")


def custom_rules(raw: DataFrame) -> DataFrame:
    return dq.breakdown(raw, own_rules())


def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two CSV exports of one layout: one in the schema's order, one with its columns
    reversed, renamed to upper case and one column more."""
    root = _folder(spark, "csv")
    raw = _dated(fx.flights(spark, sf_dir))
    write_partitioned(raw.where("month <= 6"), root, fmt="csv")
    parts = {"year", "month"}
    other = raw.where("month > 6").select(
        F.lit("x").alias("REMARK"), *[F.col(c).alias(c if c in parts else c.upper()) for c in reversed(FLIGHTS_COLUMNS)])
    write_partitioned(other, root, fmt="csv")
    return read_flights(spark, root, "csv").select(*FLIGHTS_COLUMNS)


def trend_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark, "gold-csv")
    run_gold(spark, fx.silver(spark, sf_dir), root, tables={"airline_monthly_kpi": gold.airline_monthly_kpi}, fmt="csv")
    path = recompute_trend(spark, root, "csv")
    types = gold.monthly_trend(gold.airline_monthly_kpi(fx.silver(spark, sf_dir))).schema
    return read_table(spark, path, "csv", types)


def silver_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows a month after a year was delivered anew with all its distances lost:
    none of that year's rows is clean any more."""
    root = _folder(spark, "silver")
    raw = fx.flights(spark, sf_dir)
    run_silver(spark, raw, root)
    again = raw.where(F.col("year") == YEAR).withColumn("distance", F.lit(None).cast("double"))
    run_silver(spark, again, root)
    return _per_month(read_table(spark, f"{root}/cleaned", partition_cols=KEYS))


def gold_rebuild_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancellations after a year was rebuilt from a Silver set without any."""
    root = _folder(spark, "gold")
    silver = fx.silver(spark, sf_dir)
    tables = {"cancellation_analysis": gold.cancellation_analysis}
    run_gold(spark, silver, root, tables=tables)
    run_gold(spark, silver.where("cancelled = 0"), root, years=[YEAR], tables=tables)
    out = read_table(spark, f"{root}/cancellation_analysis")
    return out.groupBy(F.col("year").cast("int").alias("year")).agg(F.sum("cancelled_flights").cast("bigint").alias("cancelled"))


def stream_all_months(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Bronze and Silver folders of a stream over every month, a NULL month included,
    when a month's raw rows come as several files and a micro-batch holds only some."""
    bronze, silver = _folder(spark, "bronze"), _folder(spark, "stream-silver")
    raw = fx.flights(spark, sf_dir)
    for part in range(2):
        # a file a month and part, the months dealt over the tasks
        (raw.where(F.pmod(F.xxhash64("origin", "dest"), F.lit(2)) == part).repartition("year", "month")
         .write.mode("append").partitionBy("year", "month").parquet(bronze))
    silver_stream(spark, bronze, silver, checkpoint=_folder(spark, "stream"), max_files_per_trigger=64).awaitTermination()
    return bronze, silver


def stream_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows a month after the stream."""
    _, silver = stream_all_months(spark, sf_dir)
    return _per_month(read_table(spark, f"{silver}/cleaned", partition_cols=KEYS))


def parquet_mixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Parquet layout whose months differ: without the ten guarded columns up to April,
    whole up to August, then with one column more; November's distances are integers."""
    root = _folder(spark, "mixed")
    raw = _dated(fx.flights(spark, sf_dir))
    write_partitioned(raw.where("month <= 4").drop(*[c for c, _ in GUARDED_COLUMNS]), root)
    write_partitioned(raw.where("month BETWEEN 5 AND 8"), root)
    more = raw.where("month > 8").withColumn("Remark", F.concat("origin", F.lit(">"), "dest"))
    write_partitioned(more.where("month <> 11"), root)
    write_partitioned(more.where("month = 11").withColumn("distance", F.col("distance").cast("int")).withColumnRenamed("origin", "ORIGIN"), root)
    return read_flights(spark, root).select(*FLIGHTS_COLUMNS, "remark")


def scan_month_csv(spark: SparkSession, sf_dir: str, month: int) -> DataFrame:
    """One month of a CSV layout."""
    return scan_month(spark, fx.bronze_root(spark, sf_dir, "csv"), YEAR, month, "csv").select(*FLIGHTS_COLUMNS)


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights from monthly archives with two orders of columns."""
    root = _folder(spark, "landing")
    fx.write_flight_archives(_dated(fx.flights(spark, sf_dir)), root)
    return read_landing(spark, root).select(*FLIGHTS_COLUMNS)


def landing_archive_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of one archive a nation: broken ones, some without a CSV, small and large ones."""
    root = _folder(spark, "archives")
    fx.write_nation_archives(fx.table(spark, sf_dir, "nation"), fx.table(spark, sf_dir, "customer"), root)
    out = landing_outcomes(spark, root)
    return out.select(F.regexp_extract("path", r"nation-(\d+)\.zip$", 1).cast("int").alias("nation"), "csv_bytes", "error", "outcome")


def increment_broken_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes and clean rows of an increment over CSV files, one of which is a broken
    archive and others of which order their columns differently."""
    bronze, silver, control = (_folder(spark, f"broken-{x}") for x in ("bronze", "silver", "control"))
    raw = _dated(fx.flights(spark, sf_dir)).where("month <= 12")
    rows = {(r["year"], r["month"]): r["n"] for r in _per_month(raw).collect()}  # one row a month
    _write_csv(raw.where("month > 2"), {u: n for u, n in rows.items() if u[1] > 2}, bronze)
    _write_csv(raw.where("month <= 2").select(*reversed(FLIGHTS_COLUMNS)), {u: n for u, n in rows.items() if u[1] <= 2}, bronze)
    write_text(spark, f"{bronze}/year={YEAR}/month=3/part-9.csv.gz", "no gzip stream")
    first = dt.date(*min(u for u in rows if u[1] >= 1), 1)
    res = silver_increment(spark, bronze, silver, control, baseline=first.strftime("%Y-%m"), fmt="csv")
    clean = read_table(spark, f"{silver}/cleaned", schema=FLIGHTS_SCHEMA, partition_cols=KEYS)
    n = clean.groupBy(S.first_of_month().alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return res["outcomes"].join(n, "month", "left").select("month", "outcome", F.coalesce("n", F.lit(0)).cast("bigint").alias("clean_rows"))


def silver_all_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first delivery without one clean row: outcome and stored rows a month."""
    bronze, silver, control = (_folder(spark, f"rejected-{x}") for x in ("bronze", "silver", "control"))
    raw = _dated(fx.flights(spark, sf_dir)).where("month <= 12")
    write_partitioned(raw.withColumn("distance", F.lit(None).cast("double")), bronze)
    first = raw.agg(F.min(S.first_of_month())).first()[0]
    res = silver_increment(spark, bronze, silver, control, baseline=first.strftime("%Y-%m"))
    stored = [read_table(spark, f"{silver}/{t}", partition_cols=KEYS).select(
        S.first_of_month().alias("month"), F.lit(int(t == "cleaned")).alias("clean")) for t in ("cleaned", "rejected")]
    n = stored[0].unionAll(stored[1]).groupBy("month").agg(
        F.sum("clean").cast("bigint").alias("clean_rows"), F.sum(1 - F.col("clean")).cast("bigint").alias("rejected_rows"))
    return res["outcomes"].join(n, "month", "left").select("month", "outcome", "clean_rows", "rejected_rows")


def silver_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows a month as readers find them when a job that replaces a year stopped
    after its decision and before anything was moved (step 1), when it stopped halfway
    through the months (2), and after the next job has completed it (3)."""
    root = f"{_folder(spark, 'replay')}/cleaned"
    silver = fx.silver(spark, sf_dir)
    months = [{"year": r.year, "month": r.month} for r in silver.select(*KEYS).distinct().collect()]
    replace_units(silver, root, months)
    # of the year delivered anew, half a year is left, without cancellations
    again = silver.where((F.col("year") == YEAR) & (F.col("month") <= 6) & (F.col("cancelled") == 0))
    prepare(again, root, [u for u in months if u["year"] == YEAR])
    steps = []

    def found() -> None:
        rows = _per_month(read_table(spark, root, partition_cols=KEYS))
        steps.append(rows.withColumn("step", F.lit(len(steps) + 1)).checkpoint(eager=True))

    found()
    settle(spark, root, at_most=5)
    found()
    settle(spark, root)
    found()
    return steps[0].unionAll(steps[1]).unionAll(steps[2])


def gold_late_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airline KPI table when one month of Silver came late: Gold was built without
    it, and then refreshed from that month alone."""
    root, base = _folder(spark, "late-gold"), _folder(spark, "late-silver")
    silver = fx.silver(spark, sf_dir)
    late = (F.col("year") == YEAR) & (F.col("month") == 6)
    tables = {"airline_monthly_kpi": gold.airline_monthly_kpi}
    run_gold(spark, silver.where(~late | F.col("year").isNull()), root, tables=tables)
    write_partitioned(silver.where("year IS NOT NULL AND month IS NOT NULL"), f"{base}/cleaned")
    refresh_months(spark, base, root, [(YEAR, 6)], tables)
    return read_table(spark, f"{root}/airline_monthly_kpi")


def airline_year_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GT-1's measures a year and airline, merged from month states, one of which was
    replaced after the others had been written."""
    root = _folder(spark, "states")
    silver = fx.silver(spark, sf_dir)
    late = (F.col("year") == YEAR) & (F.col("month") == 6)
    build_states(spark, silver.where(~late | (F.col("cancelled") == 1) | F.col("year").isNull()), root)
    build_states(spark, silver.where(late), root, months=[(YEAR, 6)])
    return rolled_up_kpi(spark, root, ("year", "reporting_airline"))


def trend_append_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend when the last year is appended to a table of the years before."""
    root = _folder(spark, "trend")
    silver = fx.silver(spark, sf_dir)
    tables = {"airline_monthly_kpi": gold.airline_monthly_kpi}
    last = silver.agg(F.max("year")).first()[0]
    run_gold(spark, silver.where(F.col("year") < last), root, tables=tables)
    first = min(int(u["year"]) for u in stored_units(spark, f"{root}/airline_monthly_kpi", ("year",)))
    extend_trend(spark, root, [first])
    run_gold(spark, silver, root, years=[last], tables=tables)
    return read_table(spark, extend_trend(spark, root, [last]))


def connectivity_rollup(silver: DataFrame) -> DataFrame:
    """Distinct airlines and airports a day, month and year, or-ed from day bitmaps."""
    roles = gold.airport_roles(silver)
    return rollup.connectivity_rollup(rollup.connectivity_bitmaps(
        silver, rollup.numbered(silver, "reporting_airline"), rollup.numbered(roles, "peer_airport")))


def marker_state_resumed(log: DataFrame) -> DataFrame:
    """Marker state from a stored snapshot of the log's first half and the rest."""
    cut = log.agg(F.percentile_approx("seq", 0.5)).first()[0]
    before = state.marker_snapshot(log.where(F.col("seq") <= F.lit(cut))).checkpoint(eager=True)
    return state.marker_of(state.merge_snapshots(before, state.marker_snapshot(log.where(F.col("seq") > F.lit(cut)))))


def _incremented(spark: SparkSession, sf_dir: str) -> tuple[str, str, dict, dict]:
    silver, control = _folder(spark, "inc-silver"), _folder(spark, "inc-control")
    bronze = fx.bronze_root(spark, sf_dir, "parquet")
    first = _dated(fx.flights(spark, sf_dir)).agg(F.min(S.first_of_month())).first()[0]
    before = (first - dt.timedelta(days=62)).strftime("%Y-%m")  # the window starts before the first input
    one = silver_increment(spark, bronze, silver, control, baseline=before)
    two = silver_increment(spark, bronze, silver, control, baseline=before)
    return silver, control, one, two


def increment_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a first run, and of a second one over the same input."""
    _, _, one, two = _incremented(spark, sf_dir)
    return one["outcomes"].select(F.lit(1).alias("run"), "month", "outcome").unionAll(
        two["outcomes"].select(F.lit(2).alias("run"), "month", "outcome"))


def gold_year_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year outcomes of a run whose window starts two years before the input."""
    silver, control = _folder(spark, "years-silver"), _folder(spark, "years-control")
    run_silver(spark, _dated(fx.flights(spark, sf_dir)), silver)
    # the folder names of the Silver set just written tell its first year
    first = read_table(spark, f"{silver}/cleaned", partition_cols=KEYS).agg(F.min("year")).first()[0]
    res = gold_increment(spark, silver, _folder(spark, "years-gold"), control, baseline_year=int(first) - 2)
    return res["outcomes"].select("year", "latest_month", "outcome")


def status_empty(marks: DataFrame) -> DataFrame:
    """Status of a run that had nothing to do."""
    none = marks.select("key", F.lit(None).cast("date").alias("month"), F.lit(state.SUCCESS).alias("outcome")).where("false")
    same = marks.select("key", F.col("watermark").alias("old_watermark"), F.col("watermark").alias("new_watermark"))
    return state.run_status(none, marks=same)
