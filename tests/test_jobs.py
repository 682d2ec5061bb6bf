"""Jobs on awkward input: months of several files, foreign CSVs, broken files, empty runs,
two dataset keys, archives with their own column order."""

from __future__ import annotations

import datetime as dt
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, canon
from runway.operators import dq
from runway.operators import state as st
from runway.plans import scenarios, sinks
from runway.plans.gold import run_gold
from runway.plans.incremental import gold_increment, silver_increment
from runway.plans.silver import run_silver
from runway.session import checkpoint_dir
from runway.sources import fixtures, landing, scans
from runway.streaming.silver_stream import silver_stream


def folders(tmp_dir):
    return [os.path.join(tmp_dir, n) for n in ("bronze", "silver", "gold", "control")]


def test_stream_keeps_every_file_of_a_month(spark, make_flights, tmp_dir):
    bronze, silver, *_ = folders(tmp_dir)
    for k in range(4):
        rows = make_flights([{"month": 4, "origin": f"A{k}{i}"} for i in range(5)])
        rows.coalesce(1).write.mode("append").partitionBy("year", "month").parquet(bronze)
    silver_stream(spark, bronze, silver, checkpoint=os.path.join(tmp_dir, "c"), max_files_per_trigger=1).awaitTermination()
    assert scans.read_flights(spark, f"{silver}/cleaned").count() == 20
    late = make_flights([{"month": 4, "origin": "LATE"}])
    late.write.mode("append").partitionBy("year", "month").parquet(bronze)
    silver_stream(spark, bronze, silver, checkpoint=os.path.join(tmp_dir, "c")).awaitTermination()
    assert scans.read_flights(spark, f"{silver}/cleaned").count() == 21


def test_stream_scenario_feeds_all_years(spark, monkeypatch):
    roots = []
    monkeypatch.setattr(scenarios, "silver_stream", lambda s, bronze, silver, **kw: roots.extend((bronze, silver)) or silver_stream(
        s, bronze, silver, **kw))
    rows = scenarios.stream_multi_file(spark, SF001).collect()
    raw = fixtures.flights(spark, SF001)
    parts = raw.selectExpr("year", "month", "pmod(xxhash64(origin, dest), 2) AS part").distinct()
    files = spark.read.parquet(roots[0]).selectExpr("year", "month", "input_file_name()").distinct()
    assert files.count() == parts.count() > files.select("year", "month").distinct().count()
    months = lambda df: canon(scenarios._per_month(df).collect())
    want = months(fixtures.silver(spark, SF001))
    assert months(scans.read_flights(spark, f"{roots[1]}/cleaned")) == want
    assert canon(rows) == want
    # nothing is lost on the way, rows without a year included
    rejected = scans.read_table(spark, f"{roots[1]}/rejected", partition_cols=("year", "month"))
    assert months(rejected) == months(dq.rejected(dq.flag(raw)))


def test_reprocessed_month_loses_its_old_rows(spark, make_flights, tmp_dir):
    _, silver, gold_root, _ = folders(tmp_dir)
    run_silver(spark, make_flights([{"month": 4}, {"month": 5}, {"month": 5, "distance": None}]), silver)
    res = run_silver(spark, make_flights([{"month": 5, "distance": None}]), silver)
    assert {r["month"] for r in scans.read_flights(spark, f"{silver}/cleaned").collect()} == {4}
    assert [tuple(r) for r in res.metrics.select("total_rows", "clean_rows", "rejected_rows").collect()] == [(1, 0, 1)]
    run_silver(spark, make_flights([{"month": 5}]), silver)
    assert spark.read.parquet(f"{silver}/rejected").count() == 0 if sinks.stored_units(spark, f"{silver}/rejected") else True
    run_gold(spark, make_flights([{"cancelled": 1.0, "arrtime": None}, {"year": 2023, "cancelled": 1.0}]), gold_root)
    run_gold(spark, make_flights([{}]), gold_root, years=[2024])
    years = {int(u["year"]) for u in sinks.stored_units(spark, f"{gold_root}/cancellation_analysis", ("year",))}
    assert years == {2023}


def test_csv_columns_go_by_name(spark, tmp_dir):
    for month, text in ((1, "Distance,Origin,Dest,Reporting_Airline,Extra\n10.5,JFK,LAX,AA,x\n"),
                        (2, "REPORTING_AIRLINE,DEST,ORIGIN\nBB,SFO,\n,\"\",BOS\n")):
        d = os.path.join(tmp_dir, "csv", "year=2024", f"month={month}")
        os.makedirs(d)
        with open(os.path.join(d, "f.csv"), "w", encoding="utf-8") as f:
            f.write(text)
    rows = scans.read_flights(spark, os.path.join(tmp_dir, "csv"), "csv").select(
        "month", "reporting_airline", "origin", "dest", "distance", "extra").collect()
    assert canon(rows) == canon([(1, "AA", "JFK", "LAX", 10.5, "x"), (2, "BB", None, "SFO", None, None),
                                 (2, None, "BOS", "", None, None)])


def test_broken_file_stops_its_own_month_only(spark, make_flights, tmp_dir):
    bronze, silver, _, control = folders(tmp_dir)
    sinks.write_partitioned(make_flights([{"month": m} for m in (4, 5, 6)]), bronze)
    bad = os.path.join(bronze, "year=2024", "month=5")
    for name in os.listdir(bad):
        if name.endswith(".parquet"):
            with open(os.path.join(bad, name), "wb") as f:
                f.write(b"no parquet at all")
    r = silver_increment(spark, bronze, silver, control, baseline="2024-04")
    assert {x["month"].month: x["outcome"] for x in r["outcomes"].collect()} == {4: "success", 5: "failed", 6: "success"}
    log = {x["month"].month: x["outcome"] for x in spark.read.parquet(f"{control}/attempts").collect()}
    assert log == {4: "success", 5: "CODE", 6: "success"}
    assert r["marks"].first()["new_watermark"] == dt.date(2024, 4, 1)
    again = silver_increment(spark, bronze, silver, control, baseline="2024-04")
    assert {x["month"].month: x["outcome"] for x in again["outcomes"].collect()} == {5: "failed", 6: "skipped"}


def test_marks_of_two_keys_and_an_empty_run(spark, make_flights, tmp_dir):
    bronze, silver, _, control = folders(tmp_dir)
    sinks.write_partitioned(make_flights([{"month": 4}]), bronze)
    for key in ("flights", "cargo"):
        silver_increment(spark, bronze, os.path.join(silver, key), control, key=key, baseline="2024-04")
    marks = spark.read.parquet(f"{control}/marks")
    assert {r["key"]: r["watermark"] for r in marks.collect()} == {k: dt.date(2024, 4, 1) for k in ("flights", "cargo")}
    r = silver_increment(spark, bronze, os.path.join(silver, "flights"), control, baseline="2024-04")
    assert [x["status"] for x in r["status"].collect()] == ["NO NEW DATA"] and r["outcomes"].count() == 0


def test_gold_years_without_input_and_total_failure(spark, make_flights, tmp_dir):
    bronze, silver, gold_root, control = folders(tmp_dir)
    sinks.write_partitioned(make_flights([{"month": 4}]), bronze)
    silver_increment(spark, bronze, silver, control, baseline="2024-04")
    r = gold_increment(spark, silver, gold_root, control, baseline_year=2022)
    assert {x["year"]: x["outcome"] for x in r["outcomes"].collect()} == {2022: "missing", 2023: "missing", 2024: "success"}
    assert r["status"].first()["status"] == "PARTIAL SUCCESS — GAPS PRESENT"
    with pytest.raises(RuntimeError, match="TOTAL FAILURE"):
        silver_increment(spark, bronze, os.path.join(tmp_dir, "s2"), os.path.join(tmp_dir, "c2"), mode="reprocess",
                         start="2024-01", end="2024-02", baseline="2024-01")


def test_repeated_months_and_hot_unit(spark):
    marks = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "key string, watermark date")
    months = [(2, "success"), (2, "success"), (3, "missing"), (3, "success"), (4, "skipped")]
    out = spark.createDataFrame([("a", dt.date(2024, m, 1), o) for m, o in months], "key string, month date, outcome string")
    assert st.contiguous_watermark(marks, out).first()["new_watermark"] == dt.date(2024, 4, 1)
    t0 = dt.datetime(2024, 1, 1)
    log = [("hot", n, t0 + dt.timedelta(hours=n), "success" if n == 3000 else "SOURCE") for n in range(3100)]
    log += [("few", n, t0 + dt.timedelta(hours=n), "SOURCE") for n in range(3)]
    df = st.marker_state(spark.createDataFrame(log, "unit string, seq bigint, attempt_ts timestamp, outcome string"))
    rows = {r["unit"]: r for r in df.collect()}
    hot = rows["hot"]
    assert (hot["state"], hot["escalated"], hot["attempts"], hot["first_seen"], hot["escalated_at"]) == (
        "CODE", True, 14, t0 + dt.timedelta(hours=3001), t0 + dt.timedelta(hours=3014))
    assert (rows["few"]["state"], rows["few"]["attempts"]) == ("SOURCE", 3)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_rules_with_quotes_and_without_rules(make_flights):
    df = make_flights([{"distance": 5.0}, {}])
    own = [dq.Rule("R1", "it's 'short' | \"really\"", F.col("distance") < 10, "Major")]
    assert [(r["reason"], r["cnt"]) for r in dq.breakdown(df, own).collect()] == [("it's 'short' | \"really\"", 1)]
    assert dq.breakdown(df, []).count() == 0 and dq.severity_rollup(df, []).count() == 0
    assert dq.rejected(dq.flag(df.withColumn("distance", F.lit(None).cast("double")), [])).count() == 0


def archive(path, text, name="x.CSV"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("readme.txt", "no data")
        z.writestr(name, text)


def test_landing_reads_each_archive_by_its_own_header(spark, tmp_dir):
    archive(os.path.join(tmp_dir, "a.zip"), 'Year,Month,Origin,OriginCityName\n2024,5,JFK,"New York,\nNY"\n')
    archive(os.path.join(tmp_dir, "b.zip"), "ORIGIN,Spare,MONTH,YEAR\r\nLAX,1,6,2024\r\n,2,x,2024\r\n\r\n")
    with open(os.path.join(tmp_dir, "c.zip"), "wb") as f:
        f.write(b"broken")
    archive(os.path.join(tmp_dir, "d.zip"), "", "only.txt")
    rows = landing.read_landing(spark, tmp_dir).select("year", "month", "origin", "origincityname").collect()
    assert canon(rows) == canon([(2024, 5, "JFK", "New York,\nNY"), (2024, 6, "LAX", None), (2024, None, None, None)])
    out = {os.path.basename(r["path"]): (r["outcome"], r["error"]) for r in landing.landing_outcomes(spark, tmp_dir, 10).collect()}
    assert out == {"a.zip": ("success", None), "b.zip": ("success", None), "c.zip": ("missing", "corrupt"), "d.zip": ("missing", "no_csv")}


def test_a_cluster_must_name_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
    assert checkpoint_dir(spark)
