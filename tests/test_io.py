"""Sources and sinks: schema guard, CSV/Parquet layouts, pruning, landing archives,
idempotent partition writes, external SQL sets, the Silver/Gold plans and the stream."""

from __future__ import annotations

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import canon
from runway.operators import dq, gold
from runway.plans import sinks, sqlset
from runway.plans.gold import recompute_trend, run_gold
from runway.plans.silver import run_silver
from runway.sources import landing, scans
from runway.sources.schema import FLIGHTS_COLUMNS, conform, schema_guard


def test_schema_guard_adds_typed_nulls(make_flights):
    df = make_flights([{}]).drop("taxiin", "cancellationcode").withColumnRenamed("deptimeblk", "DepTimeBlk")
    g = schema_guard(df)
    types = dict(g.dtypes)
    assert types["taxiin"] == "double" and types["cancellationcode"] == "string"
    assert "deptimeblk" not in types  # present under another case: kept, not duplicated
    assert g.first()["taxiin"] is None


def test_conform_lowercases_and_orders(make_flights):
    df = make_flights([{}]).withColumnRenamed("Origin".lower(), "ORIGIN").withColumn("extra", F.lit(1))
    c = conform(df)
    assert c.columns[:len(FLIGHTS_COLUMNS)] == FLIGHTS_COLUMNS and c.columns[-1] == "extra"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_partitioned_layout_round_trip_and_pruning(spark, make_flights, tmp_dir, fmt):
    rows = [{"month": 4}, {"month": 5, "deptimeblk": ""}, {"month": 5, "deptimeblk": None}, {"year": 2023}]
    df = make_flights(rows)
    root = os.path.join(tmp_dir, "flights")
    sinks.write_partitioned(df, root, ("year", "month"), fmt)
    null = sinks.CSV_NULL if fmt == "csv" else ""
    back = scans.read_flights(spark, root, fmt, null_value=null)
    assert canon(back.collect()) == canon(conform(df).collect())
    may = scans.scan_month(spark, root, 2024, 5, fmt, null_value=null)
    assert sorted("<null>" if r["deptimeblk"] is None else r["deptimeblk"] for r in may.collect()) == ["", "<null>"]
    plan = may._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert scans.scan_year(spark, root, 2024, fmt, null_value=null).count() == 3


def test_dynamic_overwrite_is_idempotent_and_local(spark, make_flights, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    df = make_flights([{"month": 4}, {"month": 5}])
    sinks.write_partitioned(df, root)
    sinks.write_partitioned(df, root)
    first = canon(scans.read_flights(spark, root).collect())
    assert len(first) == 2
    # reprocess May only: April untouched
    sinks.write_partitioned(make_flights([{"month": 5, "dayofmonth": 20}]), root)
    back = {(r["month"], r["dayofmonth"]) for r in scans.read_flights(spark, root).collect()}
    assert back == {(4, 10), (5, 20)}
    # a replaced unit whose new output is empty is dropped explicitly
    sinks.replace_units(make_flights([{"month": 4}]), root, [{"year": 2024, "month": 4}, {"year": 2024, "month": 5}])
    assert {r["month"] for r in scans.read_flights(spark, root).collect()} == {4}


def _zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members:
            zf.writestr(name, data)
    return buf.getvalue()


def test_zipped_landing(spark, make_flights, tmp_dir):
    src = make_flights([{"dayofmonth": d} for d in range(1, 31)])
    csv = src.toPandas().to_csv(index=False)
    header = ",".join(c.upper() if c == "origin" else c for c in FLIGHTS_COLUMNS)
    csv = header + csv[csv.index("\n"):]
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(os.path.join(land, "year=2024", "month=05"))
    os.makedirs(os.path.join(land, "year=2024", "month=06"))
    with open(os.path.join(land, "year=2024", "month=05", "a.zip"), "wb") as f:
        f.write(_zip_bytes([("readme.txt", "x" * 2000), ("flights.CSV", csv)]))
    with open(os.path.join(land, "year=2024", "month=06", "b.zip"), "wb") as f:
        f.write(b"not a zip" * 200)
    out = {os.path.basename(r["path"]): r["outcome"] for r in landing.landing_outcomes(spark, land).collect()}
    assert out == {"a.zip": "success", "b.zip": "missing"}
    rows = landing.read_landing(spark, land)
    assert rows.count() == 30
    assert canon(rows.select("dayofmonth", "origin", "distance").collect()) == \
        canon(src.select("dayofmonth", "origin", "distance").collect())


def test_sql_set_preload_fails_fast(tmp_dir):
    with pytest.raises(RuntimeError):
        sqlset.load_sql_set(["weekday_haul_profile", "no_such_table"])
    with open(os.path.join(tmp_dir, "empty.sql"), "w") as f:
        f.write("  ")
    with pytest.raises(RuntimeError):
        sqlset.load_sql_set(["empty"], tmp_dir)


def test_sql_set_over_a_dataframe(spark, make_flights):
    df = make_flights([{}, {"distance": 100.0}, {"distance": 700.0, "arrdelay": 9.0}, {"distance": 500.0, "cancelled": 1.0},
                       {"distance": None}, {"dayofweek": 6, "reporting_airline": "BB"}])
    rows = {(r["dayofweek"], r["haul"]): r for r in sqlset.run_sql(spark, "weekday_haul_profile", silver=df).collect()}
    assert set(rows) == {(5, "short"), (5, "medium"), (5, "long"), (6, "long")}
    medium = rows[5, "medium"]
    assert (medium["flights"], medium["flown_flights"], medium["worst_arr_delay"], medium["weekday_flights"],
            medium["haul_rank"], medium["contested"]) == (2, 1, 9.0, 4, 1, False)


def test_silver_and_gold_plans(spark, make_flights, tmp_dir):
    rows = [{}, {}, {"month": 6}, {"month": 6, "dest": "JFK"}, {"month": 7, "year": None}]
    raw = make_flights(rows)
    out = os.path.join(tmp_dir, "silver")
    res = run_silver(spark, raw, out)
    clean = scans.read_flights(spark, res.clean_path)
    assert canon(clean.collect()) == canon(dq.clean(dq.flag(raw)).collect())
    rej = spark.read.parquet(res.rejected_path)
    assert rej.count() == 2
    m = {(r["year"], r["month"]): r for r in spark.read.parquet(res.metrics_path).collect()}
    assert m[(2024, 5)]["dupes_removed"] == 1 and m[(2024, 6)]["rejected_rows"] == 1
    # re-run June with no rejected rows: its stale rejected partition goes away
    res2 = run_silver(spark, make_flights([{"month": 6}]), out)
    assert spark.read.parquet(res2.rejected_path).where("month = 6").count() == 0
    gold_root = os.path.join(tmp_dir, "gold")
    clean = scans.read_flights(spark, res2.clean_path)  # fresh listing after the rewrite
    paths = run_gold(spark, clean, gold_root)
    assert len(paths) == 7
    kpi = spark.read.parquet(os.path.join(gold_root, "airline_monthly_kpi"))
    assert kpi.count() == 2
    trend = spark.read.parquet(recompute_trend(spark, gold_root))
    assert trend.count() == 2 and "otp_rank" in trend.columns


def test_silver_stream_matches_batch(spark, make_flights, tmp_dir):
    from runway.streaming.silver_stream import silver_stream

    raw = make_flights([{}, {}, {"month": 6}, {"month": 6, "dest": "JFK"}])
    bronze = os.path.join(tmp_dir, "bronze")
    sinks.write_partitioned(raw, bronze)
    out = os.path.join(tmp_dir, "silver_stream")
    q = silver_stream(spark, bronze, out, checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    clean = scans.read_flights(spark, os.path.join(out, "cleaned"))
    assert canon(clean.collect()) == canon(dq.clean(dq.flag(raw)).collect())


def test_incremental_runs(spark, make_flights, tmp_dir):
    import datetime as dt

    from runway.plans.incremental import gold_increment, silver_increment

    bronze, silver, gold_root, control = (os.path.join(tmp_dir, n) for n in ("bronze", "silver", "gold", "ctl"))
    # Jan, Feb, Apr land; March is missing at first
    sinks.write_partitioned(make_flights([{"month": m} for m in (1, 2, 4)] + [{"month": 2}]), bronze)
    r1 = silver_increment(spark, bronze, silver, control, baseline="2024-01")
    out1 = {r["month"].month: r["outcome"] for r in r1["outcomes"].collect()}
    assert out1 == {1: "success", 2: "success", 3: "missing", 4: "success"}
    assert r1["marks"].first()["new_watermark"] == dt.date(2024, 2, 1)
    assert r1["status"].first()["status"] == "PARTIAL SUCCESS — GAPS PRESENT"
    # March lands; the next run processes March, skips April, and the mark catches up
    sinks.write_partitioned(make_flights([{"month": 3}]), bronze)
    r2 = silver_increment(spark, bronze, silver, control, baseline="2024-01")
    out2 = {r["month"].month: r["outcome"] for r in r2["outcomes"].collect()}
    assert out2 == {3: "success", 4: "skipped"}
    assert r2["marks"].first()["new_watermark"] == dt.date(2024, 4, 1)
    assert r2["status"].first()["status"] == "SUCCESS"
    assert scans.read_flights(spark, os.path.join(silver, "cleaned")).count() == 4
    g1 = gold_increment(spark, silver, gold_root, control)
    assert g1["rebuilt"] == [2024]
    assert g1["marks"].first()["new_watermark"] == dt.date(2024, 4, 1)
    g2 = gold_increment(spark, silver, gold_root, control)
    assert g2["rebuilt"] == [] and g2["status"].first()["status"] == "SUCCESS"
    assert spark.read.parquet(os.path.join(gold_root, "airline_monthly_kpi")).count() == 4


def test_incremental_code_guard(spark, make_flights, tmp_dir):
    import datetime as dt

    from runway.plans.incremental import ATTEMPTS_SCHEMA, silver_increment

    bronze, silver, control = (os.path.join(tmp_dir, n) for n in ("bronze", "silver", "ctl"))
    sinks.write_partitioned(make_flights([{"month": m} for m in (1, 2)]), bronze)
    # an earlier run left a CODE failure on 2024-02
    log = spark.createDataFrame([("silver", "flights", dt.date(2024, 2, 1), 1, dt.datetime(2024, 3, 1), "CODE")],
                                ATTEMPTS_SCHEMA)
    log.write.parquet(os.path.join(control, "attempts"))
    r = silver_increment(spark, bronze, silver, control, baseline="2024-01")
    out = {x["month"].month: x["outcome"] for x in r["outcomes"].collect()}
    assert out == {1: "success", 2: "failed"}  # blocked, not attempted
    assert r["marks"].first()["new_watermark"] == dt.date(2024, 1, 1)
    assert r["status"].first()["status"] == "PARTIAL SUCCESS — GAPS PRESENT"
    rep = silver_increment(spark, bronze, silver, control, baseline="2024-01", mode="reprocess",
                           start="2024-02", end="2024-02")
    assert {x["month"].month: x["outcome"] for x in rep["outcomes"].collect()} == {2: "success"}
    assert rep["status"].first()["status"] == "REPROCESS COMPLETE"


def test_gold_year_window(spark, make_flights, tmp_dir):
    from runway.plans.incremental import gold_increment, silver_increment

    bronze, silver, gold_root, control = (os.path.join(tmp_dir, n) for n in ("bronze", "silver", "gold", "ctl"))
    sinks.write_partitioned(make_flights([{"year": 2023, "month": 12}, {"year": 2024, "month": 1}]), bronze)
    silver_increment(spark, bronze, silver, control, baseline="2023-12")
    g1 = gold_increment(spark, silver, gold_root, control, baseline_year=2024)
    assert g1["rebuilt"] == [2024]  # 2023 lies before the window
    g2 = gold_increment(spark, silver, gold_root, control, mode="reprocess", start_year="2023", end_year="2023")
    assert g2["rebuilt"] == [2023] and g2["status"].first()["status"] == "REPROCESS COMPLETE"
    with pytest.raises(ValueError):
        gold_increment(spark, silver, gold_root, control, mode="reprocess", start_year="2025")
