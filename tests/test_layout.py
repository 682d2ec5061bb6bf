"""Scans over files of different schema, replacement by intent, archives."""

from __future__ import annotations

import gzip
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import canon
from runway.operators import state as st
from runway.plans import sinks
from runway.plans.incremental import silver_increment
from runway.plans.silver import run_silver
from runway.sources import landing, layout, scans
from runway.sources.schema import FLIGHTS_SCHEMA
from runway.streaming.silver_stream import silver_stream


def _parquet(df, root, year, month):
    df.drop("year", "month").coalesce(1).write.mode("append").parquet(f"{root}/year={year}/month={month}")


def test_parquet_months_of_different_columns_and_types(spark, make_flights, tmp_dir):
    root = f"{tmp_dir}/flights"
    _parquet(make_flights([{"month": 1}]).drop("cancellationcode", "distance"), root, 2024, 1)
    _parquet(make_flights([{"month": 2, "cancellationcode": "B", "distance": 7.0}]).withColumnRenamed("origin", "ORIGIN"), root, 2024, 2)
    _parquet(make_flights([{"month": 3}]).withColumn("distance", F.lit(12)).withColumn("remark", F.lit("r")), root, 2024, 3)
    _parquet(make_flights([{"month": 4}]).withColumn("distance", F.lit("x")), root, 2024, 4)
    rows = {r["month"]: r for r in scans.read_flights(spark, root).collect()}
    assert (rows[1]["distance"], rows[1]["cancellationcode"], rows[1]["origin"]) == (None, None, "JFK")
    assert (rows[2]["distance"], rows[2]["cancellationcode"], rows[2]["origin"], rows[2]["remark"]) == (7.0, "B", "JFK", None)
    assert (rows[3]["distance"], rows[3]["remark"], rows[4]["distance"]) == (12.0, "r", None)
    free = scans.read_table(spark, root, partition_cols=("year", "month"))
    assert dict(free.dtypes)["distance"] == "string" and free.count() == 4


def test_plan_has_a_branch_a_schema(spark, make_flights, tmp_dir):
    root = f"{tmp_dir}/flights"
    for m in range(1, 13):
        _parquet(make_flights([{"month": m}]), root, 2024, m)
    found = layout.resolve(spark, root, store=True)
    assert len(found.groups) == 1 and len(found.opened) == 12
    assert layout.resolve(spark, root).opened == []  # the map knows them
    _parquet(make_flights([{"month": 12}]), root, 2024, 12)
    assert len(layout.resolve(spark, root).opened) == 1
    assert scans.read_flights(spark, root).count() == 13


def test_month_scan_opens_its_own_files_only(spark, make_flights, tmp_dir):
    root = f"{tmp_dir}/csv"
    sinks.write_partitioned(make_flights([{"month": m} for m in range(1, 13)] + [{"year": 2023}]), root, fmt="csv")
    found = layout.resolve(spark, root, "csv", keep=scans.of_months([(2024, 5)]))
    assert len(found.opened) == 1 and "year=2024/month=5" in found.opened[0]
    # other months may be broken
    with open(f"{root}/year=2024/month=4/x.csv.gz", "wb") as f:
        f.write(b"no gzip")
    assert scans.scan_month(spark, root, 2024, 5, "csv").count() == 1
    assert scans.scan_year(spark, root, 2023, "csv").count() == 1
    with pytest.raises(scans.UnreadableFiles, match="month=4"):
        scans.read_flights(spark, root, "csv")
    df, broken = scans.readable_flights(spark, root, "csv")
    assert broken == {(2024, 4)} and df.count() == 13


def test_broken_file_fails_its_month_alone(spark, make_flights, tmp_dir):
    root = f"{tmp_dir}/csv"
    df = make_flights([{"month": m} for m in (1, 2, 3)])
    sinks.write_partitioned(df.where("month < 3"), root, fmt="csv")
    sinks.write_partitioned(df.where("month = 3").select(*reversed(df.columns)), root, fmt="csv")
    with open(f"{root}/year=2024/month=2/x.csv.gz", "wb") as f:
        f.write(gzip.compress(b"a,b\n1,2\n")[:9])
    res = silver_increment(spark, root, f"{tmp_dir}/silver", f"{tmp_dir}/control", baseline="2024-01", fmt="csv")
    assert {(r["month"].month, r["outcome"]) for r in res["outcomes"].collect()} == {(1, st.SUCCESS), (2, st.FAILED), (3, st.SUCCESS)}
    clean = scans.read_table(spark, f"{tmp_dir}/silver/cleaned", partition_cols=("year", "month")).collect()
    assert {(r["month"], r["distance"]) for r in clean} == {(1, 2475.0), (3, 2475.0)}


def test_widest():
    assert layout.widest(T.IntegerType(), T.DoubleType()) == T.DoubleType() == layout.widest(T.LongType(), T.FloatType())
    assert layout.widest(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert layout.widest(T.IntegerType(), T.StringType()) == T.StringType() and layout.widest(T.ByteType(), T.LongType()) == T.LongType()


def test_first_delivery_without_clean_rows(spark, make_flights, tmp_dir):
    run_silver(spark, make_flights([{"distance": None}, {"month": 6, "distance": None}]), tmp_dir)
    read = lambda t: scans.read_table(spark, f"{tmp_dir}/{t}", partition_cols=("year", "month"))
    assert read("cleaned").count() == 0 and "distance" in read("cleaned").columns and read("rejected").count() == 2
    run_silver(spark, make_flights([{"month": 6}]), tmp_dir)
    assert read("cleaned").count() == 1 and read("rejected").count() == 1


def test_all_clean_leaves_a_readable_empty_rejected_table(spark, make_flights, tmp_dir):
    run_silver(spark, make_flights([{}]), tmp_dir)
    empty = scans.read_table(spark, f"{tmp_dir}/rejected", partition_cols=("year", "month"))
    assert empty.count() == 0 and "rejection_reason" in empty.columns


@pytest.mark.parametrize("stop", [0, 1, 2, 3])
def test_a_stopped_replacement_is_seen_whole_and_completed(spark, make_flights, tmp_dir, stop):
    path, cols = f"{tmp_dir}/t", ("year", "month")
    units = [{"year": 2024, "month": m} for m in (1, 2, 3)]
    read = lambda: {(r["month"], r["depdelay"]) for r in scans.read_table(spark, path, partition_cols=cols).collect()}
    sinks.replace_units(make_flights([{"month": m, "depdelay": 1.0} for m in (1, 2, 3)]), path, units)
    sinks.prepare(make_flights([{"month": 1, "depdelay": 2.0}, {"month": 3, "depdelay": 2.0}]), path, units)
    want = {(1, 2.0), (3, 2.0)}
    assert read() == want
    sinks.settle(spark, path, at_most=stop)
    assert read() == want
    # the next job completes it, then does its own
    sinks.replace_units(make_flights([{"month": 2, "depdelay": 3.0}]), path, units[1:2])
    assert read() == want | {(2, 3.0)} and sinks.intents(spark, path) == []
    assert {(r["month"], r["depdelay"]) for r in spark.read.parquet(path).collect()} == want | {(2, 3.0)}
    assert sinks.settle(spark, path) == 0


def test_a_job_that_stops_before_its_decision_changes_nothing(spark, make_flights, tmp_dir):
    path = f"{tmp_dir}/t"
    sinks.replace_units(make_flights([{}]), path, [{"year": 2024, "month": 5}])
    sinks.write_partitioned(make_flights([{"depdelay": 9.0}]), f"{path}/{sinks.STAGED}/run")
    assert [r["depdelay"] for r in scans.read_table(spark, path, partition_cols=("year", "month")).collect()] == [0.0]


def test_stream_keeps_rows_without_a_month(spark, make_flights, tmp_dir):
    rows = make_flights([{}, {"year": None}, {"year": None, "distance": None}])
    rows.write.partitionBy("year", "month").parquet(f"{tmp_dir}/bronze")
    silver_stream(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/stream", checkpoint=f"{tmp_dir}/c").awaitTermination()
    run_silver(spark, rows, f"{tmp_dir}/batch")
    for t in ("cleaned", "rejected"):
        a, b = (scans.read_table(spark, f"{tmp_dir}/{x}/{t}", schema=FLIGHTS_SCHEMA, partition_cols=("year", "month")) for x in ("stream", "batch"))
        assert canon(a.collect()) == canon(b.collect()) and (t == "cleaned" or b.count())


def test_archives_stream_through_the_data_source(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(landing, "CHUNK_ROWS", 3)
    os.makedirs(f"{tmp_dir}/a b")
    with zipfile.ZipFile(f"{tmp_dir}/a b/x.zip", "w") as z:
        z.writestr("readme.txt", "no")
        z.writestr("f.CSV", "Year,Month,Origin\n" + "".join(f"2024,{i % 12 + 1},\"A,{i}\"\n" for i in range(20)))
    with open(f"{tmp_dir}/broken.zip", "wb") as f:
        f.write(b"PK nothing")
    rows = landing.read_landing(spark, tmp_dir)
    assert rows.count() == 20 and {r["origin"] for r in rows.collect()} == {f"A,{i}" for i in range(20)}
    assert rows.rdd.getNumPartitions() >= 2  # a partition an archive
    out = {os.path.basename(r["path"]): r["error"] for r in landing.landing_outcomes(spark, tmp_dir).collect()}
    assert out == {"x.zip": None, "broken.zip": "corrupt"}
    again = landing._through_spark(spark, tmp_dir, "*.zip", landing.ROWS)
    assert canon(again.select("row_no", "fields").collect()) == canon(landing.archive_rows(spark, tmp_dir).select("row_no", "fields").collect())
