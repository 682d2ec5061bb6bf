"""What grows with the input: tasks of dealt rows, stored files, shuffled columns."""

from __future__ import annotations

import os
import time
import zipfile

import pytest
from conftest import SF001, canon
from pyspark.sql import functions as F

from runway.operators import dq
from runway.plans import incremental, scenarios, silver, sinks
from runway.session import JOB_CONF
from runway.sources import fixtures as fx
from runway.sources import landing, scans
from runway.sources.schema import FLIGHTS_COLUMNS, conform
from runway.streaming import silver_stream as stream


def test_large_tables_are_dealt_over_more_tasks(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS x")
    dealt = fx.spread(df, rows=10)
    assert dealt.rdd.getNumPartitions() == 101
    assert canon(dealt.collect()) == canon(df.collect())


def test_splits_hold_few_rows():
    assert JOB_CONF["spark.sql.files.maxPartitionBytes"] == "32m"


def test_csv_layout_is_stored_compressed(spark, make_flights, tmp_dir):
    df = make_flights([{"month": 4}, {"month": 5, "deptimeblk": ""}, {"month": 5, "deptimeblk": None}, {"year": 2023}])
    root = os.path.join(tmp_dir, "flights")
    sinks.write_partitioned(df, root, fmt="csv", compression="gzip")
    assert canon(scans.read_flights(spark, root, "csv").collect()) == canon(conform(df).collect())
    bronze = fx.bronze_root(spark, SF001, "csv")
    names = [f for _, _, files in os.walk(bronze) for f in files if f.startswith("part-")]
    assert names and all(f.endswith(".csv.gz") for f in names)


def test_silver_shuffles_no_row_without_a_copy(spark, monkeypatch):
    def wide(*_):
        raise AssertionError("every row shuffled whole")

    want = canon(dq.clean(dq.flag(fx.flights(spark, SF001))).collect())
    for key in [k for k in fx._CACHE if k[1] == f"silver:{SF001}"]:
        monkeypatch.delitem(fx._CACHE, key)
    monkeypatch.setattr(dq, "clean", wide)
    monkeypatch.setattr(fx, "_exists", lambda *_: False)
    monkeypatch.setattr(fx, "_scratch", lambda s, d, name, old=fx._scratch: old(s, d, f"again_{name}"))
    assert canon(fx.silver(spark, SF001).collect()) == want
    monkeypatch.undo()
    for key in [k for k in fx._CACHE if k[1] == f"silver:{SF001}"]:
        del fx._CACHE[key]


def _archive(path, header, lines):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("f.csv", b"\n".join([header.encode(), *lines]) + b"\n")


def test_archive_columns_are_picked_once_a_chunk(monkeypatch, tmp_path):
    _archive(tmp_path / "a.zip", "ORIGIN,Dest,x", [b'AP1,"a, ""b""",1', b',"two\nlines",2', b'"",AP3,3'])

    def by_row(*_):
        raise AssertionError("rows were read one by one")

    monkeypatch.setattr(landing, "_chunks", by_row)
    with open(tmp_path / "a.zip", "rb") as f:
        rows = [r for b in landing._columns(f, ["dest", "origin", "month"]) for r in b.to_pylist()]
    assert [tuple(r.values()) for r in rows] == [('a, "b"', "AP1", None), ("two\nlines", None, None), ("AP3", None, None)]


def test_odd_archives_give_the_rows_of_the_row_reader(spark, tmp_path):
    whole = [b"AP1,C%d" % n for n in range(200_000)]  # more than a block before the first odd row
    for name, odd in {"short": b"AP9", "long": b"AP9,x,y", "text": b"AP\xff,x", "quote": b'A"P,x"', "blank": b"", "cr": b"A\rB,c"}.items():
        _archive(tmp_path / f"{name}.zip", "origin,dest", [*whole, odd, b'AP2,"d,e"'])
    got = landing.read_landing(spark, str(tmp_path)).select("origin", "dest")
    rows = landing.archive_rows(spark, str(tmp_path)).select(F.get("fields", F.lit(0)).alias("origin"), F.get("fields", F.lit(1)).alias("dest"))
    assert got.count() == rows.count() > 6 * 200_000
    assert got.exceptAll(rows).isEmpty() and rows.exceptAll(got).isEmpty()


def test_flight_archives_hold_texts_that_need_quotes(spark, make_flights, tmp_path):
    rows = make_flights([{"month": m, "origincityname": 'Q "x", y', "destcityname": "", "distance": None} for m in (4, 5)])
    fx.write_flight_archives(rows, str(tmp_path))
    back = landing.read_landing(spark, str(tmp_path))
    assert canon(back.collect()) == canon(rows.withColumn("destcityname", F.nullif("destcityname", F.lit(""))).select(back.columns).collect())


class Reached(Exception):
    pass


def test_rows_are_counted_before_any_rule_is_evaluated(spark, make_flights, monkeypatch, tmp_dir):
    def reached(df, path, units, *_):
        raise Reached(units)

    rule = dq.Rule("DQ99", "DQ99: fails", F.raise_error(F.col("origin")).cast("boolean"), "Major")
    monkeypatch.setattr(silver, "replace_units", reached)
    with pytest.raises(Reached) as e:
        silver.run_silver(spark, make_flights([{"month": 4}, {"month": 5}]), tmp_dir, rules=[rule])
    assert sorted(u["month"] for u in e.value.args[0]) == [4, 5]


def test_counts_of_a_run_leave_other_months_out(spark, make_flights, tmp_dir):
    first = make_flights([{"month": 4}, {"month": 4}, {"month": 5, "distance": None}, {"month": None}, {"year": None, "month": 5}])
    silver.run_silver(spark, first, tmp_dir)
    res = silver.run_silver(spark, make_flights([{"month": 5}, {"month": 5, "distance": None}, {"month": 6, "distance": None}]), tmp_dir)
    got = {r["month"]: (r["total_rows"], r["clean_rows"], r["rejected_rows"], r["dupes_removed"]) for r in res.metrics.collect()}
    assert got == {5: (2, 1, 1, 0), 6: (1, 0, 1, 0)}
    every = spark.read.parquet(f"{tmp_dir}/_metrics")
    assert {(r["year"], r["month"]): r["total_rows"] for r in every.collect()} == {
        (2024, 4): 2, (2024, 5): 2, (2024, 6): 1, (2024, None): 1, (None, 5): 1}


def test_stream_looks_its_months_up_once(spark, make_flights, monkeypatch, tmp_dir):
    plans = []
    monkeypatch.setattr(stream, "run_silver", lambda s, raw, *_, **__: plans.append(raw._jdf.queryExecution().optimizedPlan().toString()))
    make_flights([{"month": 4}, {"month": None}]).write.partitionBy("year", "month").parquet(f"{tmp_dir}/bronze")
    stream.silver_stream(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", checkpoint=f"{tmp_dir}/c").awaitTermination()
    assert len(plans) == 1 and "Aggregate" not in plans[0]  # no distinct over the batch's files again


def test_year_outcomes_do_not_build_silver_twice(spark, monkeypatch):
    def again(*_):
        raise Reached

    monkeypatch.setattr(fx, "silver", again)
    monkeypatch.setattr(scenarios, "gold_increment", lambda s, path, *_, baseline_year: {
        "outcomes": scans.read_table(s, f"{path}/cleaned", partition_cols=silver.KEYS).select(
            "year", F.lit(baseline_year).alias("latest_month"), F.lit("x").alias("outcome"))})
    rows = scenarios.gold_year_outcomes(spark, SF001).distinct().collect()
    assert {r["latest_month"] for r in rows} == {min(r["year"] for r in rows) - 2}


def test_only_texts_of_a_csv_tell_a_quoted_empty_field(spark, tmp_path):
    folder = tmp_path / "year=2024" / "month=4"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('origin,dest,distance,deptime,flightdate,note\n"",,"","","",""\nA,B,1.5,7,2024-04-01,n\n')
    df = scans.read_flights(spark, str(tmp_path), "csv")
    got = canon(df.select("origin", "dest", "distance", "deptime", F.col("flightdate").cast("string"), "note").collect())
    assert got == canon([("", None, None, None, None, ""), ("A", "B", 1.5, 7, "2024-04-01", "n")])
    plan = df.select(*FLIGHTS_COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") == 2  # origin and dest


def test_units_come_in_batches():
    assert sinks.batches({}, 5) == []
    assert sinks.batches({"a": 2, "b": 3, "c": 1, "d": 9, "e": 0, "f": 5}, 5) == [["a", "b"], ["c"], ["d"], ["e", "f"]]


def _shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in folders for _, _, names in os.walk(str(top)) for f in names if f.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_dir):
    df = spark.range(1000).selectExpr("id % 3 AS year", "id % 12 AS month", "id")
    before = _shuffle_files(spark)
    held = df.repartition(3, "id").groupBy("month").count()
    held.collect()
    assert _shuffle_files(spark) - before  # those of a query that may be run again stay
    before |= _shuffle_files(spark)
    sinks.write_partitioned(df, f"{tmp_dir}/t")
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:  # they go shortly after
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert held.count() == 12 and spark.read.parquet(f"{tmp_dir}/t").count() == 1000
    assert spark.conf.get(sinks.CLEANUP, "false") == "false"


def test_an_increment_of_many_months_runs_in_parts(spark, monkeypatch):
    want = canon(scenarios.increment_broken_file(spark, SF001).collect())
    runs, writes = [], []
    monkeypatch.setattr(scenarios, "BATCH_ROWS", 200)
    monkeypatch.setattr(incremental, "BATCH_BYTES", 8192)
    monkeypatch.setattr(incremental, "run_silver", lambda *a, old=silver.run_silver: runs.append(1) or old(*a))
    monkeypatch.setattr(scenarios, "write_partitioned", lambda df, path, old=sinks.write_partitioned, **k: writes.append(path) or old(df, path, **k))
    assert canon(scenarios.increment_broken_file(spark, SF001).collect()) == want
    assert len(runs) > 1 and len(writes) > 2
    files = [f for _, _, names in os.walk(writes[0].removeprefix("file:")) for f in names if ".csv" in f and f.startswith("part-")]
    assert len(files) > 12 and all(f.endswith(".csv.gz") for f in files)
