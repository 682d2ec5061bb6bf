"""Gold run: Silver → the seven per-year tables, then the cross-year trend.

Every table is one aggregate job over its own pruned read of Silver (no cache
of all columns), written by ``year`` partition; the years that are rebuilt are
replaced exactly, so a year that yields no rows any more loses its partition.
The trend table is recomputed from the whole stored airline KPI table and
written by ``year`` in a single partitioned write — no per-year loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.operators import gold, rollup
from runway.plans.sinks import replace_units, stored_units
from runway.sources.scans import of_months, read_flights, read_table
from runway.sources.schema import FLIGHTS_SCHEMA, lower_case_columns, schema_guard


def run_gold(spark: SparkSession, silver: DataFrame, out_root: str, years=None,
             tables=None, fmt: str = "parquet") -> list[str]:
    """Write each per-year table for ``years`` (all when None); returns table paths."""
    tables = tables or gold.PER_YEAR_TABLES
    src = schema_guard(lower_case_columns(silver))
    if years is not None:
        src = src.where(F.col("year").isin(list(years)))
    paths = []
    for name, fn in tables.items():
        path = f"{out_root.rstrip('/')}/{name}"
        units = stored_units(spark, path, ("year",)) if years is None else [{"year": y} for y in years]
        replace_units(fn(src), path, units, ("year",), fmt)
        paths.append(path)
    return paths


def recompute_trend(spark: SparkSession, out_root: str, fmt: str = "parquet") -> str:
    """GT-8 over every stored year of ``airline_monthly_kpi``; written by year."""
    root = out_root.rstrip("/")
    kpi_types = gold.airline_monthly_kpi(spark.createDataFrame([], FLIGHTS_SCHEMA)).schema
    kpi = read_table(spark, f"{root}/airline_monthly_kpi", fmt, kpi_types)
    path = f"{root}/monthly_trend"
    replace_units(gold.monthly_trend(kpi), path, stored_units(spark, path, ("year",)), ("year",), fmt)
    return path


def refresh_months(spark: SparkSession, silver_root: str, out_root: str, months, tables=None) -> list[str]:
    """Bring late months into Gold: only their Silver folders are read.

    Every per-year table has the month among its keys, so a year's new partition is
    its stored rows of the other months and the rows of the months computed anew.
    """
    months = sorted(set(months))
    tables = tables or gold.PER_YEAR_TABLES
    src = schema_guard(lower_case_columns(read_flights(spark, f"{silver_root.rstrip('/')}/cleaned", keep=of_months(months))))
    late = spark.createDataFrame(months, "_y int, _m int")
    years = sorted({y for y, _ in months})
    paths = []
    for name, fn in tables.items():
        path = f"{out_root.rstrip('/')}/{name}"
        new = fn(src)
        stored = read_table(spark, path, schema=new.schema).where(F.col("year").isin(years))
        others = stored.join(late, (F.col("year") == F.col("_y")) & (F.col("month") == F.col("_m")), "left_anti")
        replace_units(others.unionByName(new), path, [{"year": y} for y in years], ("year",))
        paths.append(path)
    return paths


def build_states(spark: SparkSession, silver: DataFrame, out_root: str, months=None) -> None:
    """Mergeable KPI states by month (``rollup``); ``months``: those that ``silver`` holds, else all stored."""
    for name, fn in (("kpi_states", rollup.kpi_states), ("delay_histogram", rollup.delay_histogram)):
        path = f"{out_root.rstrip('/')}/{name}"
        units = stored_units(spark, path) if months is None else [{"year": y, "month": m} for y, m in months]
        replace_units(fn(silver), path, units, ("year", "month"))


def rolled_up_kpi(spark: SparkSession, out_root: str, keys) -> DataFrame:
    """GT-1's measures at the grain of ``keys``, merged from the stored month states."""
    parts = [read_table(spark, f"{out_root.rstrip('/')}/{name}", partition_cols=("year", "month")) for name in ("kpi_states", "delay_histogram")]
    return rollup.kpi_from_states(*parts, keys)


def extend_trend(spark: SparkSession, out_root: str, years) -> str:
    """GT-8 for ``years`` (and every stored year after them), each from its own KPI rows and
    the tail that the year before left; earlier years are not read."""
    root = out_root.rstrip("/")
    path, tails = f"{root}/monthly_trend", f"{root}/_trend_tail"
    kpi_schema = gold.airline_monthly_kpi(spark.createDataFrame([], FLIGHTS_SCHEMA)).schema
    stored = sorted(int(u["year"]) for u in stored_units(spark, f"{root}/airline_monthly_kpi", ("year",)) if u["year"].isdigit())
    for year in [y for y in stored if y >= min(years)]:
        kpi = read_table(spark, f"{root}/airline_monthly_kpi", schema=kpi_schema, keep=lambda u, y=year: u["year"] == str(y))
        known = [int(u["after"]) for u in stored_units(spark, tails, ("after",))]
        before = max((y for y in known if y < year), default=None)
        if before is None:
            tail = spark.createDataFrame([], kpi_schema)
        else:
            tail = read_table(spark, tails, schema=kpi_schema, partition_cols=("after",), keep=lambda u, b=before: u["after"] == str(b))
        replace_units(rollup.continued_trend(kpi, tail), path, [{"year": year}], ("year",))
        replace_units(rollup.trend_tail(kpi, tail).withColumn("after", F.lit(year)), tails, [{"after": year}], ("after",))
    return path
