"""Partitioned scans of the flights layout ``<root>/year=YYYY/month=M/``.

Every scan resolves the files it needs first (``layout``): folders are pruned by
year and month before anything in them is opened, columns are matched by the
names in each file's own header or footer (any order, any case, columns that
some months lack or have more), and files of one schema are read together. The
result is conformed to the declared schema: no inference job, no type drift.
Column pruning and further filters reach the reader.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.plans.sinks import CSV_NULL, stored_schema
from runway.sources.layout import Layout, load, resolve
from runway.sources.schema import FLIGHTS_SCHEMA, conform

PARTITION_COLS = ("year", "month")


def _int(value: str | None) -> int | None:
    return int(value) if value is not None and value.lstrip("-").isdigit() else None


def of_months(months) -> Callable[[dict], bool]:
    """Folder filter of a set of (year, month); a NULL year or month is None."""
    wanted = set(months)
    return lambda u: tuple(_int(u[c]) for c in PARTITION_COLS) in wanted


class UnreadableFiles(OSError):
    """Files of a scan whose header or footer cannot be read."""


def _loaded(spark: SparkSession, layout: Layout, schema, null_value: str) -> DataFrame:
    df = load(spark, layout, schema, null_value)
    return conform(df, schema) if df is not None else spark.createDataFrame([], schema)


def readable_flights(spark: SparkSession, root: str, fmt: str = "parquet", schema=FLIGHTS_SCHEMA,
                     null_value: str = CSV_NULL, keep=None) -> tuple[DataFrame, set[tuple]]:
    """The flights of every file that can be read, and the (year, month) of those that cannot."""
    layout = resolve(spark, root, fmt, PARTITION_COLS, keep, store=True)
    broken = {tuple(_int(u[c]) for c in PARTITION_COLS) for u in layout.broken_units()}
    return _loaded(spark, layout, schema, null_value), broken


def read_flights(spark: SparkSession, root: str, fmt: str = "parquet", schema=FLIGHTS_SCHEMA,
                 null_value: str = CSV_NULL, keep=None) -> DataFrame:
    """SRC-01: the partitioned flights layout, columns by name, typed by the schema.

    ``keep`` decides on a folder by its partition values (text; None for NULL).
    CSV: ``null_value`` is the NULL token. With the default, which layouts
    written here use too, an empty field is NULL and a quoted empty one is an
    empty string. A file whose header or footer cannot be read raises.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format {fmt!r}")
    layout = resolve(spark, root, fmt, PARTITION_COLS, keep)
    if layout.broken:
        raise UnreadableFiles("; ".join(f"{p}: {what}" for p, what in sorted(layout.broken.items())[:5]))
    return _loaded(spark, layout, schema, null_value)


def scan_month(spark: SparkSession, root: str, year: int, month: int, fmt: str = "parquet",
               null_value: str = CSV_NULL) -> DataFrame:
    """SRC-02: one month of one layout; no file of another month is opened."""
    df = read_flights(spark, root, fmt, null_value=null_value, keep=of_months([(year, month)]))
    return df.where((F.col("year") == year) & (F.col("month") == month))


def scan_year(spark: SparkSession, root: str, year: int, fmt: str = "parquet",
              null_value: str = CSV_NULL) -> DataFrame:
    """SRC-03: all months of one year, from its folders alone."""
    return read_flights(spark, root, fmt, null_value=null_value, keep=lambda u: _int(u["year"]) == year).where(F.col("year") == year)


def read_table(spark: SparkSession, root: str, fmt: str = "parquet", schema: T.StructType | None = None,
               partition_cols=("year",), keep=None) -> DataFrame:
    """SRC-04: every year of a table written by ``year`` partition (no glob needed).

    Columns come by name; years of different types get the widest, or the type
    that ``schema`` declares. CSV tables need a schema. ``keep`` decides on a folder
    by its partition values before anything in it is opened.
    """
    if fmt == "csv" and schema is None:
        raise ValueError("a CSV table is read with its schema")
    layout = resolve(spark, root, fmt, partition_cols, keep)
    if layout.broken:
        raise UnreadableFiles("; ".join(sorted(layout.broken)[:5]))
    df = load(spark, layout, schema)
    if df is None:
        stored = stored_schema(spark, root)
        if schema is None and stored is None:
            raise ValueError(f"{root} holds no files to tell its columns: name the schema")
        return spark.createDataFrame([], schema or T.StructType.fromJson(json.loads(stored)))
    if schema is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def register_views(dfs: dict[str, DataFrame]) -> None:
    """SRC-05: session-scoped SQL names for DataFrames."""
    for name, df in dfs.items():
        df.createOrReplaceTempView(name)
