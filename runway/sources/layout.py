"""Which files of a partitioned layout a scan reads, and what columns each holds.

Months of one layout differ: columns come and go, change their order, case and
type. A scan therefore goes in this order:

1. folder names are listed and filtered by partition, before any file is opened;
2. the files of the folders that are left are looked up in the *schema map*, a
   table beside the data (path, length, modified, schema);
3. files that the map does not know are read for their schema by Spark jobs:
   Parquet footers all in one job (halved where types do not merge), the header
   line of each CSV file by a job that reads no more than that line;
4. files of one schema are read together with that schema declared, and the
   groups are united by column name with the widest of their types.

So the driver opens no file, the plan has one branch a schema and not a file, and
a file that cannot be read is named together with its partition.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.plans.sinks import CSV_NULL, NULL_FOLDER, STAGED, path_exists, pending_units, stored_units, unit_folder

log = logging.getLogger(__name__)

MAP = "_schema_map"  # hidden from scans, as names with an underscore are
MAP_SCHEMA = "path string, length long, modified timestamp, schema string"
THREADS = 16  # small jobs that look up CSV headers at a time
# stands for a quoted empty field while reading, which is a string and no NULL
_QUOTED_EMPTY = "\x01"

Unit = dict  # partition column -> folder value


@dataclass
class Layout:
    """The files of a scan by schema, and the partitions of files that cannot be read."""

    root: str
    fmt: str
    partition_cols: tuple[str, ...]
    groups: dict[tuple[str, str], list[str]] = field(default_factory=dict)  # (schema as JSON, base folder) -> paths
    broken: dict[str, str] = field(default_factory=dict)  # path -> what is wrong
    opened: list[str] = field(default_factory=list)  # files whose schema was read for this scan

    def broken_units(self) -> list[Unit]:
        return [unit_of(p, self.partition_cols) for p in self.broken]


def unit_of(path: str, partition_cols) -> Unit:
    """The partition values in a file's path; a NULL partition is None."""
    parts = dict(x.split("=", 1) for x in path.split("/") if "=" in x)
    return {c: None if parts.get(c) == NULL_FOLDER else parts.get(c) for c in partition_cols}


def _files(spark: SparkSession, folders: list[str], fmt: str) -> list[tuple]:
    """(path, length, modified) of the data files in ``folders``; Spark lists many folders by tasks."""
    if not folders:
        return []
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*" if fmt == "csv" else "*.parquet")
             .option("recursiveFileLookup", True).load(folders)  # no partition columns are inferred
             .select("path", "length", F.col("modificationTime").alias("modified")).where("length > 0"))
    return sorted((r.path, r.length, r.modified) for r in found.collect())  # one row a file, as in any scan's file index


def read_map(spark: SparkSession, root: str) -> dict[tuple, str]:
    """(path, length, modified) -> schema of the files that the stored map knows."""
    path = f"{root.rstrip('/')}/{MAP}"
    if not path_exists(spark, path):
        return {}
    return {(r.path, r.length, r.modified): r.schema for r in spark.read.schema(MAP_SCHEMA).parquet(path).collect()}


def _footers(spark: SparkSession, paths: list[str], found: dict, broken: dict) -> None:
    """Schemas of Parquet files: one job merges the footers of all; where their types
    do not merge, or a footer is broken, the halves are tried."""
    try:
        schema = spark.read.option("mergeSchema", True).parquet(*paths).schema
        found.update(dict.fromkeys(paths, schema.json()))
    except Exception as e:  # noqa: BLE001  whatever is wrong is told of the file it is wrong with
        if len(paths) == 1:
            broken[paths[0]] = f"{type(e).__name__}: {str(e)[:300]}"
            return
        half = len(paths) // 2
        _footers(spark, paths[:half], found, broken)
        _footers(spark, paths[half:], found, broken)


def _headers(spark: SparkSession, paths: list[str], found: dict, broken: dict) -> None:
    """Schemas of CSV files: text columns named by each file's own first line, which
    a small job per file reads."""
    def header(path: str):
        try:
            names = spark.read.option("header", True).csv(path).columns
            names = [c.lstrip("﻿").strip().lower() for c in names]
            return path, T.StructType([T.StructField(c, T.StringType()) for c in names]).json(), None
        except Exception as e:  # noqa: BLE001
            return path, None, f"{type(e).__name__}: {str(e)[:300]}"

    with ThreadPoolExecutor(THREADS) as pool:
        for path, schema, error in pool.map(header, paths):
            if error is None:
                found[path] = schema
            else:
                broken[path] = error


def resolve(spark: SparkSession, root: str, fmt: str = "parquet", partition_cols=("year", "month"),
            keep: Callable[[Unit], bool] | None = None, store: bool = False) -> Layout:
    """The files that a scan of ``root`` reads. ``keep`` decides on a folder by its
    partition values (text, None for a NULL partition) before anything in it is
    opened. ``store`` adds what was looked up to the map beside the data."""
    root = root.rstrip("/")
    layout = Layout(root, fmt, tuple(partition_cols))
    at = {tuple(u.values()): unit_folder(root, u) for u in stored_units(spark, root, partition_cols)}
    at |= pending_units(spark, root)  # replaced units, wherever they are
    if at:
        units = [dict(zip(partition_cols, (None if v == NULL_FOLDER else v for v in values))) for values in at]
        folders = [f for u, f in zip(units, at.values()) if f and (keep is None or keep(u))]
    else:
        folders = [root] if path_exists(spark, root) else []
    files = _files(spark, folders, fmt)
    known = read_map(spark, root)
    found = {f[0]: known[f] for f in files if f in known}
    new = [f for f in files if f not in known]
    if new:
        fresh: dict[str, str] = {}
        (_headers if fmt == "csv" else _footers)(spark, [f[0] for f in new], fresh, layout.broken)
        layout.opened = [f[0] for f in new]
        found |= fresh
        if store and fresh:
            rows = [(*f, fresh[f[0]]) for f in new if f[0] in fresh]
            spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{MAP}")
    for path, what in layout.broken.items():
        log.warning("%s cannot be read: %s", path, what)
    for path, schema in sorted(found.items()):
        # Spark takes partition values below one base folder at a time
        run = path.partition(f"/{STAGED}/")[2].split("/")[0]
        layout.groups.setdefault((schema, f"{root}/{STAGED}/{run}" if run else root), []).append(path)
    return layout


_WIDTH = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider number, timestamp over date, else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _WIDTH and type(b) in _WIDTH:
        x, y = sorted((_WIDTH.index(type(a)), _WIDTH.index(type(b))))
        # a float does not hold every integer
        return T.DoubleType() if y == 4 and x >= 2 else _WIDTH[y]()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(a, (T.DecimalType, *_WIDTH)) and isinstance(b, (T.DecimalType, *_WIDTH)):
        return T.DoubleType()
    return T.StringType()


def merged(schemas: list[T.StructType], declared: T.StructType | None = None) -> dict[str, T.DataType]:
    """Lower-case column names with the declared type, or the widest that the files have."""
    fixed = {f.name.lower(): f.dataType for f in declared.fields} if declared else {}
    out: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            name = f.name.lower()
            out[name] = fixed.get(name) or (widest(out[name], f.dataType) if name in out else f.dataType)
    return out


def _partition_types(layout: Layout, declared: T.StructType | None) -> T.StructType:
    """Partition columns: declared types, else int where all values are numbers."""
    fixed = {f.name.lower(): f.dataType for f in declared.fields} if declared else {}
    units = [unit_of(p, layout.partition_cols) for paths in layout.groups.values() for p in paths]
    kinds = []
    for c in layout.partition_cols:
        number = all(u[c] is None or u[c].lstrip("-").isdigit() for u in units)
        if any(u[c] is not None for u in units):
            kinds.append(T.StructField(c, fixed.get(c) or (T.IntegerType() if number else T.StringType())))
    return T.StructType(kinds)


def load(spark: SparkSession, layout: Layout, declared: T.StructType | None = None, null_value: str = CSV_NULL) -> DataFrame | None:
    """One DataFrame of the layout's files: a branch a schema, united by name. None without files."""
    if not layout.groups:
        return None
    schemas = {text: T.StructType.fromJson(json.loads(text)) for text, _ in layout.groups}
    of = _partition_types(layout, declared)
    own = set(of.names)
    types = {k: v for k, v in merged(list(schemas.values()), declared if layout.fmt != "csv" else None).items() if k not in own}
    out = None
    for (text, base), paths in sorted(layout.groups.items(), key=lambda g: g[1][0]):
        if layout.fmt == "csv":
            data = T.StructType([f for f in schemas[text].fields])
            # a partition column that the file holds as well: the folder's value counts
            shown = T.StructType([T.StructField(f"_in_{f.name}" if f.name in own else f.name, f.dataType) for f in data.fields])
            df = (spark.read.schema(T.StructType(shown.fields + of.fields)).option("header", True).option("enforceSchema", True)
                  .option("mode", "PERMISSIVE").option("nullValue", null_value).option("emptyValue", _QUOTED_EMPTY)
                  .option("basePath", base).csv(paths))
            # only texts tell it from NULL: as a number or date both are NULL
            fixed = {f.name.lower(): f.dataType for f in declared.fields} if declared else {}
            df = df.withColumns({f.name: F.when(F.col(f.name) != _QUOTED_EMPTY, F.col(f.name)).when(
                F.col(f.name).isNotNull(), F.lit("")) for f in shown.fields
                if isinstance(fixed.get(f.name.lower(), T.StringType()), T.StringType)}).drop(*[f"_in_{c}" for c in own])
        else:
            data = T.StructType([f for f in schemas[text].fields if f.name.lower() not in own])
            df = spark.read.schema(T.StructType(data.fields + of.fields)).option("basePath", base).parquet(*paths)
        cols = []
        for f in data.fields:
            name = f.name.lower()
            if name not in own and name in types:
                same = f.dataType == types[name]
                cols.append(F.col(f"`{f.name}`").alias(name) if same else F.col(f"`{f.name}`").try_cast(types[name]).alias(name))
        df = df.select(*cols, *[F.col(c) for c in of.names])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
