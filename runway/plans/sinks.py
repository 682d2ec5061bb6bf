"""Partitioned sinks with replace-on-commit semantics.

``write_partitioned`` goes through Spark's commit protocol with dynamic
partition overwrite. A ``REBALANCE`` hint before each write lets AQE size the
output files per partition and split a skewed partition across tasks instead of
writing one huge file from one task.

``replace_units`` makes the stored partitions of some units equal to a DataFrame,
units without rows included, and survives a stop at any point:

1. ``prepare`` writes the new partitions to a hidden folder of this run and then,
   in one small file, the *intent*: which units are replaced, and which of them
   have rows. From that rename on the replacement is decided;
2. ``settle`` carries an intent out: every unit's old folder goes, the new one is
   moved in, and last the intent is removed. It can be repeated from any state.

A job that stops before the intent has changed nothing; one that stops after it
is completed by the next writer. Readers that resolve the table (``sources.layout``)
follow a pending intent, so they see every replaced unit new, whatever has been
moved. The table's schema is kept beside it, so an empty table can be read.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The NULL token of CSV layouts, for writing and reading alike: an empty field is
# NULL, an empty string is written in quotes.
CSV_NULL = ""


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession):
    """Shuffle files of a write in this context go when it ends, not when the driver happens
    to collect its garbage: the disk holds those of one write at a time. For writes alone, as
    a DataFrame that is run again would have to make its shuffles anew."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def batches(sizes: dict, most: int) -> list[list]:
    """The units of ``sizes`` in their order, in groups of size ``most`` at most; a larger unit is a group alone."""
    out: list[list] = []
    have = 0
    for unit, size in sizes.items():
        if not out or have + size > most:
            out.append([])
            have = 0
        out[-1].append(unit)
        have += size
    return out


def write_partitioned(df: DataFrame, path: str, partition_cols=("year", "month"), fmt: str = "parquet",
                      mode: str = "overwrite", null_value: str = CSV_NULL, compression: str | None = None) -> None:
    """SNK-01/03/04: one job writes every partition; dynamic overwrite replaces only those present."""
    cols = list(partition_cols)
    w = (df.hint("rebalance", *cols).write.mode(mode)
         .option("partitionOverwriteMode", "dynamic").partitionBy(*cols))
    if fmt == "csv":
        w = w.option("header", True).option("nullValue", null_value)
    if compression:
        w = w.option("compression", compression)
    with dropped_shuffles(df.sparkSession):
        w.format(fmt).save(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def stored_units(spark: SparkSession, path: str, partition_cols=("year", "month")) -> list[dict]:
    """The partitions of a table, from its folder names alone (no file is opened)."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/" + "/".join(f"{c}=*" for c in partition_cols))
    out = []
    for status in fs.globStatus(p) or []:
        parts = str(status.getPath()).split("/")[-len(partition_cols):]
        out.append({k: v for k, v in (x.split("=", 1) for x in parts)})
    return out


def unit_folder(path: str, unit: dict) -> str:
    """A partition's folder; Spark names that of a NULL value so."""
    return f"{path.rstrip('/')}/" + "/".join(f"{k}={NULL_FOLDER if v is None else v}" for k, v in unit.items())


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Length of the files in a partition's folder, 0 without one."""
    fs, p = _fs(spark, folder)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def drop_partitions(spark: SparkSession, path: str, specs: list[dict]) -> int:
    """Delete partition folders (e.g. ``{"year": 2024, "month": 5}``) of a table.
    Metadata-only work on the driver; returns folders removed."""
    removed = 0
    for spec in specs:
        fs, p = _fs(spark, unit_folder(path, spec))
        if fs.exists(p):
            fs.delete(p, True)
            removed += 1
    return removed


INTENT, STAGED, SCHEMA = "_intent", "_staged", "_schema.json"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ORPHAN_S = 7 * 86400  # staged runs without an intent are removed when older


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, there as a whole or not at all."""
    fs, p = _fs(spark, path)
    _, part = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _named(unit: dict, cols: list[str]) -> dict:
    """A unit's values as its folder names them."""
    return {c: NULL_FOLDER if unit[c] is None else str(unit[c]) for c in cols}


def stored_schema(spark: SparkSession, path: str) -> str | None:
    """The schema (JSON) that the table's last replacement had."""
    where = f"{path.rstrip('/')}/{SCHEMA}"
    return read_text(spark, where) if path_exists(spark, where) else None


def intents(spark: SparkSession, path: str) -> list[dict]:
    """Replacements that are decided but not carried out, in their order."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{INTENT}/*.json")
    found = sorted(str(s.getPath()) for s in fs.globStatus(p) or [])
    return [json.loads(read_text(spark, f)) | {"file": f} for f in found]


def pending_units(spark: SparkSession, path: str) -> dict[tuple, str | None]:
    """Units under a pending intent -> the folder that holds them now (None: no rows)."""
    out: dict[tuple, str | None] = {}
    for i in intents(spark, path):
        for unit in i["units"]:
            staged = unit_folder(f"{path.rstrip('/')}/{STAGED}/{i['run']}", unit)
            rows = unit in i["produced"]
            out[tuple(unit.values())] = (staged if path_exists(spark, staged) else unit_folder(path, unit)) if rows else None
    return out


def prepare(df: DataFrame, path: str, units: list[dict], partition_cols=("year", "month"), fmt: str = "parquet") -> str:
    """Stage the new partitions of ``units`` and decide their replacement; returns the run's id."""
    spark, cols, root = df.sparkSession, list(partition_cols), path.rstrip("/")
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    staged = f"{root}/{STAGED}/{run}"
    write_partitioned(df, staged, cols, fmt)
    produced = [_named(u, cols) for u in stored_units(spark, staged, cols)]
    replaced = [_named(u, cols) for u in units]
    replaced += [u for u in produced if u not in replaced]
    intent = {"run": run, "units": replaced, "produced": produced, "schema": df.schema.json()}
    write_text(spark, f"{root}/{INTENT}/{run}.json", json.dumps(intent))
    return run


def settle(spark: SparkSession, path: str, at_most: int | None = None) -> int:
    """Carry out every pending intent of a table; returns how many. Folder renames and
    deletes on the driver, one of each a unit; a repeated call finds nothing to do.
    ``at_most`` stops after so many units, as a job may that dies on the way."""
    root = path.rstrip("/")
    todo = intents(spark, root)
    for i in todo:
        for n, unit in enumerate(i["units"]):
            if at_most is not None and n >= at_most:
                return 0
            fs, target = _fs(spark, unit_folder(root, unit))
            _, staged = _fs(spark, unit_folder(f"{root}/{STAGED}/{i['run']}", unit))
            if unit not in i["produced"]:
                fs.delete(target, True)
            elif fs.exists(staged):
                fs.delete(target, True)
                fs.mkdirs(target.getParent())
                if not fs.rename(staged, target):
                    raise OSError(f"cannot move {staged} to {target}")
        write_text(spark, f"{root}/{SCHEMA}", i["schema"])
        for gone in (i["file"], f"{root}/{STAGED}/{i['run']}"):
            fs, p = _fs(spark, gone)
            fs.delete(p, True)
    fs, p = _fs(spark, f"{root}/{STAGED}/*")
    for s in fs.globStatus(p) or []:  # what jobs left that stopped before their intent
        if s.getModificationTime() / 1000 < time.time() - ORPHAN_S:
            fs.delete(s.getPath(), True)
    return len(todo)


def replace_units(df: DataFrame, path: str, units: list[dict], partition_cols=("year", "month"),
                  fmt: str = "parquet") -> None:
    """SNK-02/05: make the output of exactly ``units`` equal to ``df``, also if an
    earlier replacement was cut off: that one is completed first."""
    spark = df.sparkSession
    settle(spark, path)
    prepare(df, path, units, partition_cols, fmt)
    settle(spark, path)
