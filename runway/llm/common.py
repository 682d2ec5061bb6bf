"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.session import checkpoint_dir

# A word: a run of characters other than space and the ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few_tasks(df: DataFrame, rows: int = 20_000) -> int:
    """Tasks for tables in proportion to the stored ``df``, which is counted from its
    files' footers: four a core, and one more each ``rows`` rows."""
    return 4 * df.sparkSession.sparkContext.defaultParallelism + df.count() // rows


def stage(df: DataFrame, tag: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back. ``tasks``: at most so
    many files, where a file a shuffle partition would hold a few rows each.

    Cuts the lineage: what follows re-reads files that every executor can
    reach, so a lost executor costs the re-read of one split. The folder is
    the one the cluster names in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    (df if tasks is None else df.coalesce(tasks)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, rows: int = 2000) -> DataFrame:
    """``df``, whose texts then reach Python ``rows`` at a time (unless the launcher
    named a number): a batch is held by the JVM and by the worker at once, and a
    worker keeps the memory of its largest batch for the stages that follow."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark = df.sparkSession
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(rows))
    return df


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (fold assignment)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def gathered(batches, column: int, size: int, rows: int = 50_000):
    """Tables of about ``size`` bytes of text in ``column``, whatever the size of the
    batches they come in: small batches are put together, large ones cut. A single
    longer text comes alone; at most ``rows`` rows come together."""
    held, have = [], 0
    count = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = min(int(np.searchsorted(ends, before + size - have)) + 1, at + rows - count, batch.num_rows)
            held.append(batch.slice(at, to - at))
            have, count, at = have + int(ends[to - 1]) - before, count + to - at, to
            if have >= size or count >= rows:
                yield pa.Table.from_batches(held)
                held, have, count = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


@functools.lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library: nothing to ask for
        return None


def giving_back(run):
    """``run`` for mapInArrow, after which the worker returns the memory it has freed:
    workers serve stage after stage, and would keep that of their largest."""
    @functools.wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if _trim() is not None:
                _trim()(0)

    return whole
