"""Silver run: raw flights → clean / rejected tables + metrics + rule breakdown.

* clean set    = rows without a reason, exact duplicates removed (DQ16)
* rejected set = a narrow filter of the flagged rows (duplicates kept)
* metrics      = per (year, month): rows, clean, rejected, dupes, rate
* breakdown    = firings per rule per (year, month)

Nothing is cached: total rows are counted from the keys alone, before any rule is
evaluated, and the clean and rejected counts come from the footers of the
partitions just written, so the input is read whole by the two writes only. All months of the input run in the same jobs and replace exactly
their own output: a month whose clean or rejected set became empty loses its
old partition. The metrics table (the manifest a gap scan reads) is written
last, after the data commits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.functions.measures import pct
from runway.operators import dq
from runway.plans.sinks import replace_units, write_partitioned
from runway.sources.scans import read_table

KEYS = ("year", "month")


@dataclass
class SilverResult:
    clean_path: str
    rejected_path: str
    metrics_path: str
    metrics: DataFrame
    breakdown: DataFrame
    units: list[dict]


def of_units(rows: DataFrame, units: DataFrame, keys) -> DataFrame:
    """Rows of the given units; a NULL year or month is a unit too."""
    mine = units.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return rows.join(mine, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_semi")


def _folders(units: list[dict]):
    """Folder filter of units that are numbers; other values may be written otherwise in a folder's name."""
    if not all(v is None or isinstance(v, int) for u in units for v in u.values()):
        return None
    wanted = {tuple(None if v is None else str(v) for v in u.values()) for u in units}
    return lambda u: tuple(u.values()) in wanted


def run_silver(spark: SparkSession, raw: DataFrame, out_root: str, rules=None, keys=KEYS,
               fmt: str = "parquet") -> SilverResult:
    out_root = out_root.rstrip("/")
    clean_path, rej_path, met_path = f"{out_root}/cleaned", f"{out_root}/rejected", f"{out_root}/_metrics"
    flagged = dq.flag(raw, rules)
    # one row a unit: the units, which are few, decide what is replaced
    totals = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).collect()
    units = [{k: r[k] for k in keys} for r in totals]
    replace_units(dq.clean(flagged), clean_path, units, keys, fmt)
    replace_units(dq.rejected(flagged), rej_path, units, keys, fmt)
    schema = ", ".join([f"{k} {raw.schema[k].dataType.simpleString()}" for k in keys] + ["rows bigint"])
    per = spark.createDataFrame([tuple(r) for r in totals], schema)
    keep = _folders(units)
    # a table without any row is empty, not missing
    stored = [read_table(spark, path, fmt, raw.schema, keys, keep).select(*keys, F.lit(int(path == clean_path)).alias("_clean"))
              for path in (clean_path, rej_path)]
    found = of_units(stored[0].unionAll(stored[1]), per, keys).groupBy(*keys).agg(
        F.sum("_clean").alias("clean"), F.sum(1 - F.col("_clean")).alias("rejected"))
    n, rejected, kept = F.col("rows"), F.coalesce(F.col("rejected"), F.lit(0)).cast("bigint"), F.coalesce(F.col("clean"), F.lit(0))
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    metrics = per.alias("p").join(found.alias("c"), reduce(and_, same), "left").select(
        *[F.col(f"p.{k}") for k in keys], n.alias("total_rows"), kept.cast("bigint").alias("clean_rows"), rejected.alias("rejected_rows"),
        (n - rejected - kept).cast("bigint").alias("dupes_removed"),
        pct(rejected, F.greatest(n, F.lit(1))).alias("rejection_pct"))
    if units:
        write_partitioned(metrics, met_path, keys, "parquet")
        # what later steps read is the stored table, not the job again
        stored = spark.read.schema(metrics.schema).parquet(met_path)
        metrics = of_units(stored, per, keys).select(*metrics.columns)
    return SilverResult(clean_path, rej_path, met_path, metrics, dq.breakdown(raw, rules, keys=keys), units)
