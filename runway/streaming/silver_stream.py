"""The Silver step as a Structured Streaming job over the raw layout.

A file-source stream over ``<bronze>/year=/month=/`` tracks in its checkpoint
which files it has seen, so each run learns exactly which months changed and
``trigger(availableNow=True)`` processes the backlog and stops. A micro-batch
is only the news of a month: months come as any number of files, and files may
come late. So ``foreachBatch`` takes the distinct (year, month) of its batch,
reads those months whole from the raw layout (by column name, as every scan
does) and replaces their output. A replayed batch does the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runway.plans.silver import KEYS, of_units, run_silver
from runway.plans.sinks import CSV_NULL
from runway.session import checkpoint_dir
from runway.sources.scans import of_months, read_flights
from runway.sources.schema import FLIGHTS_SCHEMA


def silver_stream(spark: SparkSession, bronze_root: str, out_root: str, fmt: str = "parquet",
                  checkpoint: str | None = None, max_files_per_trigger: int | None = None, rules=None,
                  null_value: str = CSV_NULL):
    """Start the stream (availableNow) and return the ``StreamingQuery``."""
    reader = spark.readStream.schema(FLIGHTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    news = reader.option("header", True).csv(bronze_root) if fmt == "csv" else reader.parquet(bronze_root)
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/silver-stream"

    def batch(df: DataFrame, epoch_id: int) -> None:
        # the batch's months, a handful, are looked up once; a file without year or month is the NULL month's
        found = df.select(*KEYS).distinct()
        units = [tuple(r) for r in found.collect()]
        months = df.sparkSession.createDataFrame(units, found.schema)
        raw = read_flights(df.sparkSession, bronze_root, fmt, null_value=null_value, keep=of_months(units))
        run_silver(df.sparkSession, of_units(raw, months, KEYS), out_root, fmt=fmt, rules=rules, keys=KEYS)

    return (news.select(*KEYS).writeStream.foreachBatch(batch).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())
