"""The logical ``flights`` relation: explicit schema and the schema guard.

Reads never infer types (inference is a job of its own and drifts between
months); the scan applies ``FLIGHTS_SCHEMA`` and unknown extra columns pass
through. Names are lower case throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_I, _D, _S = T.IntegerType(), T.DoubleType(), T.StringType()

FLIGHTS_SCHEMA = T.StructType([
    T.StructField("year", _I),
    T.StructField("month", _I),
    T.StructField("dayofmonth", _I),
    T.StructField("dayofweek", _I),
    T.StructField("flightdate", T.DateType()),
    T.StructField("reporting_airline", _S),
    T.StructField("origin", _S),
    T.StructField("origincityname", _S),
    T.StructField("originstatename", _S),
    T.StructField("dest", _S),
    T.StructField("destcityname", _S),
    T.StructField("deststatename", _S),
    T.StructField("deptime", _I),
    T.StructField("arrtime", _I),
    T.StructField("deptimeblk", _S),
    T.StructField("depdelay", _D),
    T.StructField("arrdelay", _D),
    T.StructField("taxiout", _D),
    T.StructField("taxiin", _D),
    T.StructField("airtime", _D),
    T.StructField("actualelapsedtime", _D),
    T.StructField("distance", _D),
    T.StructField("cancelled", _D),
    T.StructField("diverted", _D),
    T.StructField("cancellationcode", _S),
    T.StructField("carrierdelay", _D),
    T.StructField("weatherdelay", _D),
    T.StructField("nasdelay", _D),
    T.StructField("securitydelay", _D),
    T.StructField("lateaircraftdelay", _D),
])

FLIGHTS_COLUMNS = [f.name for f in FLIGHTS_SCHEMA.fields]

# The columns that later months may lack and the type each is
# added with (a month without any cancellation, delay-cause or taxi data).
GUARDED_COLUMNS = [
    ("cancellationcode", "string"),
    ("weatherdelay", "double"),
    ("carrierdelay", "double"),
    ("nasdelay", "double"),
    ("securitydelay", "double"),
    ("lateaircraftdelay", "double"),
    ("taxiout", "double"),
    ("taxiin", "double"),
    ("airtime", "double"),
    ("deptimeblk", "string"),
]


def lower_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case (a pure projection, no data pass)."""
    renames = {c: c.lower() for c in df.columns if c != c.lower()}
    return df.withColumnsRenamed(renames) if renames else df


def schema_guard(df: DataFrame, expected=GUARDED_COLUMNS) -> DataFrame:
    """Add each expected column that is missing (case-insensitive) as typed NULL.

    Existing columns keep their position and values; added ones go last.
    Pure metadata work: Catalyst folds the literals, nothing is scanned.
    """
    have = {c.lower() for c in df.columns}
    missing = {name: F.lit(None).cast(typ) for name, typ in expected if name not in have}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: T.StructType = FLIGHTS_SCHEMA) -> DataFrame:
    """Lower-case names, add missing schema columns as NULL, cast to schema types.

    Columns outside the schema pass through after the schema columns.
    ``try_cast`` keeps a bad text value from failing the job under ANSI mode.
    """
    df = lower_case_columns(df)
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)
