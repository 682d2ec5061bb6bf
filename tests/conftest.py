from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from runway.session import local_session  # noqa: E402
from runway.sources.schema import FLIGHTS_SCHEMA  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="runway-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="runway-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="runway-test-")


# A valid, operated, on-time flight; tests override what they exercise.
BASE = {
    "year": 2024, "month": 5, "dayofmonth": 10, "dayofweek": 5, "flightdate": dt.date(2024, 5, 10),
    "reporting_airline": "AA", "origin": "JFK", "origincityname": "New York", "originstatename": "NY",
    "dest": "LAX", "destcityname": "Los Angeles", "deststatename": "CA", "deptime": 900, "arrtime": 1200,
    "deptimeblk": "0900-0959", "depdelay": 0.0, "arrdelay": 0.0, "taxiout": 10.0, "taxiin": 5.0,
    "airtime": 300.0, "actualelapsedtime": 330.0, "distance": 2475.0, "cancelled": 0.0, "diverted": 0.0,
    "cancellationcode": None, "carrierdelay": None, "weatherdelay": None, "nasdelay": None,
    "securitydelay": None, "lateaircraftdelay": None,
}


def flights_df(spark, rows):
    full = [{**BASE, **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in FLIGHTS_SCHEMA.fields) for r in full], FLIGHTS_SCHEMA)


@pytest.fixture()
def make_flights(spark):
    return lambda rows: flights_df(spark, rows)


def canon(rows):
    """Order-insensitive, NULL-safe comparison form of collected rows."""
    return sorted((tuple(r) for r in rows), key=repr)
