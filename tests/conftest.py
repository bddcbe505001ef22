import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripstream.schemas import FARE, RIDE  # noqa: E402

BASE = dt.datetime(2020, 1, 1, 12, 0, 0)
STATION = (-73.9947, 40.750626)
MUSEUM = (-73.9776, 40.7614)
POLE = (0.0, 90.0)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="tripstream-tests-")
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def at(minutes=0.0):
    return BASE + dt.timedelta(minutes=minutes)


def ride(ride_id, is_start, start_min, end_min=None, start=STATION, end=STATION,
         taxi=1, driver=1, passengers=1):
    start_t = at(start_min)
    end_t = at(end_min) if end_min is not None else dt.datetime(1970, 1, 1)
    event_t = start_t if is_start else end_t
    return (ride_id, taxi, driver, is_start, start_t, end_t, event_t,
            float(start[0]), float(start[1]), float(end[0]), float(end[1]), passengers)


def rides_df(spark, rows):
    return spark.createDataFrame(rows, RIDE)


def fare(ride_id, minute, tip, driver=1, taxi=1, total=10.0):
    return (ride_id, taxi, driver, at(minute), "CRD", float(tip), 0.0, float(total))


def fares_df(spark, rows):
    return spark.createDataFrame(rows, FARE)


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
