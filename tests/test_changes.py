"""Late updates and changelogs (T15, T20): the fold of the changes is the batch result."""

import datetime as dt
import os
import tempfile

from conftest import SF_SMALL
from test_streaming import FAR, rows, run, stage
from tripstream import operators as op
from tripstream.schemas import FARE
from tripstream.sources import fixtures as fx
from tripstream.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def fare(ride_id, minute, tip, driver=1):
    return (ride_id, 1, driver, T0 + dt.timedelta(minutes=minute), "CRD", float(tip), 0.0, 10.0)


def batches(spark, parts):
    """A stream with one micro-batch per list of rows."""
    d = tempfile.mkdtemp(prefix="ts-parts-")
    for i, part in enumerate(parts):
        path = os.path.join(d, f"p{i:02d}")
        spark.createDataFrame(part, FARE).coalesce(1).write.parquet(path)
        for f in os.listdir(path):           # files come in the order of their times
            os.utime(os.path.join(path, f), (1_700_000_000 + i * 10,) * 2)
    return (spark.readStream.schema(FARE).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(d))


def log(df):
    return [(r.driverId, r.windowEnd.strftime("%H:%M"), r.tips, r.added) for r in df.collect() if r.driverId >= 0]


def test_late_fares_change_what_was_shown(spark):
    parts = [[fare(1, 10, 2.0), fare(2, 20, 3.0)],
             [fare(3, 62, 1.0)],              # the first window has ended
             [fare(4, 50, 4.0)],              # late, within ten minutes: changes it
             [fare(5, 1, 0.5, driver=2)],     # late, a driver not seen, early in the window
             [fare(6, 75, 1.0)],              # the first window is forgotten
             [fare(7, 59, 9.0)],              # too late
             [fare(8, 59, 9.0), fare(9, 600, 0.0, driver=-1)], [fare(10, 601, 0.0, driver=-1)]]
    make = lambda **kw: jobs.hourly_tips_changes_stream(batches(spark, parts), "1 hour", "60 seconds", "10 minutes", **kw)
    got = run(make())
    assert [g for g in log(got) if g[1] == "01:00"] == [
        (1, "01:00", 5.0, True), (1, "01:00", 5.0, False), (1, "01:00", 9.0, True), (2, "01:00", 0.5, True)]
    assert sorted(map(tuple, op.fold_changes(got).select("driverId", "tips").where("driverId > 0").collect())) == [
        (1, 2.0), (1, 9.0), (2, 0.5)]
    # a bar that a late fare lifts the sum over: nothing is taken back that was not shown
    got = [g for g in log(run(make(min_tips=6.0)))]
    assert got == [(1, "01:00", 9.0, True)]


def test_fold_is_the_batch_result(spark):
    fares = fx.fares(spark, SF_SMALL)
    sentinel = [(-1, -1, -1, FAR, "CRD", 0.0, 0.0, 0.0)]
    got = run(jobs.hourly_tips_changes_stream(stage(spark, fares, sentinel), "4 days", lateness="40 days"))
    want = op.hourly_tips(fares, "4 days").select("windowEnd", "driverId", "tips")
    assert rows(op.fold_changes(got).where("driverId >= 0")) == rows(want)
    # all in random order over many batches: with that lateness nothing is lost
    got = run(jobs.hourly_tips_changes_stream(stage(spark, fares, sentinel, parts=3), "4 days", lateness="40 days"))
    assert got.where("NOT added AND driverId >= 0").count() > 0
    assert rows(op.fold_changes(got).where("driverId >= 0")) == rows(want)


def test_running_counts_as_changes(spark):
    rides = fx.rides(spark, SF_SMALL)
    from test_streaming import ride_sentinel
    got = run(jobs.ride_count_changes_stream(stage(spark, rides, ride_sentinel(), parts=3)))
    assert got.where("NOT added").count() > 0
    assert rows(op.fold_changes(got).where("driverId >= 0")) == rows(op.ride_count(rides))


def test_fold_keeps_equal_rows(spark):
    df = spark.createDataFrame([(1, True), (1, True), (2, True), (2, False), (None, True)], "v int, added boolean")
    assert sorted((r.v is None, r.v) for r in op.fold_changes(df).collect()) == [(False, 1), (False, 1), (True, None)]
