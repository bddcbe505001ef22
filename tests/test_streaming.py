"""Stream = batch: the same input played through Structured Streaming (availableNow,
far-future sentinel files close every window and fire every timer) must give
the rows of the batch operator."""

import datetime as dt
import itertools
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripstream import operators as op
from tripstream.sources import fixtures as fx
from tripstream.streaming import jobs

_ids = itertools.count()
FAR = dt.datetime(2030, 1, 1)


def stage(spark, df, sentinel_rows, parts=1):
    """Write ``df`` (+ a sentinel file) as parquet files and return a stream over them."""
    d = tempfile.mkdtemp(prefix="ts-stream-")
    if parts == 1:
        df.coalesce(1).write.parquet(os.path.join(d, "a"))
    else:
        col = df.columns[0]
        for i in range(parts):
            df.filter(F.abs(F.hash(col)) % parts == i).coalesce(1).write.parquet(os.path.join(d, f"a{i}"))
    # two sentinel files: the second micro-batch runs with the watermark the first
    # one produced, so every window and timer of the real data closes
    for name in ("y", "z"):
        spark.createDataFrame(sentinel_rows, df.schema).coalesce(1).write.parquet(os.path.join(d, name))
    return (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(d))


def run(stream, mode="append", checkpoint=None):
    name = f"out{next(_ids)}"
    q = (stream.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint or tempfile.mkdtemp(prefix="ts-ckpt-"))
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    return stream.sparkSession.table(name)


def rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def ride_sentinel():
    # a START and an END: filters on isStart may be pushed below the watermark,
    # so each kind needs its own row to move event time forward
    return [(-1, -1, -1, True, FAR, dt.datetime(1970, 1, 1), FAR, -73.99, 40.75, -73.99, 40.75, 1),
            (-1, -1, -1, False, FAR, FAR, FAR, -73.99, 40.75, -73.99, 40.75, 1)]


@pytest.fixture(scope="module")
def rides(spark):
    return fx.rides(spark, SF_SMALL).cache()


@pytest.fixture(scope="module")
def ride_stream(spark, rides):
    return lambda: stage(spark, rides, ride_sentinel())


def test_popular_places(spark, rides, ride_stream):
    got = run(jobs.popular_places_stream(ride_stream(), 3, "4 days", "1 day"))
    got = got.filter(F.col("windowEnd") < F.lit(FAR))
    want = op.popular_places(rides, 3, "4 days", "1 day")
    assert rows(got) == rows(want) and len(rows(want)) > 0


def test_long_rides(spark, rides, ride_stream):
    got = run(jobs.long_rides_stream(ride_stream())).filter("rideId >= 0")
    want = op.long_rides(rides)
    assert rows(got) == rows(want) and len(rows(want)) > 0
    got = run(jobs.long_rides_stream(ride_stream(), strict=True)).filter("rideId >= 0")
    assert rows(got) == rows(op.long_rides_pattern(rides))
    got = run(jobs.long_rides_timer_stream(ride_stream())).filter("rideId >= 0")
    assert rows(got) == rows(want)
    got = run(jobs.long_rides_timer_stream(ride_stream(), strict=True)).filter("rideId >= 0")
    assert rows(got) == rows(op.long_rides_pattern(rides))


def test_end_dated_before_its_start(spark):
    """Such a ride has ended: no alert in batch, in the join form or with timers."""
    from conftest import ride, rides_df
    df = rides_df(spark, [ride(1, True, 60), ride(1, False, 0, 30), ride(2, True, 0), ride(3, True, 0), ride(3, False, 0, 500)])
    want = op.long_rides(df)
    assert sorted(r.rideId for r in want.collect()) == [2, 3]
    for job in (jobs.long_rides_stream, jobs.long_rides_timer_stream):
        got = run(job(stage(spark, df, ride_sentinel()))).filter("rideId >= 0")
        assert rows(got) == rows(want)


def test_long_rides_restart_from_checkpoint(spark, rides):
    """Stop after part of the input, restart on the same checkpoint."""
    d = tempfile.mkdtemp(prefix="ts-restart-")
    ck = tempfile.mkdtemp(prefix="ts-restart-ckpt-")
    schema = rides.schema
    cut = "timestamp '2024-01-15 00:00:00'"   # split by time: nothing in part two is late
    first = rides.filter(f"eventTime < {cut}")
    second = rides.filter(f"eventTime >= {cut}")
    first.coalesce(1).write.parquet(os.path.join(d, "a"))
    out = tempfile.mkdtemp(prefix="ts-restart-out-")
    src = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(d)

    def run_to_files():
        q = (jobs.long_rides_clean_stream(src()).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination(600)

    run_to_files()
    second.coalesce(1).write.parquet(os.path.join(d, "b"))
    spark.createDataFrame(ride_sentinel(), schema).coalesce(1).write.parquet(os.path.join(d, "c"))
    run_to_files()   # same checkpoint: state and offsets are recovered
    got = sorted(r.rideId for r in spark.read.parquet(out).collect() if r.rideId >= 0)
    assert got == sorted(r.rideId for r in op.long_rides_clean(rides).collect())


def test_arrivals_window(spark, rides, ride_stream):
    got = run(jobs.arrivals_window_stream(ride_stream(), "12 hours"))
    assert rows(got) == rows(op.arrivals_window(rides, "12 hours"))


def test_latest_join_and_ttl(spark, rides):
    trades, customers = fx.trades(spark, SF_SMALL), fx.customers(spark, SF_SMALL)
    ts = stage(spark, trades, [(FAR, -1, "t-sentinel")])
    cs = stage(spark, customers, [(FAR, -1, "c-sentinel")])
    got = run(jobs.latest_join_stream(ts, cs)).filter("customerId >= 0")
    assert rows(got) == rows(op.latest_join(trades, customers))
    # by receipt: customers and trades arrive up to an hour after their time
    trades, customers = fx.trades(spark, SF_SMALL, arrival=True), fx.customers(spark, SF_SMALL, arrival=True)
    ts = stage(spark, trades, [tuple(FAR if f.dataType.typeName() == "timestamp" else -1 if f.name == "customerId" else "s"
                                     for f in trades.schema)])
    cs = stage(spark, customers, [tuple(FAR if f.dataType.typeName() == "timestamp" else -1 if f.name == "customerId" else "s"
                                        for f in customers.schema)])
    got = run(jobs.latest_join_stream(ts, cs, "1 hour", arrival="arrivalTime")).filter("customerId >= 0")
    want = op.latest_join(trades, customers, "arrivalTime", delay="1 hour")
    assert rows(got) == rows(want)
    # received in the other order than their times: the last received wins
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    trades = spark.createDataFrame([(at(25), 1, "t", at(50)), (at(26), 1, "early", at(35))],
                                   "eventTime timestamp, customerId long, tradeInfo string, arrivalTime timestamp")
    customers = spark.createDataFrame([(at(10), 1, "a", at(40)), (at(20), 1, "b", at(30))],
                                      "eventTime timestamp, customerId long, customerInfo string, arrivalTime timestamp")
    ts, cs = stage(spark, trades, [(FAR, -1, "s", FAR)]), stage(spark, customers, [(FAR, -1, "s", FAR)])
    got = run(jobs.latest_join_stream(ts, cs, "1 hour", arrival="arrivalTime")).filter("customerId >= 0")
    assert {r["tradeInfo"]: r["customerInfo"] for r in got.collect()} == {"t": "a", "early": "b"}
    trades, customers = fx.trades(spark, SF_SMALL), fx.customers(spark, SF_SMALL)
    # With retention covering the whole input and no reset it equals B2
    qs = [(q, lon, lat, "2023-12-31 00:00:00") for q, lon, lat in fx.LOCATION_QUERIES]
    got = run(jobs.nearest_taxi_ttl_stream(stage(spark, rides, ride_sentinel()), qs,
                                           retention="3650 days", reset="3650 days")).filter("rideId >= 0")
    assert rows(got) == rows(op.nearest_taxi(rides, fx.LOCATION_QUERIES))


def test_hourly_tip_leader(spark):
    fares = fx.fares(spark, SF_SMALL)
    sentinel = [(-1, -1, -1, FAR, "CRD", 0.0, 0.0, 0.0)]
    got = run(jobs.hourly_tip_leader_stream(stage(spark, fares, sentinel), "6 hours"))
    got = got.filter(F.col("windowEnd") < F.lit(FAR))
    assert rows(got) == rows(op.hourly_tip_leader(fares, "6 hours"))


def test_enrich_and_unmatched(spark, rides):
    fares = fx.fares(spark, SF_SMALL)
    r_stream = stage(spark, rides, ride_sentinel())
    f_stream = stage(spark, fares, [(-2, -1, -1, FAR, "CRD", 0.0, 0.0, 0.0)])
    got = run(jobs.enrich_rides_stream(r_stream, f_stream, "1 hour"))
    want = op.enrich_rides(rides, fares)
    assert rows(got) == rows(want)
    r_stream = stage(spark, rides, ride_sentinel())
    f_stream = stage(spark, fares, [(-2, -1, -1, FAR, "CRD", 0.0, 0.0, 0.0)])
    got = run(jobs.unmatched_fares_stream(r_stream, f_stream, "1 hour", every=10)).filter("rideId >= 0")
    assert rows(got) == rows(op.unmatched_fares(rides, fares, every=10))
    r_stream = stage(spark, rides, ride_sentinel())
    f_stream = stage(spark, fares, [(-2, -1, -1, FAR, "CRD", 0.0, 0.0, 0.0)])
    got = run(jobs.unmatched_rides_stream(r_stream, f_stream, "1 hour", every=10)).filter("rideId >= 0")
    assert rows(got) == rows(op.unmatched_rides(rides, fares, every=10))


def test_car_jobs(spark):
    cars = fx.car_events(spark, SF_SMALL).cache()
    sentinel = [("-1", "zz", FAR, 5.0, 0.1)]
    got = run(jobs.driving_sessions_stream(stage(spark, cars, sentinel), "12 hours")).filter("carId != 'zz'")
    assert rows(got) == rows(op.driving_sessions(cars, "12 hours"))
    got = run(jobs.driving_segments_stream(stage(spark, cars, sentinel)))
    assert rows(got) == rows(op.driving_segments(cars))
    got = run(jobs.driving_segments_stream(stage(spark, cars, sentinel), between_stops=True))
    assert rows(got) == rows(op.driving_segments_between_stops(cars))
    got = run(jobs.sort_car_events_stream(stage(spark, cars, sentinel))).filter("carId != 'zz'")
    want = op.sort_car_events(cars).drop("rank")
    assert rows(got) == rows(want)


def test_trade_joins(spark):
    trades, customers = fx.trades(spark, SF_SMALL), fx.customers(spark, SF_SMALL)
    ts = stage(spark, trades, [(FAR, -1, "t-sentinel")])
    cs = stage(spark, customers, [(FAR, -1, "c-sentinel")])
    got = run(jobs.asof_join_stream(ts, cs)).filter("customerId >= 0")
    assert rows(got) == rows(op.asof_join(trades, customers))


def test_keyed_value_state_jobs(spark, rides):
    got = run(jobs.nearest_taxi_stream(stage(spark, rides, ride_sentinel()), fx.LOCATION_QUERIES))
    got = got.filter("rideId >= 0")
    assert rows(got) == rows(op.nearest_taxi(rides, fx.LOCATION_QUERIES))
    got = run(jobs.travel_time_stream(stage(spark, rides, ride_sentinel()))).filter("rideId >= 0")
    assert rows(got) == rows(op.predict_travel_time(rides))
    items = fx.items(spark, SF_SMALL)
    got = run(jobs.match_rules_stream(stage(spark, items, [(-1, "none", 0)]), [("view", "purchase")]))
    assert rows(got) == rows(op.match_rules(items, [("view", "purchase")]))


def test_latest_table_answers_ongoing_and_predicate_queries(spark, rides):
    """B1/B4 streaming: the latest-event table is an update-mode aggregation; queries
    are answered against it like the batch operators."""
    latest = run(jobs.latest_per_taxi_stream(stage(spark, rides, ride_sentinel())), mode="update")
    latest = latest.filter("taxiId >= 0")
    assert rows(latest) == rows(op.latest_per_taxi(rides))
    pe = run(jobs.match_rides_stream(stage(spark, rides, ride_sentinel()), "passengerCnt > 4"))
    assert rows(pe.filter("rideId >= 0")) == rows(op.match_rides(rides, "passengerCnt > 4"))


def test_nearest_with_retention_and_reset(spark):
    """A minimum without improvement for `reset` is forgotten; reports after the
    query's retention are ignored."""
    from conftest import BASE, MUSEUM, STATION, ride, rides_df
    far_point = (-73.90, 40.80)
    rs = [ride(1, False, 0, 10, end=MUSEUM, taxi=1), ride(2, False, 0, 20, end=far_point, taxi=2),
          ride(3, False, 0, 20 + 9 * 60, end=far_point, taxi=3),
          ride(4, False, 0, 13 * 60 + 30, end=STATION, taxi=4)]
    df = rides_df(spark, rs)
    qs = [(5, STATION[0], STATION[1], BASE.strftime("%Y-%m-%d %H:%M:%S"))]
    got = run(jobs.nearest_taxi_ttl_stream(stage(spark, df, ride_sentinel()), qs,
                                           retention="12 hours", reset="8 hours"))
    assert sorted(r.taxiId for r in got.collect() if r.rideId >= 0) == [1, 3]


def test_state_carried_across_micro_batches(spark):
    """Rule matches and running minima that span micro-batches (state read back)."""
    items = fx.items(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="ts-two-")
    items.filter("seq < 500").coalesce(1).write.parquet(os.path.join(d, "a"))
    items.filter("seq >= 500").coalesce(1).write.parquet(os.path.join(d, "b"))
    src_ = (spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(d))
    got = run(jobs.match_rules_stream(src_, [("view", "purchase"), ("click", "click")]))
    assert rows(got) == rows(op.match_rules(items, [("view", "purchase"), ("click", "click")]))


def test_ride_count_and_high_tips(spark, rides):
    got = run(jobs.ride_count_stream(stage(spark, rides, ride_sentinel())), mode="update")
    # update mode: the last update per driver is the final count
    final = got.groupBy("driverId").agg(F.max("cnt").alias("cnt")).filter("driverId >= 0")
    assert rows(final) == rows(op.ride_count(rides))
    fares = fx.fares(spark, SF_SMALL)
    sentinel = [(-1, -1, -1, FAR, "CRD", 0.0, 0.0, 0.0)]
    got = run(jobs.high_tip_hours_stream(stage(spark, fares, sentinel), 5.0, "24 hours"))
    assert rows(got) == rows(op.high_tip_hours(fares, 5.0, "24 hours"))
