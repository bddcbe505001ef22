"""Structured Streaming forms of the operators.

Built-in stateful operators (windowed aggregates, session windows, stream-stream
joins) reuse the batch functions unchanged after a watermark; keyed custom state
runs through ``transformWithState`` with the processors of
``tripstream.streaming.processors``. Every function returns a streaming
DataFrame; the caller picks the sink, trigger and checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.geo import direction_angle, direction_bucket, distance_km, to_cell_id
from ..functions.time import travel_minutes
from ..plans.util import interval_seconds
from ..schemas import RIDE_COLUMNS
from .processors import (AsOfJoinProcessor, ChangingSumProcessor, EventSortProcessor, LatestJoinProcessor,
                         LongRidesProcessor, RIDE_STATE, RangeCountProcessor, ResettingMinProcessor,
                         RuleMatchProcessor, RunningCountProcessor, RunningMinProcessor,
                         StopSegmentsProcessor, TravelTimeProcessor)

RIDE_DELAY = "60 seconds"     # bounded out-of-orderness of rides and fares (T11)
CAR_DELAY = "30 seconds"      # car events (T13)

TRADE_OUT = ("eventTime timestamp, customerId long, tradeInfo string, customerTime timestamp, "
             "customerInfo string")


def _ship():
    # the processors travel with the query, no package install on executors
    import sys

    from pyspark import cloudpickle
    for m in ("tripstream.streaming.processors",):
        try:
            cloudpickle.register_pickle_by_value(sys.modules[m])
        except (ValueError, KeyError):
            pass


def with_watermark(df: DataFrame, column: str = "eventTime", delay: str = RIDE_DELAY) -> DataFrame:
    return df.withWatermark(column, delay)


# ---------------------------------------------------------------- built-in operators

def popular_places_stream(rides: DataFrame, threshold: int = 20, size: str = "15 minutes",
                          slide: str = "5 minutes", delay: str = RIDE_DELAY,
                          strict: bool = False) -> DataFrame:
    """T3 (append mode): a window is emitted once the watermark passes its end."""
    return op.popular_places(with_watermark(rides, "eventTime", delay), threshold, size, slide, strict)


def popular_places_from_kafka(spark, servers: str, topic: str, threshold: int = 20,
                              size: str = "15 minutes", slide: str = "5 minutes",
                              delay: str = RIDE_DELAY) -> DataFrame:
    """S10 job: cleansed ride lines from Kafka (earliest offsets) → T3 without P1."""
    from ..sources.rides import rides_from_kafka
    rides = with_watermark(rides_from_kafka(spark, servers, topic), "eventTime", delay)
    return op.popular_places(rides, threshold, size, slide, clean=False)


def clean_rides_to_kafka(spark, path: str, servers: str, topic: str, checkpoint: str):
    """S11 job: ride file stream → P1 → Kafka topic (text lines)."""
    from ..sources.rides import read_rides, rides_to_kafka
    return rides_to_kafka(op.clean_rides(read_rides(spark, path, streaming=True)), servers, topic, checkpoint)


def ride_count_stream(rides: DataFrame) -> DataFrame:
    """A1: running count per driver (update mode)."""
    return op.ride_count(rides)


def hourly_tip_leader_stream(fares: DataFrame, size: str = "1 hour", delay: str = RIDE_DELAY) -> DataFrame:
    """Chained window aggregations in append mode."""
    return op.hourly_tip_leader(with_watermark(fares, "startTime", delay), size)


def high_tip_hours_stream(fares: DataFrame, min_tips: float = 50.0, size: str = "1 hour",
                          delay: str = RIDE_DELAY) -> DataFrame:
    """A8 (append mode)."""
    return op.high_tip_hours(with_watermark(fares, "startTime", delay), min_tips, size)


def _rides_and_fares(rides: DataFrame, fares: DataFrame, delay: str):
    r = with_watermark(op.start_events(rides), "eventTime", delay).alias("r")
    f = with_watermark(fares.select(F.col("rideId").alias("fareRideId"),
                                    F.col("taxiId").alias("fareTaxiId"),
                                    F.col("driverId").alias("fareDriverId"),
                                    F.col("startTime").alias("fareStartTime"),
                                    "paymentType", "tip", "tolls", "totalFare"),
                       "fareStartTime", delay).alias("f")
    return r, f


def _near(retention: str):
    """Same ride, and event times at most ``retention`` apart: the join's state of
    a row expires that long after it."""
    span = F.expr(f"interval {retention}")
    return ((F.col("r.rideId") == F.col("f.fareRideId"))
            & F.col("f.fareStartTime").between(F.col("r.eventTime") - span, F.col("r.eventTime") + span))


def enrich_rides_stream(rides: DataFrame, fares: DataFrame, retention: str, delay: str = RIDE_DELAY) -> DataFrame:
    """Stream-stream inner join. ``retention`` is how far the event times of a
    ride's START and its fare may lie apart; rows that find no partner within it
    are those of ``unmatched_rides_stream`` and ``unmatched_fares_stream``."""
    r, f = _rides_and_fares(rides, fares, delay)
    return r.join(f, _near(retention), "inner").drop("fareRideId")


def unmatched_fares_stream(rides: DataFrame, fares: DataFrame, retention: str, every: int = 1000,
                           delay: str = RIDE_DELAY) -> DataFrame:
    """Fares without a ride within ``retention``, emitted once the watermark has passed."""
    r, f = _rides_and_fares(op.drop_every_nth_ride(rides, every), fares, delay)
    out = f.join(r, _near(retention), "left_outer").filter(F.col("r.rideId").isNull())
    return out.select(F.col("fareRideId").alias("rideId"), F.col("fareTaxiId").alias("taxiId"),
                      F.col("fareDriverId").alias("driverId"), F.col("fareStartTime").alias("startTime"),
                      "paymentType", "tip", "tolls", "totalFare")


def unmatched_rides_stream(rides: DataFrame, fares: DataFrame, retention: str, every: int = 1000,
                           delay: str = RIDE_DELAY) -> DataFrame:
    """START rides without a fare within ``retention``, emitted likewise."""
    r, f = _rides_and_fares(op.drop_every_nth_ride(rides, every), fares, delay)
    out = r.join(f, _near(retention), "left_outer").filter(F.col("f.fareRideId").isNull())
    return out.select(*[F.col(f"r.{c}") for c in RIDE_COLUMNS])


def driving_sessions_stream(events: DataFrame, gap: str = "15 seconds", delay: str = CAR_DELAY) -> DataFrame:
    """T5 with ``session_window`` (append mode)."""
    ev = with_watermark(events, "eventTime", delay)
    return (op.segment_stats(ev, ["carId", F.session_window("eventTime", gap).alias("s")])
            .drop("s"))


def latest_per_taxi_stream(rides: DataFrame) -> DataFrame:
    """A15 as a streaming aggregation (update mode): the upserted latest-event
    table that B1 and B4 answer queries against."""
    return op.latest_per_taxi(rides)


def match_rides_stream(rides: DataFrame, predicate: str, delay: str = RIDE_DELAY) -> DataFrame:
    """B4 for rides arriving after the predicate (the stored-latest part is answered
    with ``operators.match_rides`` on the latest-per-taxi table)."""
    return op.match_rides(rides, predicate, None, delay)


# ---------------------------------------------------------------- transformWithState

def long_rides_stream(rides: DataFrame, limit_minutes: int = 120, strict: bool = False,
                      delay: str = RIDE_DELAY, early: str = "1 day") -> DataFrame:
    """T8 (T10 with ``strict``) as a time-bounded stream-stream left outer join,
    entirely JVM-side: a START is emitted, null-padded, once the watermark shows
    that no END with event time up to start + limit can still arrive. An END dated
    before its START counts as in the batch form if it is at most ``early``
    before it; that bound lets the state of ENDs expire."""
    r = with_watermark(rides, "eventTime", delay)
    starts = r.filter(F.col("isStart")).alias("s")
    ends = r.filter(~F.col("isStart")).select(F.col("rideId").alias("endRideId"),
                                               F.col("eventTime").alias("endAt")).alias("e")
    deadline = F.col("s.eventTime") + F.expr(f"interval {int(limit_minutes)} minutes")
    upper = F.col("e.endAt") < deadline if strict else F.col("e.endAt") <= deadline
    cond = (F.col("s.rideId") == F.col("e.endRideId")) & upper \
        & (F.col("e.endAt") >= F.col("s.eventTime") - F.expr(f"interval {early}"))
    return starts.join(ends, cond, "left_outer").filter(F.col("endRideId").isNull()) \
        .select(*[F.col(f"s.{c}") for c in RIDE_COLUMNS])


def long_rides_timer_stream(rides: DataFrame, limit_minutes: int = 120, strict: bool = False,
                            delay: str = RIDE_DELAY) -> DataFrame:
    """T8/T10 as keyed value state + an event-time timer per ride
    (``transformWithState``); same rows as ``long_rides_stream``."""
    _ship()
    return (with_watermark(rides, "eventTime", delay).groupBy("rideId")
            .transformWithState(LongRidesProcessor(limit_minutes, strict), RIDE_STATE,
                                "Append", "EventTime"))


def long_rides_clean_stream(rides: DataFrame, limit_minutes: int = 120, delay: str = RIDE_DELAY) -> DataFrame:
    """T8 after cleansing; run with a checkpoint location to survive restarts."""
    return long_rides_stream(op.clean_rides(rides), limit_minutes, False, delay)


def _trade_union(trades: DataFrame, customers: DataFrame, arrival: str | None = None) -> DataFrame:
    t = trades.select("eventTime", "customerId", F.col("tradeInfo").alias("info"), F.lit(1).alias("side"),
                      (F.col(arrival) if arrival else F.col("eventTime")).alias("arrival"))
    c = customers.select("eventTime", "customerId", F.col("customerInfo").alias("info"),
                         F.lit(0).alias("side"),
                         (F.col(arrival) if arrival else F.col("eventTime")).alias("arrival"))
    return t.unionByName(c)


def asof_join_stream(trades: DataFrame, customers: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Trades wait for the watermark, then take the newest customer row <= them."""
    _ship()
    return (with_watermark(_trade_union(trades, customers), "eventTime", delay).groupBy("customerId")
            .transformWithState(AsOfJoinProcessor(), TRADE_OUT, "Append", "EventTime"))


def latest_join_stream(trades: DataFrame, customers: DataFrame, delay: str = "0 seconds",
                       arrival: str | None = None) -> DataFrame:
    """Join with the last customer row received; wait for the watermark if none.
    ``arrival``: a timestamp column of both sides with the order of receipt (else
    the event time is taken for it)."""
    _ship()
    proc = LatestJoinProcessor(interval_seconds(delay) * 1_000_000)
    return (with_watermark(_trade_union(trades, customers, arrival), "eventTime", delay).groupBy("customerId")
            .transformWithState(proc, TRADE_OUT, "Append", "EventTime"))


def hourly_tips_changes_stream(fares: DataFrame, size: str = "1 hour", delay: str = RIDE_DELAY,
                               lateness: str = "60 seconds", min_tips: float | None = None,
                               digits: int = 6) -> DataFrame:
    """A9 (A8 with ``min_tips``) as a changelog (T15, T20): a driver's tips of a window come
    out when the window has ended and once more with every batch that brings fares up
    to ``lateness`` after that: the row shown before with ``added`` false, the new one
    with true. ``operators.fold_changes`` gives the table that the changes make.

    Fares are late by their window: one is dropped when its window has ended more than
    ``lateness`` ago, however early in the window it is."""
    _ship()
    late_s = interval_seconds(lateness)
    held = f"{interval_seconds(delay) + late_s} seconds"
    # the event time goes and its window stays: the watermark then counts for the window's end
    f = (with_watermark(fares, "startTime", held)
         .select("driverId", F.col("tip").alias("value"), F.window("startTime", size).alias("w"))
         .withColumn("windowEnd", F.col("w.end")))
    out = (f.groupBy("driverId", "windowEnd")
           .transformWithState(ChangingSumProcessor(late_s * 1000, digits),
                               "windowEnd timestamp, driverId long, tips double, added boolean", "Append", "EventTime"))
    # an old row that never passed is not taken back either
    return out if min_tips is None else out.where(F.col("tips") > min_tips)


def ride_count_changes_stream(rides: DataFrame) -> DataFrame:
    """A1 as a changelog (T20): (driverId, cnt, added)."""
    _ship()
    return (rides.select("driverId", "rideId").groupBy("driverId")
            .transformWithState(RunningCountProcessor(), "driverId long, cnt long, added boolean", "Append", "None"))


CAR_FIELDS = ["id", "carId", "eventTime", "speed", "throttle"]
CAR_STATE = "id string, carId string, eventTime timestamp, speed double, throttle double"


def sort_car_events_stream(events: DataFrame, delay: str = CAR_DELAY) -> DataFrame:
    """O1: per car, events released in event-time order as the watermark passes."""
    _ship()
    return (with_watermark(events.select(*CAR_FIELDS), "eventTime", delay).groupBy("carId")
            .transformWithState(EventSortProcessor(CAR_FIELDS, CAR_STATE), CAR_STATE,
                                "Append", "EventTime"))


SEGMENT_OUT = ("carId string, stopTime timestamp, length long, startTime timestamp, maxSpeed int, "
               "erraticness double, erraticnessDesc string")


def driving_segments_stream(events: DataFrame, delay: str = CAR_DELAY,
                            between_stops: bool = False) -> DataFrame:
    """T6 (T7 with ``between_stops``): segments closed by each stop, fired by
    event-time timers."""
    _ship()
    return (with_watermark(events.select("carId", "eventTime", "speed", "throttle"), "eventTime", delay)
            .groupBy("carId")
            .transformWithState(StopSegmentsProcessor(need_previous_stop=between_stops), SEGMENT_OUT,
                                "Append", "EventTime"))


def arrivals_window_stream(rides: DataFrame, range_: str = "10 minutes", delay: str = RIDE_DELAY) -> DataFrame:
    """Per end cell, END events in the preceding range, once the watermark passes."""
    _ship()
    e = op.end_events(with_watermark(rides, "eventTime", delay)) \
        .select(to_cell_id("endLon", "endLat").alias("cellId"), "eventTime")
    return (e.groupBy("cellId")
            .transformWithState(RangeCountProcessor(interval_seconds(range_) * 1_000_000),
                                "cell string, eventTime timestamp, cnt long", "Append", "EventTime"))


NEAREST_OUT = "queryId long, eventTime timestamp, rideId long, taxiId long, km float"


def nearest_taxi_stream(rides: DataFrame, queries) -> DataFrame:
    """B2: distance reports per query, filtered to new minima by keyed value state."""
    _ship()
    return (op.query_distances(rides, queries).groupBy("queryId")
            .transformWithState(RunningMinProcessor(), NEAREST_OUT, "Append", "None"))


def nearest_taxi_ttl_stream(rides: DataFrame, queries, retention: str = "15 minutes",
                            reset: str = "8 hours", delay: str = RIDE_DELAY, expiry: str = "age") -> DataFrame:
    """Queries (queryId, longitude, latitude, queryTime; a table or a list) are live
    as ``operators.live_queries`` says; a minimum that has not improved for ``reset``
    is forgotten (event-time timers)."""
    _ship()
    live = op.live_queries(rides.sparkSession, queries, retention, expiry)
    at = F.unix_micros("eventTime")
    reports = (op.query_distances(rides, live.select("queryId", "qLon", "qLat"))
               .join(live.select("queryId", "_since", "_till"), "queryId")
               .where((at >= F.col("_since")) & (at < F.col("_till"))).drop("_since", "_till"))
    proc = ResettingMinProcessor(interval_seconds(reset) * 1000)
    return (with_watermark(reports, "eventTime", delay).groupBy("queryId")
            .transformWithState(proc, NEAREST_OUT, "Append", "EventTime"))


def travel_time_stream(rides: DataFrame) -> DataFrame:
    """Per (destination cell, direction) model in keyed value state."""
    _ship()
    r = op.clean_rides(rides).select(
        "rideId", "isStart", "eventTime",
        to_cell_id("endLon", "endLat").alias("cell"),
        direction_bucket(direction_angle("endLon", "endLat", "startLon", "startLat")).alias("direction"),
        distance_km("startLon", "startLat", "endLon", "endLat").alias("distance"),
        travel_minutes("startTime", "endTime").alias("minutes"))
    out = "rideId long, eventTime timestamp, cell int, direction int, predictedMinutes int"
    return r.groupBy("cell", "direction").transformWithState(TravelTimeProcessor(), out, "Append", "None")


def match_rules_stream(items: DataFrame, rules) -> DataFrame:
    """Per color, waiting items in map state keyed by rule name."""
    _ship()
    out = "rule string, color long, firstSeq long, secondSeq long"
    return items.groupBy("color").transformWithState(RuleMatchProcessor(rules), out, "Append", "None")
