"""Connected-car operators: per-car event order (O1), gap sessions (T5),
stop-delimited segments (T6, T7) and their statistics (A11, F9).

Every per-car ordered step is split over (car, time bucket) tasks — ranks and
stops through ``keyed_scan``, sessions through ``lag`` per bucket plus a carry
over the per-bucket table — so a car with a large share of all events is never
one task; the statistics are plain grouped aggregates with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.prefix import dealt, duration_bucket, keyed_scan, ordered_parts
from ..plans.util import interval_seconds


def erraticness_desc(x) -> Column:
    """int(x / 2.5): 0 calm, 1 busy, otherwise crazy."""
    c = F.col(x) if isinstance(x, str) else x
    k = (c / 2.5).cast("int")
    return F.when(k == 0, "calm").when(k == 1, "busy").otherwise("crazy")


def segment_stats(events: DataFrame, keys: list, digits: int = 6) -> DataFrame:
    """A11 per group: length, start time, int(max speed), population stddev of
    throttle (erraticness, rounded in the output) and its description, which is
    decided on the exact value."""
    err = F.stddev_pop("throttle")
    return (events.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("length"), F.min("eventTime").alias("startTime"),
                 F.max("speed").cast("int").alias("maxSpeed"), err.alias("erraticness"))
            .withColumns({"erraticness": F.round("erraticness", digits),
                          "erraticnessDesc": erraticness_desc("erraticness")}))


def sort_car_events(events: DataFrame, bucket: str | None = None) -> DataFrame:
    """O1: events of each car in event-time order, with their position ``rank``
    (1-based; ties in time broken by id). Range-partitioned global sort."""
    ranked = keyed_scan(events, ["carId"], ["eventTime", "id"], duration_bucket("eventTime", bucket),
                        {"rank": ("count", F.lit(1))}, inclusive=True)
    return ranked.orderBy("carId", "rank")


def driving_sessions(events: DataFrame, gap: str = "15 seconds", bucket: str | None = None) -> DataFrame:
    """T5: per car, sessions separated by more than ``gap`` without events (two events
    exactly ``gap`` apart share a session), with segment statistics.

    Batch form over ``ordered_parts`` of the events (or time buckets of a given
    length), called buckets here: inside a bucket the previous event comes from ``lag``; the first event of a
    bucket is compared with the last event of the car's previous non-empty bucket
    (a window over the small per-bucket table), which also carries the latest
    session start into later buckets. A busy car is therefore split over its
    buckets. The streaming form uses ``session_window``.
    """
    gap_us = interval_seconds(gap) * 1_000_000
    t = F.col("_t")
    bk = duration_bucket("eventTime", bucket)
    if bk is None:
        events, bk = ordered_parts(events, ["carId"], ["eventTime", "id"]), F.col("_part")
    # car key as (non-null stand-in, null flag) so a null car id is a group of its own
    ev = events.select("carId", "id", "eventTime", "speed", "throttle", bk.alias("_bk"), F.unix_micros("eventTime").alias("_t"),
                       F.coalesce(F.col("carId"), F.lit("")).alias("_kv"), F.col("carId").isNull().alias("_kz"))
    keys = ["_kv", "_kz"]
    ev = dealt(ev, [*keys, "_bk"])
    w = Window.partitionBy(*keys, "_bk").orderBy("_t", "id")
    ev = ev.withColumn("_lag", F.lag("_t").over(w))
    ev = ev.withColumn("_inner", F.when(F.col("_lag").isNotNull() & (t - F.col("_lag") > gap_us), t))
    # of every column, so that both uses of the rows read one exchange
    whole = F.max(F.xxhash64(*ev.columns))
    per_bucket = (ev.groupBy(*keys, "_bk")
                  .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"),
                       F.max("_inner").alias("_lastInner"), whole.alias("_whole")).where("_whole IS NOT NULL"))
    wb = Window.partitionBy(*keys).orderBy("_bk")
    prev_last = F.lag("_last").over(wb)
    per_bucket = per_bucket.withColumn(
        "_firstStarts", prev_last.isNull() | (F.col("_first") - prev_last > gap_us))
    per_bucket = per_bucket.withColumn(
        "_bStart", F.coalesce(F.col("_lastInner"), F.when(F.col("_firstStarts"), F.col("_first"))))
    per_bucket = per_bucket.select(
        *keys, "_bk", "_firstStarts",
        F.last("_bStart", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    j = ev.join(per_bucket, [*keys, "_bk"])
    starts = F.when(F.col("_inner").isNotNull() | (F.col("_lag").isNull() & F.col("_firstStarts")), t)
    j = j.withColumn("_session", F.coalesce(
        F.last(starts, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("_carry")))
    return segment_stats(j, ["carId", "_session"]).drop("_session")


def _with_stops(events: DataFrame, bucket: str | None) -> DataFrame:
    """Each event with the time of the next stop at or after it (``_segEnd``) and of
    the last stop before it (``_prevStop``), in one keyed scan; only events strictly
    before their next stop are kept."""
    stop = F.col("speed") == 0.0
    ev = events.withColumn("_isStop", stop)
    bk = duration_bucket("eventTime", bucket)
    # Stops sort after non-stops of the same instant: looking ahead, an event meets
    # an equal-time stop first, so such events belong to no segment.
    order = ["eventTime", "_isStop", "id"]
    stop_time = F.when(stop, F.col("eventTime"))
    ev = keyed_scan(ev, ["carId"], order, bk,
                    {"_segEnd": ("next", stop_time), "_prevStop": ("last", stop_time)})
    return ev.filter(F.col("eventTime") < F.col("_segEnd"))


def driving_segments(events: DataFrame, bucket: str | None = None) -> DataFrame:
    """Per car, the events strictly before each stop (speed 0) and after the
    previous stop; the leading segment counts, events after the last stop do not."""
    seg = _with_stops(events, bucket)
    return segment_stats(seg, ["carId", "_segEnd"]).withColumnRenamed("_segEnd", "stopTime")


def driving_segments_between_stops(events: DataFrame, bucket: str | None = None) -> DataFrame:
    """Contiguous driving runs with a stop before and after them."""
    seg = _with_stops(events, bucket).filter(F.col("_prevStop").isNotNull())
    return segment_stats(seg, ["carId", "_segEnd"]).withColumnRenamed("_segEnd", "stopTime")
