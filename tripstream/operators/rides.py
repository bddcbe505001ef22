"""Ride and fare operators: cleansing, popularity windows, counts, joins, tips,
arrival windows, latest state per taxi.

Every function takes and returns DataFrames; the window and aggregate
functions work unchanged on streaming DataFrames (add a watermark first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import cell_center_lat, cell_center_lon, is_in_nyc, to_cell_id
from ..functions.sql import register_sql_functions
from ..functions.time import time_diff_ms, travel_minutes
from ..plans.intervals import stab
from ..plans.prefix import keyed_scan
from ..plans.util import interval_seconds, ts_lit
from ..schemas import RIDE_COLUMNS

# ---------------------------------------------------------------- P1–P3, P6


def clean_rides(rides: DataFrame) -> DataFrame:
    """Rides whose start and end both lie in the city box."""
    return rides.filter(is_in_nyc("startLon", "startLat") & is_in_nyc("endLon", "endLat"))


def start_events(rides: DataFrame) -> DataFrame:
    """START records only."""
    return rides.filter(F.col("isStart"))


def end_events(rides: DataFrame) -> DataFrame:
    return rides.filter(~F.col("isStart"))


def drop_every_nth_ride(rides: DataFrame, n: int = 1000) -> DataFrame:
    """Drop rides whose id is a multiple of ``n`` (creates unmatched fares)."""
    return rides.filter(F.col("rideId") % n != 0)


def event_cell(rides: DataFrame) -> DataFrame:
    """(cell, isStart, eventTime): start cell for START, end cell for END."""
    cell = F.when(F.col("isStart"), to_cell_id("startLon", "startLat")) \
            .otherwise(to_cell_id("endLon", "endLat"))
    return rides.select(cell.alias("cell"), "isStart", "eventTime")


# ---------------------------------------------------------------- T3, T4


def popular_places(rides: DataFrame, threshold: int = 20, size: str = "15 minutes",
                   slide: str = "5 minutes", strict: bool = False, clean: bool = True) -> DataFrame:
    """Sliding-window count of arrivals/departures per grid cell.

    Output (lon, lat, windowEnd, isStart, cnt) for windows with cnt >= threshold
    (> threshold when ``strict``). Partial counts are combined map-side before
    the exchange on (window, cell, isStart). ``clean=False`` skips P1 for input
    that is already cleansed.
    """
    cells = event_cell(clean_rides(rides) if clean else rides)
    counts = (cells.groupBy(F.window("eventTime", size, slide).alias("w"), "cell", "isStart")
              .agg(F.count(F.lit(1)).alias("cnt")))
    keep = F.col("cnt") > threshold if strict else F.col("cnt") >= threshold
    return counts.filter(keep).select(
        cell_center_lon("cell").alias("lon"), cell_center_lat("cell").alias("lat"),
        F.col("w.end").alias("windowEnd"), "isStart", "cnt")


POPULAR_PLACES_SQL = """
WITH places AS (
  SELECT eventTime, isStart, if(isStart, toCellId(startLon, startLat), toCellId(endLon, endLat)) AS cell
  FROM {rides}
  WHERE isInNYC(startLon, startLat) AND isInNYC(endLon, endLat)
)
SELECT first(toCoords(cell).lon) AS lon, first(toCoords(cell).lat) AS lat,
       window.start AS windowStart, window.end AS windowEnd, isStart, count(*) AS cnt
FROM places
GROUP BY window(eventTime, '{size}', '{slide}'), cell, isStart
HAVING cnt > {threshold}
"""


def popular_places_sql(spark: SparkSession, rides: DataFrame, threshold: int = 20,
                       size: str = "15 minutes", slide: str = "5 minutes") -> DataFrame:
    """T4: the same query as SQL text over the registered grid functions; strict
    threshold, reports window start and end."""
    register_sql_functions(spark)
    text = POPULAR_PLACES_SQL.replace("{size}", size).replace("{slide}", slide) \
                             .replace("{threshold}", str(int(threshold)))
    return spark.sql(text, rides=rides)


# ---------------------------------------------------------------- A1


def ride_count(rides: DataFrame) -> DataFrame:
    """A1: number of ride events per driver (START and END both count)."""
    return rides.groupBy("driverId").agg(F.count(F.lit(1)).alias("cnt"))


# ---------------------------------------------------------------- J1, J2, J5

_FARE_RENAMES = {"taxiId": "fareTaxiId", "driverId": "fareDriverId", "startTime": "fareStartTime"}


def enrich_rides(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """Each START ride paired with the fare of the same ride id."""
    f = fares.select("rideId", *[F.col(k).alias(v) for k, v in _FARE_RENAMES.items()],
                     "paymentType", "tip", "tolls", "totalFare")
    return start_events(rides).join(f, "rideId", "inner")


def _expiring_rides(rides: DataFrame, every: int) -> DataFrame:
    return drop_every_nth_ride(start_events(rides), every)


def unmatched_fares(rides: DataFrame, fares: DataFrame, every: int = 1000) -> DataFrame:
    """Fares whose ride START never arrives (rides thinned by P3)."""
    return fares.join(_expiring_rides(rides, every).select("rideId"), "rideId", "left_anti")


def unmatched_rides(rides: DataFrame, fares: DataFrame, every: int = 1000) -> DataFrame:
    """START rides (thinned by P3) whose fare never arrives."""
    return _expiring_rides(rides, every).join(fares.select("rideId"), "rideId", "left_anti")


FARES_IN_CITY_SQL = """
WITH in_city AS (
  SELECT rideId FROM {rides}
  WHERE isInNYC(startLon, startLat) AND isInNYC(endLon, endLat)
)
SELECT rideId, driverId, totalFare FROM {fares} JOIN in_city USING (rideId)
"""


def fares_in_city(spark: SparkSession, rides: DataFrame, fares: DataFrame) -> DataFrame:
    """SQL join of every ride event with its fare, rides inside the city only.
    The SQL functions are inlined, so the city predicate is pushed below the join."""
    register_sql_functions(spark)
    return spark.sql(FARES_IN_CITY_SQL, rides=rides, fares=fares)


def fares_in_city_of(catalog) -> DataFrame:
    """J5 over the tables ``TaxiRides`` and ``TaxiFares`` of a catalog schema."""
    register_sql_functions(catalog.spark)
    return catalog.sql(FARES_IN_CITY_SQL.format(rides=catalog.view_name("TaxiRides"), fares=catalog.view_name("TaxiFares")))


# ---------------------------------------------------------------- A8–A10, T1, T2


def hourly_tips(fares: DataFrame, size: str = "1 hour", digits: int = 6) -> DataFrame:
    """Tip sum per driver and tumbling window → (w, windowEnd, driverId, tips)."""
    return (fares.groupBy(F.window("startTime", size).alias("w"), "driverId")
            .agg(F.round(F.sum("tip"), digits).alias("tips"))
            .select("w", F.col("w.end").alias("windowEnd"), "driverId", "tips"))


def hourly_tip_leader(fares: DataFrame, size: str = "1 hour", digits: int = 6) -> DataFrame:
    """Per window, the driver with the most tips (lowest id on ties).

    The second aggregation is again a (tumbling) window over the first one's
    window time, so the same plan runs as a chained streaming aggregation; it
    is partially aggregated, never funnelled into a single task.
    """
    per_driver = hourly_tips(fares, size, digits)
    best = F.max_by(F.struct("driverId", "tips"), F.struct(F.col("tips"), -F.col("driverId")))
    return (per_driver.groupBy(F.window(F.window_time("w"), size).alias("w2"))
            .agg(best.alias("best"))
            .select(F.col("w2.end").alias("windowEnd"), F.col("best.driverId").alias("driverId"),
                    F.col("best.tips").alias("tips")))


def high_tip_hours(fares: DataFrame, min_tips: float = 50.0, size: str = "1 hour",
                   digits: int = 6) -> DataFrame:
    """SUM(tip) per driver and window, HAVING sum > min_tips."""
    # the exact sum decides; only the output is rounded
    return (fares.groupBy(F.window("startTime", size).alias("w"), "driverId")
            .agg(F.sum("tip").alias("tips"))
            .filter(F.col("tips") > min_tips)
            .select(F.col("w.end").alias("windowEnd"), "driverId", F.round("tips", digits).alias("tips")))


def fold_changes(changes: DataFrame, flag: str = "added") -> DataFrame:
    """The rows that a changelog leaves: each as often as it was added (``flag``
    true) less the times it was taken back."""
    kept = [c for c in changes.columns if c != flag]
    left = changes.groupBy(*kept).agg(F.sum(F.when(F.col(flag), 1).otherwise(-1)).alias("_left"))
    return left.where("_left > 0").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), "_left"))).select(*kept)


# ---------------------------------------------------------------- W1, P8


def arrivals_window(rides: DataFrame, range_: str = "10 minutes", cell: int | None = None,
                    bucket: str | None = None) -> DataFrame:
    """For each END event, the number of END events in the same end cell within
    the preceding ``range_`` (inclusive, peers included).

    COUNT(*) OVER (PARTITION BY cell ORDER BY eventTime RANGE range PRECEDING) is
    rewritten as a difference of two running counts, so it runs through the
    skew-safe ``keyed_scan`` (a busy cell is split over ranges of time):
    count = C(events at or before t) - C(events before t - range). Events of a
    cell at the same time are counted first (map-side combined) and read the
    running count through two probe rows; each of them is one output row.
    """
    width_us = interval_seconds(range_) * 1_000_000
    e = end_events(rides).select(to_cell_id("endLon", "endLat").alias("cellId"), "eventTime")
    if cell is not None:
        e = e.filter(F.col("cellId") == F.lit(int(cell)))  # P8
    e = e.groupBy("cellId", "eventTime").agg(F.count(F.lit(1)).alias("_same"))
    t = F.unix_micros("eventTime")
    none = F.lit(None).cast("long")
    # one scan: the events of an instant (kind 1, counted) and two probes that
    # read the running count at t (kind 2, after its peers) and just before
    # t - range (kind 0)
    rows = e.select("cellId", "eventTime", "_same", F.explode(F.array(
        F.struct(t.alias("_t"), F.lit(1).alias("_kind"), F.col("_same").alias("_v")),
        F.struct(t.alias("_t"), F.lit(2).alias("_kind"), none.alias("_v")),
        F.struct((t - width_us).alias("_t"), F.lit(0).alias("_kind"), none.alias("_v")),
    )).alias("_p")).select("cellId", "eventTime", "_same", "_p.*")
    width = interval_seconds(bucket) * 1_000_000 if bucket is not None else None
    scanned = keyed_scan(rows, ["cellId"], ["_t", "_kind"],
                         F.floor(F.col("_t") / F.lit(width)) if width is not None else None,
                         {"_c": ("sum", F.col("_v"))})
    probes = scanned.filter(F.col("_kind") != 1)
    cnt = F.sum(F.when(F.col("_kind") == 2, F.col("_c")).otherwise(-F.col("_c")))
    return (probes.groupBy("cellId", "eventTime").agg(cnt.alias("cnt"), F.max("_same").alias("_same"))
            .withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_same"))))
            .select(F.col("cellId").cast("string").alias("cell"), "eventTime", "cnt"))


def arrivals_last_10min(rides: DataFrame, cell: int | None = None) -> DataFrame:
    """W1 with its 10-minute range."""
    return arrivals_window(rides, "10 minutes", cell)


def route_heatmap(rides: DataFrame) -> DataFrame:
    """F4 user-level form: cleansed rides (START records) counted per grid cell on
    their straight path. Rides with the same end points are counted first, so each
    distinct path is walked once, by a vectorised pandas UDF."""
    from ..functions.geo import cells_on_way
    ends = ["startLon", "startLat", "endLon", "endLat"]
    paths = start_events(clean_rides(rides)).groupBy(*ends).agg(F.count(F.lit(1)).alias("_n"))
    cells = paths.select("_n", F.explode(cells_on_way(*ends)).alias("cell"))
    return cells.groupBy("cell").agg(F.sum("_n").alias("cnt"))


# ---------------------------------------------------------------- A15, B1


def ride_order() -> F.Column:
    """§1 ride order: by event time, START before END on ties, then ride id."""
    return F.struct(F.col("eventTime"), ~F.col("isStart"), F.col("rideId"))


def latest_per_taxi(rides: DataFrame, as_of=None) -> DataFrame:
    """Newest event per taxi (optionally among events at or before ``as_of``).
    max_by is combined map-side, so a busy taxi does not make a hot task."""
    r = rides if as_of is None else rides.filter(F.col("eventTime") <= ts_lit(as_of))
    latest = r.groupBy("taxiId").agg(F.max_by(F.struct(*RIDE_COLUMNS), ride_order()).alias("r"))
    return latest.select("r.*")


def ongoing_rides(rides: DataFrame, minutes: int, at) -> DataFrame:
    """B1: taxis whose latest event at time ``at`` is a START that began at least
    ``minutes`` whole minutes earlier."""
    latest = latest_per_taxi(rides, as_of=at)
    age = F.floor((F.unix_millis(ts_lit(at)) - F.unix_millis("eventTime")) / 60000)
    return latest.filter(F.col("isStart") & (age >= minutes))


def ride_states(rides: DataFrame) -> DataFrame:
    """Each event with ``validUntil``, the time of its taxi's next event in ride order
    (null for the last): the event is its taxi's latest from its own time until then."""
    r = rides.withColumn("_end", ~F.col("isStart"))
    return keyed_scan(r, ["taxiId"], ["eventTime", "_end", "rideId"], None,
                      {"validUntil": ("next", F.col("eventTime"))}, inclusive=False).drop("_end")


def ongoing_rides_for_queries(rides: DataFrame, queries) -> DataFrame:
    """B1 for many queries (queryId, minutes, at; a table or a list of any length).

    A START is its taxi's latest event from its time to the taxi's next event, and
    old enough for a query from ``minutes`` after its time: a query matches the
    STARTs whose interval holds its time. Intervals and times meet by ``stab``,
    so no ride meets a query at whose time it is not the latest."""
    if not isinstance(queries, DataFrame):
        queries = rides.sparkSession.createDataFrame(
            [(int(q), int(m), str(t)) for q, m, t in queries], "queryId long, minutes long, at string") \
            .withColumn("at", F.col("at").cast("timestamp"))
    asked = queries.select("queryId", F.col("minutes").cast("long").alias("_minutes"), F.unix_micros("at").alias("_at"))
    # the last events last until after the last query
    last = asked.agg(F.max("_at")).first()[0]
    if last is None:
        last = 0
    states = start_events(ride_states(rides)).withColumns({
        "_since": F.unix_micros("eventTime"),
        "_till": F.least(F.coalesce(F.unix_micros("validUntil"), F.lit(last + 1)), F.lit(last + 1))})
    met = stab(states.select(*RIDE_COLUMNS, "_since", "_till"), asked, "_since", "_till", "_at")
    # whole minutes between the times in milliseconds
    age = F.floor((F.floor(F.col("_at") / 1000) - F.floor(F.col("_since") / 1000)) / 60000)
    return met.filter(age >= F.col("_minutes")).select("queryId", *RIDE_COLUMNS)


# ---------------------------------------------------------------- F8, F15


def ride_durations(rides: DataFrame) -> DataFrame:
    """F8/F15 over END events: (rideId, startTime, endTime, diffMs, minutes)."""
    return end_events(rides).select(
        "rideId", "startTime", "endTime",
        time_diff_ms("startTime", "endTime").alias("diffMs"),
        travel_minutes("startTime", "endTime").alias("minutes"))
