"""Location queries against the ride stream: nearest taxi (B2, W2, J9) and
predicate matching (B4, P9). Batch forms; see ``tripstream.streaming`` for the
incremental ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import distance_km
from ..functions.sql import register_sql_functions
from ..plans.intervals import stab
from ..plans.nearest import candidates, first_per_place
from ..plans.prefix import duration_bucket, keyed_scan
from ..plans.resets import resetting_minima
from ..plans.util import interval_seconds, ts_lit
from ..schemas import RIDE_COLUMNS
from ..session import ensure_checkpoint_dir
from .rides import end_events, latest_per_taxi

#: Queries that one joined row carries.
BLOCK = 1_000


def query_table(spark, queries, schema: str) -> DataFrame:
    """Queries given as a DataFrame or as a list of tuples."""
    return queries if isinstance(queries, DataFrame) else spark.createDataFrame(list(queries), schema)


def _locations(rides: DataFrame, queries) -> DataFrame:
    q = query_table(rides.sparkSession, queries, "queryId long, longitude double, latitude double")
    return q.toDF("queryId", "qLon", "qLat").select(F.col("queryId").cast("long"), F.col("qLon").cast("float"),
                                                    F.col("qLat").cast("float"))


def query_distances(rides: DataFrame, queries) -> DataFrame:
    """J9 + F5: every END ride against every query (queryId, longitude, latitude; a
    table or a list of any length) → (queryId, eventTime, rideId, taxiId, km).

    All pairs are the result. Queries are packed into rows of ``BLOCK``, each
    copied to as many salts as there are shuffle partitions; a ride goes to its
    own salt of each block, so rides spread over the tasks however few queries
    there are. ``nearest_taxi`` does not go through this."""
    q = _locations(rides, queries)
    salts = int(rides.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-(q.count() if isinstance(queries, DataFrame) else len(queries)) // BLOCK))
    packed = (q.select(F.pmod(F.xxhash64("queryId", "qLon", "qLat"), F.lit(blocks)).cast("int").alias("_block"),
                       F.struct(*q.columns).alias("_q"))
              .groupBy("_block").agg(F.collect_list("_q").alias("_queries"))
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    e = end_events(rides).select("rideId", "taxiId", "eventTime", "endLon", "endLat",
                                 F.pmod(F.xxhash64("rideId", "eventTime"), F.lit(salts)).cast("int").alias("_salt"),
                                 F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    e = e.join(packed, ["_block", "_salt"]).withColumn("q", F.explode("_queries"))
    return e.select("q.queryId", "eventTime", "rideId", "taxiId",
                    distance_km("q.qLon", "q.qLat", "endLon", "endLat").cast("float").alias("km"))


def running_minima(reports: DataFrame, key: str = "queryId", order=("eventTime", "rideId"),
                   value: str = "km", bucket: str | Column | None = None) -> DataFrame:
    """Keep the reports that are strictly below every earlier report of their key.

    Skew-safe: the earlier minimum comes from ``keyed_scan`` (per-bucket minima,
    prefix over buckets, in-bucket running minimum), so one query's reports are
    spread over many tasks instead of one. ``bucket``: a duration, or a column
    that rises with the order."""
    by = duration_bucket(order[0], bucket) if bucket is None or isinstance(bucket, str) else bucket
    scanned = keyed_scan(reports, [key], list(order), by, {"_prev": ("min", F.col(value))}, inclusive=False)
    return scanned.filter(F.col("_prev").isNull() | (F.col(value) < F.col("_prev"))).drop("_prev")


def near_reports(rides: DataFrame, locations: DataFrame, best: str | None = None) -> DataFrame:
    """Reports (as ``query_distances``, with ``_slice``) of the END rides that can be
    new minima of a query (queryId, qLon, qLat): of each end point only the first
    ride, and only where the grid lets it be nearer than all before."""
    ends = end_events(rides).select("rideId", "taxiId", "eventTime", "endLon", "endLat")
    ends = first_per_place(ends, ["eventTime", "rideId"], "endLon", "endLat")
    met = candidates(ends, locations, "eventTime", "endLon", "endLat", best=best)
    kept = [c for c in locations.columns if c not in ("queryId", "qLon", "qLat")]
    return met.select("queryId", "eventTime", "rideId", "taxiId",
                      distance_km("qLon", "qLat", "endLon", "endLat").cast("float").alias("km"), *kept, "_slice")


def nearest_taxi(rides: DataFrame, queries) -> DataFrame:
    """B2: for each location query, the stream of ever-closer ending taxis. A ride
    meets the queries whose nearest distance so far it can beat (``near_reports``),
    not all of them."""
    reports = near_reports(rides, _locations(rides, queries))
    return running_minima(reports, bucket=F.col("_slice")).drop("_slice")


TIMED_QUERY = "queryId long, longitude double, latitude double, queryTime timestamp"


def live_queries(spark, queries, retention: str = "15 minutes", expiry: str = "arrival") -> DataFrame:
    """Queries (queryId, longitude, latitude, queryTime) → (queryId, qLon, qLat, _since,
    _till), the microseconds in which each is live: from its own time until a query
    arrives that is more than ``retention`` younger (``expiry="arrival"``; for ever
    if none does), or until ``retention`` has passed (``"age"``). A query with
    longitude 0 only purges; one without a time is never live."""
    if expiry not in ("arrival", "age"):
        raise ValueError(f"expiry is 'arrival' or 'age', not {expiry!r}")
    q = queries if isinstance(queries, DataFrame) else spark.createDataFrame(
        [(int(i), float(lon), float(lat), str(t)) for i, lon, lat, t in queries],
        TIMED_QUERY.replace("queryTime timestamp", "queryTime string"))
    q = q.toDF("queryId", "qLon", "qLat", "queryTime").select(
        F.col("queryId").cast("long"), F.col("qLon").cast("float"), F.col("qLat").cast("float"),
        F.unix_micros(F.col("queryTime").cast("timestamp")).alias("_since"))
    kept = interval_seconds(retention) * 1_000_000
    for_ever = F.lit(2**55).cast("long")     # the year 3111
    if expiry == "age":
        live = q.withColumn("_till", F.col("_since") + kept + 1)
    else:
        # arrivals, and one probe per query that looks for the first one behind its retention
        none = F.lit(None).cast("long")
        rows = q.select("*", F.lit(0).alias("_all"), F.explode(F.array(
            F.struct(F.col("_since").alias("_at"), F.lit(0).alias("_probe"), F.col("_since").alias("_arrived")),
            F.struct((F.col("_since") + kept).alias("_at"), F.lit(1).alias("_probe"), none.alias("_arrived")),
        )).alias("_p")).select("queryId", "qLon", "qLat", "_since", "_all", "_p.*")
        found = keyed_scan(rows, ["_all"], ["_at", "_probe", "queryId"], None, {"_till": ("next", F.col("_arrived"))})
        live = found.where("_probe = 1").withColumn("_till", F.coalesce("_till", for_ever))
    return live.where((F.col("qLon") != 0) & F.col("_since").isNotNull()) \
        .select("queryId", "qLon", "qLat", "_since", "_till")


def nearest_taxi_ttl(rides: DataFrame, queries, retention: str = "15 minutes", reset: str = "8 hours",
                     expiry: str = "arrival") -> DataFrame:
    """As ``nearest_taxi``, for queries with an arrival time (see ``live_queries``);
    a query's minimum is forgotten when it has not improved for ``reset``. A ride
    meets only the queries live at its time (``stab``)."""
    ensure_checkpoint_dir(rides.sparkSession)
    # read four times below: a table of the queries, not their plan
    live = live_queries(rides.sparkSession, queries, retention, expiry).checkpoint()
    ends = end_events(rides).select("rideId", "taxiId", "eventTime", "endLon", "endLat",
                                    F.unix_micros("eventTime").alias("_at"))
    reports = stab(live, ends, "_since", "_till", "_at", counted=True) \
        .select("queryId", "eventTime", "rideId", "taxiId",
                distance_km("qLon", "qLat", "endLon", "endLat").cast("float").alias("km"))
    return resetting_minima(reports, "queryId", ["eventTime", "rideId"], "km", interval_seconds(reset) * 1_000_000)


def with_rule_columns(rides: DataFrame, watermark: Column) -> DataFrame:
    """``rides`` with what a rule may refer to besides their columns: the ride's
    current position (start for START, end for END) and the watermark."""
    pos = F.col("isStart")
    return rides.withColumns({
        "lon": F.when(pos, F.col("startLon")).otherwise(F.col("endLon")),
        "lat": F.when(pos, F.col("startLat")).otherwise(F.col("endLat")),
        "watermark": watermark,
    })


def _with_rule_columns(rides: DataFrame, delay_s: int) -> DataFrame:
    # the watermark at the ride
    return with_rule_columns(rides, F.col("eventTime") - F.make_dt_interval(secs=F.lit(delay_s)))


def match_rides(rides: DataFrame, predicate: str, rule_time=None, delay: str = "60 seconds") -> DataFrame:
    """Rides satisfying a Spark SQL predicate over the ride columns plus
    ``lon``/``lat`` (current position), ``watermark`` and the registered SQL
    functions, e.g. ``distanceKm(-73.9776, 40.7614, lon, lat) < 1.0``.

    With ``rule_time`` the predicate arrives at that time: it is first applied to
    the latest event of every taxi at that moment (source 'PBE'), then to every
    later event (source 'PE'). Without it the predicate is active from the start.
    """
    register_sql_functions(rides.sparkSession)
    cond = F.expr(predicate)
    delay_s = interval_seconds(delay)
    if rule_time is None:
        return _with_rule_columns(rides, delay_s).filter(cond) \
            .select(F.lit("PE").alias("source"), *RIDE_COLUMNS)
    at = ts_lit(rule_time)
    stored = _with_rule_columns(latest_per_taxi(rides, as_of=rule_time), delay_s).filter(cond) \
        .select(F.lit("PBE").alias("source"), *RIDE_COLUMNS)
    later = _with_rule_columns(rides.filter(F.col("eventTime") > at), delay_s).filter(cond) \
        .select(F.lit("PE").alias("source"), *RIDE_COLUMNS)
    return stored.unionByName(later)
