"""Ride and fare text sources and conversions.

Files are read by Spark's CSV source with a fixed schema in FAILFAST mode, so a
record with a wrong field count or an unparsable number/time fails the job
(ANSI casts), while an empty coordinate or amount becomes 0.0. Gzip files are
not splittable: a narrow batch read is spread over the cluster afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import format_ride_time, parse_ride_time
from ..plans.util import spread
from ..schemas import FARE_CSV, RIDE_COLUMNS, RIDE_CSV


def _num(c: str, typ: str = "float") -> Column:
    return F.coalesce(F.col(c).cast(typ), F.lit(0.0).cast(typ))


def _reader(spark: SparkSession, schema, streaming: bool):
    r = spark.readStream if streaming else spark.read
    return r.schema(schema).option("mode", "FAILFAST").option("header", "false")


def parse_ride_columns(raw: DataFrame) -> DataFrame:
    """RIDE_CSV columns → ride records (START/END decides which time is which)."""
    kind = F.col("kind")
    is_start = (F.when(kind == "START", F.lit(True)).when(kind == "END", F.lit(False))
                .otherwise(F.raise_error(F.concat(F.lit("Invalid record kind: "), F.coalesce(kind, F.lit("null"))))))
    t1, t2 = parse_ride_time("time1"), parse_ride_time("time2")
    out = raw.select(
        "rideId", is_start.alias("isStart"),
        F.when(kind == "START", t1).otherwise(t2).alias("startTime"),
        F.when(kind == "START", t2).otherwise(t1).alias("endTime"),
        _num("startLon").alias("startLon"), _num("startLat").alias("startLat"),
        _num("endLon").alias("endLon"), _num("endLat").alias("endLat"),
        "passengerCnt", "taxiId", "driverId")
    return out.withColumn("eventTime", F.when(F.col("isStart"), F.col("startTime")).otherwise(F.col("endTime"))) \
        .select(*RIDE_COLUMNS)


def read_rides(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Ride CSV (optionally gzip) → ride records with eventTime."""
    raw = _reader(spark, RIDE_CSV, streaming).csv(path)
    rides = parse_ride_columns(raw)
    return rides if streaming else spread(rides)


def read_fares(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Fare CSV (8 fields) → fare records."""
    raw = _reader(spark, FARE_CSV, streaming).csv(path)
    fares = raw.select("rideId", "taxiId", "driverId", parse_ride_time("startTime").alias("startTime"),
                       "paymentType", _num("tip", "double").alias("tip"),
                       _num("tolls", "double").alias("tolls"), _num("totalFare", "double").alias("totalFare"))
    return fares if streaming else spread(fares)


# ---------------------------------------------------------------- S12 text form

def ride_to_line(rides: DataFrame) -> DataFrame:
    """S12 encode: one CSV line per ride; the event's own time comes first (START:
    start,end; END: end,start), so lines decode back to the same record."""
    first = F.when(F.col("isStart"), F.col("startTime")).otherwise(F.col("endTime"))
    second = F.when(F.col("isStart"), F.col("endTime")).otherwise(F.col("startTime"))
    return rides.select(F.concat_ws(
        ",", F.col("rideId").cast("string"), F.when(F.col("isStart"), "START").otherwise("END"),
        format_ride_time(first), format_ride_time(second),
        *[F.col(c).cast("string") for c in ("startLon", "startLat", "endLon", "endLat",
                                           "passengerCnt", "taxiId", "driverId")]).alias("value"))


def line_to_ride(lines: DataFrame, col: str = "value") -> DataFrame:
    """S12 decode: CSV text column → ride records (as S1)."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RIDE_CSV.fields)
    parsed = lines.select(F.from_csv(F.col(col).cast("string"), ddl, {"mode": "FAILFAST"}).alias("r"))
    return parse_ride_columns(parsed.select("r.*"))


def rides_from_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """S10 source: ride lines from a Kafka topic, earliest offsets (needs the
    Kafka connector on the classpath)."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", "earliest").load())
    return line_to_ride(raw.select(F.col("value").cast("string").alias("value")))


def rides_to_kafka(rides: DataFrame, servers: str, topic: str, checkpoint: str):
    """S11 sink: cleansed rides as text lines to a Kafka topic."""
    return (ride_to_line(rides).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


# ---------------------------------------------------------------- S8, S9 raw data

def trips_to_ride_events(raw: DataFrame, id_col: str) -> DataFrame:
    """Raw trip rows (positional columns _c0.. as read from the raw CSV) → a
    START and an END record per trip, in event-time order. The ride id comes
    from ``id_col`` (a line number is not a stable key in a distributed read)."""
    c = lambda i: F.regexp_replace(F.col(f"_c{i - 1}").cast("string"), "\r", "")
    pickup, dropoff = parse_ride_time(c(6)), parse_ride_time(c(7))
    base = raw.select(F.col(id_col).cast("long").alias("rideId"), pickup.alias("p"), dropoff.alias("d"),
                      *[F.coalesce(c(i).cast("float"), F.lit(0.0).cast("float")).alias(n)
                        for i, n in ((11, "startLon"), (12, "startLat"), (13, "endLon"), (14, "endLat"))],
                      c(8).cast("short").alias("passengerCnt"), c(1).cast("long").alias("taxiId"),
                      c(2).cast("long").alias("driverId"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    ev = base.select("*", F.explode(F.array(
        F.struct(F.lit(True).alias("isStart"), F.col("p").alias("startTime"), epoch.alias("endTime")),
        F.struct(F.lit(False).alias("isStart"), F.col("p").alias("startTime"), F.col("d").alias("endTime")))).alias("e"))
    out = ev.select("rideId", "taxiId", "driverId", "e.isStart", "e.startTime", "e.endTime",
                    F.when(F.col("e.isStart"), F.col("e.startTime")).otherwise(F.col("e.endTime")).alias("eventTime"),
                    "startLon", "startLat", "endLon", "endLat", "passengerCnt")
    return out.orderBy("eventTime", F.col("isStart").desc(), "rideId")


def raw_fares_to_fares(raw: DataFrame, id_col: str) -> DataFrame:
    """Raw fare rows → fare records (fields 1, 2, 4, 5, 9, 10, 11 + id; CR stripped)."""
    c = lambda i: F.regexp_replace(F.col(f"_c{i - 1}").cast("string"), "\r", "")
    return raw.select(F.col(id_col).cast("long").alias("rideId"), c(1).cast("long").alias("taxiId"),
                      c(2).cast("long").alias("driverId"), parse_ride_time(c(4)).alias("startTime"),
                      c(5).alias("paymentType"), c(9).cast("double").alias("tip"),
                      c(10).cast("double").alias("tolls"), c(11).cast("double").alias("totalFare"))


# ---------------------------------------------------------------- S20, S21 SQL tables

RIDE_TABLE_COLUMNS = ["rideId", "taxiId", "driverId", "isStart", "startLon", "startLat", "endLon",
                      "endLat", "passengerCnt"]
FARE_TABLE_COLUMNS = ["rideId", "taxiId", "driverId", "paymentType", "tip", "tolls", "totalFare"]


def ride_table(rides: DataFrame, max_delay_s: int | None = None) -> DataFrame:
    """SQL-facing ride table: nine columns + rowtime ``eventTime``."""
    t = rides.select(*RIDE_TABLE_COLUMNS, "eventTime")
    return t.withWatermark("eventTime", f"{int(max_delay_s)} seconds") if max_delay_s is not None else t


def fare_table(fares: DataFrame, max_delay_s: int | None = None) -> DataFrame:
    """SQL-facing fare table: seven columns + rowtime ``eventTime`` (the start time)."""
    t = fares.select(*FARE_TABLE_COLUMNS, F.col("startTime").alias("eventTime"))
    return t.withWatermark("eventTime", f"{int(max_delay_s)} seconds") if max_delay_s is not None else t


def register_table(spark: SparkSession, name: str, kind: str, options: dict,
                   streaming: bool = False) -> DataFrame:
    """Register a ride or fare table from named properties
    (``path``; ``max-event-delay-secs`` >= 0; ``update-mode`` must be append)."""
    if kind not in ("taxi-rides", "taxi-fares"):
        raise ValueError(f"unknown table type {kind!r}")
    if "path" not in options:
        raise ValueError("property 'path' is required")
    mode = options.get("update-mode", "append")
    if mode != "append":
        raise ValueError("only update-mode 'append' is supported")
    delay = options.get("max-event-delay-secs")
    if delay is not None and int(delay) < 0:
        raise ValueError("max-event-delay-secs must be >= 0")
    if kind == "taxi-rides":
        t = ride_table(read_rides(spark, options["path"], streaming), delay if streaming else None)
    else:
        t = fare_table(read_fares(spark, options["path"], streaming), delay if streaming else None)
    t.createOrReplaceTempView(name)
    return t


# ---------------------------------------------------------------- S18 query lines

def location_queries_from_lines(lines: DataFrame, col: str = "value", id_col: str | None = None) -> DataFrame:
    """S18: "lon, lat" text lines → (queryId, longitude, latitude). The id is the
    caller's column ``id_col``; without one it is a hash of the line, so equal
    lines are one query however the input is partitioned."""
    parts = F.split(F.trim(F.col(col)), r",\s*")
    own = F.col(id_col).cast("long") if id_col else F.xxhash64(F.trim(F.col(col)))
    return lines.select(own.alias("queryId"),
                        parts.getItem(0).cast("float").alias("longitude"),
                        parts.getItem(1).cast("float").alias("latitude"))


def minutes_queries_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Ongoing-ride queries, one whole number of minutes per line."""
    return lines.select(F.trim(F.col(col)).cast("long").alias("minutes"))
