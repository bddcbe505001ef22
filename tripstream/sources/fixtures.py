"""Derived inputs over the generated tables (see FIXTURES.md §4).

The generated tables hold no trips, cars, trades or mails, so every job reads
these views, which Spark derives from the parquet tables. Each is a pure
projection / filter / explode over one scan, so predicates and column pruning
reach the parquet reader and the views scale with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False) -> DataFrame:
    """One generated table; with ``streaming`` the same file(s) as a stream source
    (schema taken from the batch reader; one file per trigger)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if not streaming:
        return spark.read.parquet(path)
    schema = spark.read.parquet(path).schema
    # a file stream source watches a directory; the table is picked by file name
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf_dir.rstrip("/")))


def _ts(col: str = "ts"):
    # parquet timestamps load as timestamp_ntz; event time is UTC timestamp
    return F.col(col).cast("timestamp")


def rides(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Each event is a trip of ``value`` minutes: one START and one END record."""
    ev = table(spark, sf_dir, "events", streaming).select("event_id", "user_id", "ts", "value")
    plus = F.expr("cast(ts as timestamp) + make_dt_interval(0, 0, 0, cast(floor(value * 60) as bigint))")
    return (ev
            .withColumn("isStart", F.explode(F.array(F.lit(True), F.lit(False))))
            .select(
                F.col("event_id").alias("rideId"),
                F.col("user_id").alias("taxiId"),
                (F.col("event_id") % 97).alias("driverId"),
                "isStart",
                _ts().alias("startTime"),
                F.when(F.col("isStart"), F.expr("timestamp '1970-01-01 00:00:00'"))
                 .otherwise(plus).alias("endTime"),
                F.when(F.col("isStart"), _ts()).otherwise(plus).alias("eventTime"),
                F.expr("cast(-74.08 + (event_id % 7) * 0.06 as float)").alias("startLon"),
                F.expr("cast(40.48 + (event_id % 5) * 0.12 as float)").alias("startLat"),
                F.expr("cast(-74.08 + (event_id % 11) * 0.037 as float)").alias("endLon"),
                F.expr("cast(40.48 + (event_id % 3) * 0.2 as float)").alias("endLat"),
                F.expr("cast(1 + event_id % 6 as smallint)").alias("passengerCnt"),
            ))


def fares(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events", streaming)
    return (ev.filter(F.col("event_id") % 13 != 0)
            .select(
                F.col("event_id").alias("rideId"),
                F.col("user_id").alias("taxiId"),
                (F.col("event_id") % 97).alias("driverId"),
                _ts().alias("startTime"),
                F.when(F.col("event_id") % 3 == 0, "CSH").otherwise("CRD").alias("paymentType"),
                (F.col("value") / 10).alias("tip"),
                (F.col("event_id") % 4).cast("double").alias("tolls"),
                F.col("value").alias("totalFare"),
            ))


def car_events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events", streaming)
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("car"), F.col("user_id").cast("string")).alias("carId"),
        _ts().alias("eventTime"),
        F.when(F.col("event_id") % 7 == 0, F.lit(0.0)).otherwise(F.col("value")).alias("speed"),
        (F.col("value") / 20).alias("throttle"),
    )


def _arrival(on: bool) -> list:
    """Arrival of an event: up to an hour after its own time, another order."""
    return [(_ts() + F.make_dt_interval(secs=F.col("event_id") * 7919 % 3600)).alias("arrivalTime")] if on else []


def trades(spark: SparkSession, sf_dir: str, streaming: bool = False, arrival: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events", streaming)
    return (ev.filter(F.col("event_type") == "purchase")
            .select(_ts().alias("eventTime"), F.col("user_id").alias("customerId"),
                    F.concat(F.lit("trade-"), F.col("event_id").cast("string")).alias("tradeInfo"), *_arrival(arrival)))


def customers(spark: SparkSession, sf_dir: str, streaming: bool = False, arrival: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events", streaming)
    return (ev.filter(F.col("event_type") == "signup")
            .select(_ts().alias("eventTime"), F.col("user_id").alias("customerId"),
                    F.concat(F.lit("customer-"), F.col("event_id").cast("string")).alias("customerInfo"), *_arrival(arrival)))


def items(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events", streaming)
    return ev.select(F.col("event_id").alias("seq"), F.col("event_type").alias("shape"),
                     (F.col("user_id") % 10).alias("color"))


def mails(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    conv = table(spark, sf_dir, "conversations", streaming)
    cid, turn = F.col("conv_id").cast("string"), F.col("turn")
    return conv.select(
        F.concat(cid, F.lit("-"), turn.cast("string")).alias("messageId"),
        F.concat(F.lit("2015-"), F.lpad((1 + F.col("conv_id") % 12).cast("string"), 2, "0"),
                 F.lit("-05-10:00:00")).alias("time"),
        F.concat(F.lit("User "), F.col("role"), F.lit(" <"), F.col("role"),
                 ((F.col("conv_id") + turn) % 9).cast("string"), F.lit("@example.org>")).alias("sender"),
        F.concat(F.lit("thread "), cid).alias("subject"),
        F.col("text").alias("body"),
        F.when(turn == 0, F.lit("null"))
         .otherwise(F.concat(cid, F.lit("-"), (turn - 1).cast("string"))).alias("replyTo"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation-to-nation trade volume: customer nation → supplier nation."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .join(cu, F.col("o_custkey") == cu.c_custkey)
            .join(su, F.col("l_suppkey") == su.s_suppkey)
            .groupBy(F.col("c_nationkey").cast("string").alias("src"),
                     F.col("s_nationkey").cast("string").alias("dst"))
            .agg(F.sum("l_quantity").alias("weight")))


def documents(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    return table(spark, sf_dir, "documents", streaming).select("doc_id", "text")


# Location queries of the nearest-taxi job: (queryId, longitude, latitude).
LOCATION_QUERIES = [(1, -74.0, 41.0), (2, -73.7781, 40.6413), (3, -73.977664, 40.761484)]
