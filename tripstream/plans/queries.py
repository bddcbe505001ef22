"""

Each entry is ``(spark, sf_dir) -> DataFrame`` over the whole generated tables
(via the derived views of ``tripstream.sources.fixtures``); the DuckDB twin of
every entry is in ``tripstream.plans.oracle``. Timestamps are returned as
timestamp_ntz so that both sides report the same column types.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..operators.mail import distinct_mails
from ..sources import fixtures as fx
from ..session import ensure_checkpoint_dir
from ..sources.cars import parse_car_lines
from ..sources.catalog import TaxiCatalog
from ..sources.graph import read_edges, write_tsv
from ..sources.mail import mail_records, parse_mail_records, parse_mbox_mails
from ..sources.rides import line_to_ride, raw_fares_to_fares, ride_to_line, trips_to_ride_events
from .oracle import AS_OF, CELL, MAIL_EXCLUDE, ONGOING_QUERIES, RULE_PREDICATE, TIMED_QUERIES
from .util import to_ntz


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_ntz(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def route_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 user-level form over the rides view."""
    return op.route_heatmap(fx.rides(spark, sf_dir))


def _ride_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ride as a text line and back."""
    return line_to_ride(ride_to_line(fx.rides(spark, sf_dir)))


def _car_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: every car event as a 23-field line, parsed."""
    blank = [F.lit("")] * 23
    at = {0: F.col("carId"), 1: F.col("id"), 9: F.col("speed").cast("string"), 12: F.col("throttle").cast("string"),
          20: F.lit("8.5"), 21: F.lit("47.25"), 22: F.date_format("eventTime", "yyyy-MM-dd'T'HH:mm:ss'+0000'")}
    for place, value in at.items():
        blank[place] = value
    return parse_car_lines(fx.car_events(spark, sf_dir).select(F.concat_ws(", ", *blank).alias("value")))


def _mail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mail as a delimited record and back."""
    return parse_mail_records(mail_records(fx.mails(spark, sf_dir)))


def _mbox_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mail as an mbox text, parsed."""
    sent = F.to_timestamp("time", "yyyy-MM-dd-HH:mm:ss")
    text = F.concat_ws(
        "\n", F.concat(F.lit("From dev-return-1 "), F.date_format(sent, "EEE MMM dd HH:mm:ss yyyy")),
        F.concat(F.lit("Subject: "), "subject"), F.concat(F.lit("From: "), "sender"),
        F.concat(F.lit("Message-ID: "), "messageId"),
        F.when(F.col("replyTo") != "null", F.concat(F.lit("In-Reply-To: "), "replyTo")), F.lit(""), "body")
    return distinct_mails(parse_mbox_mails(fx.mails(spark, sf_dir).select(text.alias("value")), "dev-return"))


def _raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip columns of every event → START and END records in time order."""
    r = fx.rides(spark, sf_dir).filter(~F.col("isStart"))
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    at = {1: F.col("taxiId"), 2: F.col("driverId"), 6: show("startTime"), 7: show("endTime"), 8: F.col("passengerCnt"),
          11: F.col("startLon"), 12: F.col("startLat"), 13: F.col("endLon"), 14: F.col("endLat")}
    raw = r.select("rideId", *[(at[i] if i in at else F.lit("")).cast("string").alias(f"_c{i - 1}") for i in range(1, 15)])
    return trips_to_ride_events(raw, "rideId")


def _raw_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw fare columns of every fare → fare records."""
    at = {1: F.col("taxiId"), 2: F.col("driverId"), 4: F.date_format("startTime", "yyyy-MM-dd HH:mm:ss"),
          5: F.col("paymentType"), 9: F.col("tip"), 10: F.col("tolls"), 11: F.concat(F.col("totalFare").cast("string"), F.lit("\r"))}
    raw = fx.fares(spark, sf_dir).select(
        "rideId", *[(at[i] if i in at else F.lit("")).cast("string").alias(f"_c{i - 1}") for i in range(1, 12)])
    return raw_fares_to_fares(raw, "rideId")


def _catalog_fares_in_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ride and fare views as tables of a catalog schema, joined by name."""
    events = f"parquet.`{sf_dir.rstrip('/')}/events.parquet`"
    cat = TaxiCatalog(spark, "nyc_events")
    cat.add_view("TaxiRides", f"""SELECT event_id AS rideId, isStart, cast(-74.08 + (event_id % 7) * 0.06 AS float) AS startLon,
        cast(40.48 + (event_id % 5) * 0.12 AS float) AS startLat, cast(-74.08 + (event_id % 11) * 0.037 AS float) AS endLon,
        cast(40.48 + (event_id % 3) * 0.2 AS float) AS endLat
        FROM {events} LATERAL VIEW explode(array(true, false)) AS isStart""")
    cat.add_view("TaxiFares", f"""SELECT event_id AS rideId, event_id % 97 AS driverId, value AS totalFare
        FROM {events} WHERE event_id % 13 <> 0""")
    return op.fares_in_city_of(cat)


def _tsv_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges written as tab-separated lines and read back, out-weight by source."""
    path = f"{ensure_checkpoint_dir(spark)}/edges-{uuid.uuid4().hex}"
    write_tsv(fx.edges(spark, sf_dir).select("src", "dst", F.col("weight").cast("double").alias("weight")), path)
    return read_edges(spark, path)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    R, Fa = fx.rides, fx.fares
    return {
        "clean_rides": _q(lambda s, d: op.clean_rides(R(s, d))),
        "ride_lines": _q(_ride_lines),
        "car_lines": _q(_car_lines),
        "mail_records": _q(_mail_records),
        "mbox_mails": _q(_mbox_mails),
        "raw_trips": _q(_raw_trips),
        "raw_fares": _q(_raw_fares),
        "popular_places": _q(lambda s, d: op.popular_places(R(s, d), 5, "12 hours", "4 hours")),
        "popular_places_sql": _q(lambda s, d: op.popular_places_sql(s, R(s, d), 5, "12 hours", "4 hours")),
        "ride_count": _q(lambda s, d: op.ride_count(R(s, d))),
        "enrich_rides": _q(lambda s, d: op.enrich_rides(R(s, d), Fa(s, d))),
        "unmatched_fares": _q(lambda s, d: op.unmatched_fares(R(s, d), Fa(s, d))),
        "unmatched_rides": _q(lambda s, d: op.unmatched_rides(R(s, d), Fa(s, d))),
        "fares_in_city": _q(lambda s, d: op.fares_in_city(s, R(s, d), Fa(s, d))),
        "catalog_fares_in_city": _q(_catalog_fares_in_city),
        "tsv_edges": _q(_tsv_edges),
        "hourly_tip_leader": _q(lambda s, d: op.hourly_tip_leader(Fa(s, d), "6 hours")),
        "high_tip_hours": _q(lambda s, d: op.high_tip_hours(Fa(s, d), 10.0, "24 hours")),
        "long_rides": _q(lambda s, d: op.long_rides(R(s, d), 120)),
        "long_rides_clean": _q(lambda s, d: op.long_rides_clean(R(s, d), 120)),
        "long_rides_pattern": _q(lambda s, d: op.long_rides_pattern(R(s, d), 120)),
        "latest_per_taxi": _q(lambda s, d: op.latest_per_taxi(R(s, d))),
        "ongoing_rides_for_queries": _q(lambda s, d: op.ongoing_rides_for_queries(R(s, d), ONGOING_QUERIES)),
        "ongoing_rides": _q(lambda s, d: op.ongoing_rides(R(s, d), 30, AS_OF)),
        "nearest_taxi": _q(lambda s, d: op.nearest_taxi(R(s, d), fx.LOCATION_QUERIES)),
        "nearest_taxi_ttl": _q(lambda s, d: op.nearest_taxi_ttl(R(s, d), TIMED_QUERIES)),
        "match_rides": _q(lambda s, d: op.match_rides(R(s, d), RULE_PREDICATE, AS_OF)),
        "arrivals_window": _q(lambda s, d: op.arrivals_window(R(s, d), "12 hours")),
        "arrivals_window_cell": _q(lambda s, d: op.arrivals_window(R(s, d), "12 hours", cell=CELL)),
        "route_heatmap": _q(route_heatmap),
        "travel_time": _q(lambda s, d: op.predict_travel_time(R(s, d))),
        "driving_sessions": _q(lambda s, d: op.driving_sessions(fx.car_events(s, d), "12 hours")),
        "driving_segments": _q(lambda s, d: op.driving_segments(fx.car_events(s, d))),
        "driving_segments_between_stops":
            _q(lambda s, d: op.driving_segments_between_stops(fx.car_events(s, d))),
        "sort_car_events": _q(lambda s, d: op.sort_car_events(fx.car_events(s, d))),
        "asof_join": _q(lambda s, d: op.asof_join(fx.trades(s, d), fx.customers(s, d))),
        "latest_join": _q(lambda s, d: op.latest_join(fx.trades(s, d, arrival=True), fx.customers(s, d, arrival=True), "arrivalTime")),
        "match_rules": _q(lambda s, d: op.match_rules(fx.items(s, d), [("view", "purchase")])),
        "mail_count": _q(lambda s, d: op.mail_count(fx.mails(s, d))),
        "tf_idf": _q(lambda s, d: op.tf_idf(fx.documents(s, d), "doc_id", "text")),
        "tf_idf_mails": _q(lambda s, d: op.tf_idf(fx.mails(s, d), "messageId", "body")),
        "reply_graph": _q(lambda s, d: op.reply_graph(fx.mails(s, d), MAIL_EXCLUDE)),
        "member_of_month": _q(lambda s, d: op.member_of_month(fx.mails(s, d), MAIL_EXCLUDE)),
        "weighted_pagerank": _q(lambda s, d: op.weighted_pagerank(fx.edges(s, d), 10, 0.85, digits=6)),
        "distinct_mails": _q(lambda s, d: op.distinct_mails(fx.mails(s, d))),
        "time_diff": _q(lambda s, d: op.ride_durations(R(s, d))),
    }
