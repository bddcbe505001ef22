import datetime as dt
import gzip
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripstream import operators as op
from tripstream import sources as src
from tripstream.sources import fixtures as fx


def tmpfile(name, text, gz=False):
    d = tempfile.mkdtemp(prefix="ts-src-")
    p = os.path.join(d, name)
    if gz:
        with gzip.open(p, "wt") as f:
            f.write(text)
    else:
        with open(p, "w") as f:
            f.write(text)
    return p


RIDES_TXT = (
    "1,START,2013-01-01 00:00:00,1970-01-01 00:00:00,-73.99,40.75,-73.98,40.76,1,2013000001,2013000002\n"
    "1,END,2013-01-01 00:20:00,2013-01-01 00:00:00,-73.99,40.75,,40.76,1,2013000001,2013000002\n")


def test_read_rides_swaps_times_and_defaults_empty_coordinates(spark):
    for gz in (False, True):
        rows = src.read_rides(spark, tmpfile("r.csv.gz" if gz else "r.csv", RIDES_TXT, gz)).orderBy("isStart").collect()
        end, start = rows
        assert start.isStart and start.startTime == dt.datetime(2013, 1, 1) and start.eventTime == start.startTime
        assert not end.isStart and end.endTime == dt.datetime(2013, 1, 1, 0, 20)
        assert end.startTime == dt.datetime(2013, 1, 1) and end.eventTime == end.endTime
        assert end.endLon == 0.0


def test_read_rides_rejects_bad_records(spark):
    with pytest.raises(Exception):
        src.read_rides(spark, tmpfile("r.csv", "1,START,2013-01-01 00:00:00\n")).collect()
    with pytest.raises(Exception):
        src.read_rides(spark, tmpfile("r.csv", RIDES_TXT.replace(",1,2013000001", ",x,2013000001", 1))).collect()
    with pytest.raises(Exception):
        src.read_rides(spark, tmpfile("r.csv", RIDES_TXT.replace("START", "BEGIN"))).collect()


def test_read_fares(spark):
    r = src.read_fares(spark, tmpfile("f.csv", "7,1,2,2013-01-01 00:00:00,CSH,,0.5,12.5\n")).first()
    assert (r.rideId, r.paymentType, r.tip, r.tolls, r.totalFare) == (7, "CSH", 0.0, 0.5, 12.5)


def test_ride_line_round_trip(spark):
    rides = fx.rides(spark, SF_SMALL)
    back = src.line_to_ride(src.ride_to_line(rides))
    key = ["rideId", "isStart"]
    a = rides.withColumn("startTime", F.date_trunc("second", "startTime")) \
        .withColumn("endTime", F.date_trunc("second", "endTime")) \
        .withColumn("eventTime", F.date_trunc("second", "eventTime"))
    assert sorted(a.orderBy(key).collect()) == sorted(back.orderBy(key).collect())


def test_car_events(spark):
    tokens = [str(i) for i in range(23)]
    tokens[0], tokens[1] = "car7", "e1"
    tokens[9], tokens[12], tokens[20], tokens[21] = "0", "1.5", "-73.9", "40.7"
    tokens[22] = "2017-03-01T10:00:00+0100"
    line = ", ".join(tokens[:10]) + ";" + ",".join(tokens[10:])
    p = tmpfile("c.txt", line + "\n")
    r = src.read_car_events(spark, p).first()
    assert (r.carId, r.id, r.speed, r.throttle) == ("car7", "e1", 0.0, 1.5)
    assert r.eventTime == dt.datetime(2017, 3, 1, 9, 0)
    with pytest.raises(Exception):
        src.read_car_events(spark, tmpfile("c.txt", "a,b,c\n")).collect()


def test_mail_records_round_trip(spark):
    mails = fx.mails(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="ts-mail-")
    src.write_mails(mails, os.path.join(d, "m"))
    back = src.read_mails(spark, os.path.join(d, "m"))
    assert sorted(back.collect()) == sorted(mails.collect())
    two = src.read_mails(spark, os.path.join(d, "m"), ["messageId", "body"])
    assert two.columns == ["messageId", "body"]


MBOX = """From dev-return-1-list=example.org@example.org Mon Mar  2 10:00:00 2015
Subject: hello
From: Ann <ann@example.org>
Message-ID: <1@x>

Hi there, this is a long li=
ne.
Bye

From dev-return-2-list=example.org@example.org Tue Mar  3 11:30:05 2015
subject: re: hello
FROM: Bob <bob@example.org>
message-id: <2@x>
In-Reply-To: <1@x>

Answer
From dev-return-3-list=example.org@example.org Tue Mar  3 11:31:00 2015
From: Carl <carl@example.org>
Message-ID: <3@x>

no subject here
From dev-return-4-list=example.org@example.org Tue Mar  3 11:32:00 2015
Subject: has #|# delimiter
From: Dan <dan@example.org>
Message-ID: <4@x>

x
"""


def test_ingest_mbox(spark):
    out = {r.messageId: r for r in src.ingest_mbox(spark, tmpfile("a.mbox", MBOX)).collect()}
    assert sorted(out) == ["<1@x>", "<2@x>"]
    a, b = out["<1@x>"], out["<2@x>"]
    assert a.time == "2015-03-02-10:00:00" and a.sender == "Ann <ann@example.org>"
    assert a.body == "\nHi there, this is a long line.\nBye\n" and a.replyTo == "null"
    assert b.subject == "re: hello" and b.replyTo == "<1@x>" and b.time == "2015-03-03-11:30:05"


def test_edges_and_pagerank(spark):
    p = tmpfile("e.tsv", "a\tb\t1.0\nb\tc\t2.0\nc\ta\t1.0\na\tc\t3.0\nb\ta\t2.0\n")
    edges = src.read_edges(spark, p)
    ranks = {r.vertex: r.rank for r in op.weighted_pagerank(edges, 20, 0.85, checkpoint_every=3).collect()}
    # power iteration in plain Python
    e = [("a", "b", 1.0), ("b", "c", 2.0), ("c", "a", 1.0), ("a", "c", 3.0), ("b", "a", 2.0)]
    tot = {}
    for s, _, w in e:
        tot[s] = tot.get(s, 0) + w
    r = {v: 1 / 3 for v in "abc"}
    for _ in range(20):
        nxt = {v: 0.15 / 3 for v in "abc"}
        for s, t, w in e:
            nxt[t] += 0.85 * r[s] * w / tot[s]
        r = nxt
    assert all(abs(ranks[v] - r[v]) < 1e-12 for v in "abc")
    d = tempfile.mkdtemp(prefix="ts-tsv-")
    src.write_tsv(op.weighted_pagerank(edges, 2), os.path.join(d, "out"))
    assert len(spark.read.option("sep", "\t").csv(os.path.join(d, "out")).collect()) == 3


def test_raw_trip_and_fare_conversion(spark):
    trip = ["m1", "h1", "VTS", "1", "N", "2013-01-01 00:00:00", "2013-01-01 00:10:00", "2", "600", "1.5",
            "-73.99", "40.75", "-73.98", "40.76\r"]
    raw = spark.createDataFrame([tuple(trip) + (42,)], [f"_c{i}" for i in range(14)] + ["id"])
    raw = raw.withColumn("_c0", F.lit("11")).withColumn("_c1", F.lit("22"))
    ev = src.trips_to_ride_events(raw, "id").collect()
    assert [(r.rideId, r.isStart) for r in ev] == [(42, True), (42, False)]
    assert ev[1].endTime == dt.datetime(2013, 1, 1, 0, 10) and ev[1].endLat == pytest.approx(40.76, 1e-6)
    fare = ["11", "22", "VTS", "2013-01-01 00:00:00", "CRD", "1", "0.5", "0.5", "2.0", "0", "12.5\r"]
    rf = spark.createDataFrame([tuple(fare) + (42,)], [f"_c{i}" for i in range(11)] + ["id"])
    f = src.raw_fares_to_fares(rf, "id").first()
    assert (f.rideId, f.taxiId, f.driverId, f.paymentType, f.tip, f.tolls, f.totalFare) == \
        (42, 11, 22, "CRD", 2.0, 0.0, 12.5)


def test_catalog_and_table_options(spark):
    rp = tmpfile("r.csv", RIDES_TXT)
    cat = src.register_catalog(spark, rp, "/nonexistent/fares.csv")
    assert cat.list_tables() == ["TaxiRides"]
    with pytest.raises(KeyError):
        cat.get_table("TaxiFares")
    assert spark.sql(f"select count(*) c from {cat.view_name('TaxiRides')}").first().c == 2
    assert cat.sql("select count(*) c from nyc.TaxiRides where rideId > 0").first().c == 2
    # names are resolved by the parser: case, aliases, literals and patterns
    for text, want in (("select count(*) c from NYC.taxirides", 2), ("select count(*) c from nyc.TaxiRides as r where r.rideId > 0", 2),
                       ("select count(*) c from nyc.TaxiRides where 'nyc.TaxiRides' = concat('nyc', '.TaxiRides')", 2),
                       ("select count(*) c from `nyc`.`TaxiRides` where 'xn' rlike 'n{1}'", 2)):
        assert cat.sql(text).first().c == want
    plain = src.ride_table(src.read_rides(spark, rp))
    assert sorted(map(tuple, cat.get_table("TaxiRides").select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    again = src.register_catalog(spark, rp, None)        # same names, the same file again
    assert again.get_table("TaxiRides").count() == 2
    with pytest.raises(ValueError):
        src.register_table(spark, "bad", "taxi-rides", {"path": rp, "max-event-delay-secs": -1})
    t = src.register_table(spark, "rides_opt", "taxi-rides", {"path": rp, "max-event-delay-secs": 60})
    assert "eventTime" in t.columns and "startTime" not in t.columns


def test_sink_shapes(spark):
    places = spark.createDataFrame([(-73.99, 40.75, dt.datetime(2020, 1, 1), True, 3)],
                                   "lon float, lat float, windowEnd timestamp, isStart boolean, cnt long")
    doc = json.loads(src.places_to_documents(places).first().document)
    assert doc["isStart"] == "true" and doc["cnt"] == "3" and doc["time"] == "1577836800000"
    assert doc["location"].startswith("40.75") and "," in doc["location"]
    pts = src.to_points(places, "places", "cnt", "windowEnd", "cnt", "isStart").first()
    assert (pts.measurement, pts.timeMs, pts.value, pts.key) == ("places", 1577836800000, 3.0, "true")


def test_query_lines(spark):
    lines = spark.createDataFrame([("-73.99, 40.75",), ("-74.0,41.0",)], "value string")
    q = src.location_queries_from_lines(lines).collect()
    assert [(round(r.longitude, 2), round(r.latitude, 2)) for r in q] == [(-73.99, 40.75), (-74.0, 41.0)]
    assert len({r.queryId for r in q}) == 2
    own = src.location_queries_from_lines(lines.selectExpr("*", "length(value) id"), id_col="id").collect()
    assert [r.queryId for r in own] == [r.id for r in lines.selectExpr("length(value) id").collect()]
    m = src.minutes_queries_from_lines(spark.createDataFrame([(" 30",)], "value string")).first()
    assert m.minutes == 30
