import datetime as dt

from conftest import MUSEUM, POLE, STATION, at, fare, fares_df, ride, rides_df
from tripstream import operators as op


def test_cleansing(spark):
    rows = [ride(1, True, 0, start=STATION, end=STATION), ride(2, True, 0, start=STATION, end=POLE),
            ride(3, True, 0, start=POLE, end=STATION), ride(4, True, 0, start=POLE, end=POLE)]
    out = op.clean_rides(rides_df(spark, rows)).collect()
    assert [r.rideId for r in out] == [1]


def test_popular_places_threshold_two(spark):
    rows = [ride(1, True, 0, start=STATION, end=MUSEUM), ride(2, True, 6, start=STATION, end=MUSEUM),
            ride(3, True, 14, start=STATION, end=MUSEUM)]
    rows += [ride(10 + i, False, 0, 15, start=STATION, end=MUSEUM) for i in range(3)]
    out = op.popular_places(rides_df(spark, rows), threshold=2).collect()
    got = sorted((r.lon, r.lat, r.windowEnd, r.isStart, r.cnt) for r in out)
    station = [(at(10), True, 2), (at(15), True, 3), (at(20), True, 2)]
    museum = [(at(20), False, 3), (at(25), False, 3), (at(30), False, 3)]
    assert sorted((w, s, c) for _, _, w, s, c in got) == sorted(station + museum)
    for lo, la, _, s, _ in got:
        px, py = STATION if s else MUSEUM
        assert abs(lo - px) < 0.0014 and abs(la - py) < 0.00125


def test_popular_places_sql_matches_dataframe_form(spark):
    rows = [ride(i, i % 2 == 0, i, i + 30, start=STATION, end=MUSEUM) for i in range(40)]
    df = rides_df(spark, rows)
    a = op.popular_places(df, 3, strict=True).select("lon", "lat", "windowEnd", "isStart", "cnt")
    b = op.popular_places_sql(spark, df, 3).drop("windowStart")
    assert sorted(a.collect()) == sorted(b.collect())


def test_tips_summed_by_hour(spark):
    fares = fares_df(spark, [fare(1, 0, 1.0), fare(2, 15, 5.0), fare(3, 90, 10.0)])
    out = op.hourly_tips(fares).collect()
    got = sorted((r.windowEnd, r.driverId, r.tips) for r in out)
    assert got == [(at(60), 1, 6.0), (at(120), 1, 10.0)]


def test_tip_leader(spark):
    fares = fares_df(spark, [fare(1, 0, 1.0), fare(2, 15, 5.0), fare(3, 90, 10.0),
                             fare(4, 90, 20.0, driver=2)])
    out = op.hourly_tip_leader(fares).collect()
    assert sorted((r.windowEnd, r.driverId, r.tips) for r in out) == [(at(60), 1, 6.0), (at(120), 2, 20.0)]


def test_tip_leader_tie_goes_to_lowest_driver(spark):
    fares = fares_df(spark, [fare(1, 0, 3.0, driver=7), fare(2, 5, 3.0, driver=4)])
    out = op.hourly_tip_leader(fares).collect()
    assert [(r.driverId, r.tips) for r in out] == [(4, 3.0)]


def test_enrichment_in_and_out_of_order(spark):
    rides = rides_df(spark, [ride(1, True, 0), ride(2, True, 1)])
    fares = fares_df(spark, [fare(2, 0, 1.0), fare(1, 0, 2.0)])
    out = op.enrich_rides(rides, fares).collect()
    assert sorted((r.rideId, r.tip) for r in out) == [(1, 2.0), (2, 1.0)]


def test_unmatched_fare(spark):
    rides = rides_df(spark, [ride(1, True, 0)])
    fares = fares_df(spark, [fare(2, 0, 1.0), fare(1, 0, 1.0)])
    assert [r.rideId for r in op.unmatched_fares(rides, fares).collect()] == [2]


def test_ongoing_and_latest(spark):
    rows = [ride(1, True, 0, taxi=1), ride(1, False, 0, 20, taxi=1), ride(2, True, 25, taxi=1),
            ride(3, True, 50, taxi=2)]
    df = rides_df(spark, rows)
    latest = {r.taxiId: r.rideId for r in op.latest_per_taxi(df).collect()}
    assert latest == {1: 2, 2: 3}
    out = op.ongoing_rides(df, 30, at(60)).collect()
    assert [r.rideId for r in out] == [2]   # ride 3 started only 10 minutes before


def test_arrivals_window_matches_plain_window(spark):
    from pyspark.sql import Window, functions as F
    rows = [ride(i, False, 0, i * 7, start=STATION, end=MUSEUM if i % 3 else STATION) for i in range(60)]
    df = rides_df(spark, rows)
    got = sorted(tuple(r) for r in op.arrivals_window(df, "30 minutes").collect())
    from tripstream.functions import to_cell_id
    w = Window.partitionBy("c").orderBy(F.unix_micros("eventTime")).rangeBetween(-30 * 60 * 1_000_000, 0)
    ref = (df.filter(~F.col("isStart")).withColumn("c", to_cell_id("endLon", "endLat"))
           .select(F.col("c").cast("string"), "eventTime", F.count(F.lit(1)).over(w)))
    assert got == sorted(tuple(r) for r in ref.collect())


def test_match_rides_predicate(spark):
    rows = [ride(1, True, 0, passengers=5), ride(2, True, 10, passengers=1),
            ride(1, False, 0, 20, passengers=5), ride(3, True, 30, passengers=4, taxi=3)]
    df = rides_df(spark, rows)
    out = op.match_rides(df, "isStart and passengerCnt > 3", rule_time=at(15)).collect()
    assert sorted((r.source, r.rideId) for r in out) == [("PE", 3)]
    out = op.match_rides(df, "passengerCnt > 3", rule_time=at(5)).collect()
    assert sorted((r.source, r.rideId, r.isStart) for r in out) == [
        ("PBE", 1, True), ("PE", 1, False), ("PE", 3, True)]


def test_nearest_taxi_running_minima(spark):
    rows = [ride(1, False, 0, 10, end=MUSEUM, taxi=1), ride(2, False, 0, 20, end=STATION, taxi=2),
            ride(3, False, 0, 30, end=MUSEUM, taxi=3), ride(4, False, 0, 40, end=(-73.98, 40.76), taxi=4)]
    out = op.nearest_taxi(rides_df(spark, rows), [(7, STATION[0], STATION[1])]).collect()
    assert [r.taxiId for r in sorted(out, key=lambda r: r.eventTime)] == [1, 2]
    assert dt.datetime(2020, 1, 1) < out[0].eventTime


def test_taxi_query_rules(spark):
    """Rule text over the ride: `isStart`, and distance of the ride's position < 1 km."""
    started = ride(1, True, 0, start=STATION, end=STATION)
    assert [r.rideId for r in op.match_rides(rides_df(spark, [started]), "isStart").collect()] == [1]
    ended = ride(1, False, 0, 5, start=STATION, end=MUSEUM)
    df = rides_df(spark, [ride(1, True, 0, start=STATION, end=MUSEUM), ended])
    out = op.match_rides(df, f"distanceKm({MUSEUM[0]}, {MUSEUM[1]}, lon, lat) < 1.0").collect()
    assert [(r.rideId, r.isStart) for r in out] == [(1, False)]


def test_nearest_taxi_accepts_bounded_query_table(spark):
    rows = [ride(1, False, 0, 10, end=MUSEUM, taxi=1), ride(2, False, 0, 20, end=STATION, taxi=2)]
    q = spark.createDataFrame([(7, STATION[0], STATION[1])], "queryId int, lon double, lat double")
    a = op.nearest_taxi(rides_df(spark, rows), q).collect()
    b = op.nearest_taxi(rides_df(spark, rows), [(7, STATION[0], STATION[1])]).collect()
    assert sorted(a) == sorted(b)


def test_ongoing_rides_for_several_queries(spark):
    rows = [ride(1, True, 0, taxi=1), ride(1, False, 0, 20, taxi=1), ride(2, True, 25, taxi=1),
            ride(3, True, 50, taxi=2), ride(4, True, 5, taxi=3)]
    df = rides_df(spark, rows)
    qs = [(1, 30, at(60)), (2, 10, at(15)), (3, 5, at(70))]
    got = sorted((r.queryId, r.rideId) for r in op.ongoing_rides_for_queries(df, qs).collect())
    want = sorted((q, r.rideId) for q, m, t in qs for r in op.ongoing_rides(df, m, t).collect())
    assert got == want and len(got) > 0


def test_arrivals_window_counts_duplicate_events_one_by_one(spark):
    """Identical END rows are separate events: each gets its own output row."""
    df = rides_df(spark, [ride(1, False, 0, 10), ride(1, False, 0, 10), ride(2, False, 0, 15), ride(3, False, 0, 30)])
    got = op.arrivals_window(df, "10 minutes").collect()
    assert sorted(r["cnt"] for r in got) == [1, 2, 2, 3]


def test_many_queries_and_rules(spark):
    """Query lists of any length: 20 000 location queries, 2 500 ongoing queries."""
    df = rides_df(spark, [ride(1, True, 0), ride(2, True, 0, taxi=2), ride(2, False, 0, 10, taxi=2)])
    near = op.nearest_taxi(df, [(k, -73.9, 40.7) for k in range(20_000)])
    assert near.count() == 20_000
    ongoing = op.ongoing_rides_for_queries(df, [(k, 5, "2020-01-01 12:30:00") for k in range(2_500)])
    assert ongoing.count() == 2_500 and ongoing.select("taxiId").distinct().collect()[0][0] == 1


def test_thresholds_are_decided_on_exact_values(spark):
    df = fares_df(spark, [fare(1, 0, 25.0), fare(2, 1, 25.0000003)])
    assert op.high_tip_hours(df, 50.0).count() == 1
    assert op.high_tip_hours(df, 50.0000004).count() == 0
