"""Car operators against brute-force Python on random data with ties and a hot car."""

import datetime as dt
import random
import statistics

from tripstream import operators as op

T0 = dt.datetime(2022, 1, 1)


def events(spark, n=500, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        car = "hot" if rnd.random() < 0.6 else f"c{rnd.randint(1, 3)}"
        t = T0 + dt.timedelta(seconds=rnd.choice([rnd.randint(0, 20000), 600 * rnd.randint(0, 30)]))
        speed = 0.0 if rnd.random() < 0.15 else float(rnd.randint(1, 90))
        rows.append((str(i), car, t, speed, rnd.random() * 10))
    df = spark.createDataFrame(rows, "id string, carId string, eventTime timestamp, speed double, throttle double")
    return df, rows


def stats(evs):
    th = [e[4] for e in evs]
    err = round(statistics.pstdev(th), 6)
    k = int(err / 2.5)
    return (len(evs), min(e[2] for e in evs), int(max(e[3] for e in evs)), err,
            "calm" if k == 0 else "busy" if k == 1 else "crazy")


def by_car(rows):
    cars = {}
    for r in rows:
        cars.setdefault(r[1], []).append(r)
    for v in cars.values():
        v.sort(key=lambda r: (r[2], r[0]))
    return cars


def test_sessions_match_brute_force(spark):
    df, rows = events(spark)
    gap = dt.timedelta(seconds=300)
    want = []
    for car, evs in by_car(rows).items():
        cur = [evs[0]]
        for prev, e in zip(evs, evs[1:]):
            if e[2] - prev[2] > gap:
                want.append((car,) + stats(cur))
                cur = []
            cur.append(e)
        want.append((car,) + stats(cur))
    got = op.driving_sessions(df, "300 seconds", bucket="17 minutes")
    cols = ["carId", "length", "startTime", "maxSpeed", "erraticness", "erraticnessDesc"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(want)


def test_segments_match_brute_force(spark):
    df, rows = events(spark, seed=9)
    want6, want7 = [], []
    for car, evs in by_car(rows).items():
        stops = sorted({e[2] for e in evs if e[3] == 0.0})
        prev = None
        for s in stops:
            seg = [e for e in evs if e[2] < s and (prev is None or e[2] > prev)]
            if seg:
                want6.append((car, s) + stats(seg))
                if prev is not None:
                    want7.append((car, s) + stats(seg))
            prev = s
    cols = ["carId", "stopTime", "length", "startTime", "maxSpeed", "erraticness", "erraticnessDesc"]
    got6 = op.driving_segments(df, bucket="23 minutes").select(*cols).collect()
    got7 = op.driving_segments_between_stops(df, bucket="23 minutes").select(*cols).collect()
    assert sorted(tuple(r) for r in got6) == sorted(want6)
    assert sorted(tuple(r) for r in got7) == sorted(want7)


def test_sort_rank_is_event_time_order(spark):
    df, rows = events(spark, seed=3)
    got = {(r.carId, r.rank): r.id for r in op.sort_car_events(df, bucket="7 minutes").collect()}
    for car, evs in by_car(rows).items():
        assert [got[(car, i + 1)] for i in range(len(evs))] == [e[0] for e in evs]


def test_session_gap_boundary(spark):
    """Events exactly `gap` apart share a session; a gap one second longer splits."""
    t = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [("1", "c", t(0), 5.0, 1.0), ("2", "c", t(15), 6.0, 1.0), ("3", "c", t(31), 7.0, 1.0)]
    df = spark.createDataFrame(rows, "id string, carId string, eventTime timestamp, speed double, throttle double")
    got = sorted((r.startTime, r.length) for r in op.driving_sessions(df, "15 seconds").collect())
    assert got == [(t(0), 2), (t(31), 1)]


def test_equal_time_stop_ends_segment_without_the_peer(spark):
    t = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [("1", "c", t(0), 5.0, 1.0), ("2", "c", t(10), 0.0, 1.0), ("3", "c", t(10), 8.0, 1.0),
            ("4", "c", t(20), 9.0, 1.0), ("5", "c", t(30), 0.0, 1.0)]
    df = spark.createDataFrame(rows, "id string, carId string, eventTime timestamp, speed double, throttle double")
    segs = sorted((r.stopTime, r.length, r.maxSpeed) for r in op.driving_segments(df).collect())
    assert segs == [(t(10), 1, 5), (t(30), 1, 9)]
    between = [(r.stopTime, r.length) for r in op.driving_segments_between_stops(df).collect()]
    assert between == [(t(30), 1)]
