"""Location and time queries without pairs: against brute force, and how many rows meet."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, rides_df
from tripstream import operators as op
from tripstream.operators.geoqueries import near_reports, query_distances, running_minima
from tripstream.plans import intervals
from tripstream.plans.intervals import stab
from tripstream.plans.nearest import candidates
from tripstream.sources import fixtures as fx

T0 = dt.datetime(2024, 1, 1)


def points(rng, n, kind):
    out = []
    for k in range(n):
        if kind == "city":
            lon, lat = rng.gauss(-73.97, 0.05), rng.gauss(40.75, 0.05)
        elif kind == "clusters":
            lon, lat = rng.choice([(-73.9, 40.7), (-73.95, 40.72), (2.35, 48.85)])
            lon, lat = lon + rng.gauss(0, 1e-4), lat + rng.gauss(0, 1e-4)
        elif kind == "flat cosine":          # |cos| runs through 0 near these latitudes
            lon, lat = rng.uniform(-180, 180), rng.choice([1.5708, 42.4115, 4.7, 42.41]) + rng.gauss(0, 1e-3)
        else:
            lon, lat = rng.uniform(-180, 180), rng.uniform(-90, 90)
        out.append((k, float(np.float32(lon)), float(np.float32(lat)), T0 + dt.timedelta(seconds=rng.randrange(n))))
    return out + [(n + k, lon, lat, t) for k, (_, lon, lat, t) in enumerate(rng.sample(out, n // 5))]


def rides_at(spark, pts):
    return rides_df(spark, [(i, i % 7, 1, False, T0, t, t, 0.0, 0.0, lon, lat, 1) for i, lon, lat, t in pts])


def minima(pts, queries):
    """Running minima by hand, in 32-bit coordinates and distances."""
    f = np.float32
    found = []
    order = sorted(pts, key=lambda p: (p[3], p[0]))
    lon, lat = np.array([p[1] for p in order], f), np.array([p[2] for p in order], f)
    for q, qlon, qlat in queries:
        x = (f(qlat) - lat).astype(float)
        y = (f(qlon) - lon).astype(float) * np.cos(lat.astype(float))
        km = (110.25 * np.sqrt(x * x + y * y)).astype(f)
        best = f("inf")
        for p, d in zip(order, km):
            if d < best:
                best = d
                found.append((q, p[0]))
    return sorted(found)


@pytest.mark.parametrize("kind", ["city", "clusters", "flat cosine", "world"])
def test_nearest_taxi_against_brute_force(spark, kind):
    rng = random.Random(len(kind))
    pts = points(rng, 600, kind)
    places = [(lon, lat) for _, lon, lat, _ in rng.sample(pts, 12)]
    queries = [(k, lon + rng.choice([0, 1e-4, 0.3]), lat) for k, (lon, lat) in enumerate(places)] + [(50, 0.0, 90.0), (51, -179.9, -89.0)]
    got = sorted((r["queryId"], r["rideId"]) for r in op.nearest_taxi(rides_at(spark, pts), queries).collect())
    assert got == minima(pts, queries)


def test_few_rows_meet_many_queries(spark):
    """20 000 queries against 4 000 places: the rows that meet are far below all pairs."""
    rng = random.Random(4)
    pts = points(rng, 4000, "city")
    queries = [(k, rng.gauss(-73.97, 0.05), rng.gauss(40.75, 0.05)) for k in range(20_000)]
    q = spark.createDataFrame(queries, "queryId long, qLon double, qLat double").select(
        "queryId", F.col("qLon").cast("float").alias("qLon"), F.col("qLat").cast("float").alias("qLat"))
    met = near_reports(rides_at(spark, pts), q)
    assert met.count() < 0.12 * 20_000 * 4000
    some = queries[::500]
    got = running_minima(met.where("queryId % 500 = 0"), bucket=F.col("_slice"))
    assert sorted((r["queryId"], r["rideId"]) for r in got.collect()) == minima(pts, some)


def test_same_rows_as_all_pairs_on_the_whole_table(spark):
    rides = fx.rides(spark, SF_ORACLE)
    rng = random.Random(1)
    queries = [(k, rng.uniform(-74.1, -73.6), rng.uniform(40.4, 41.1)) for k in range(20)]
    want = running_minima(query_distances(rides, queries))
    got = op.nearest_taxi(rides, queries)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_known_distance_bounds_from_the_start(spark):
    rng = random.Random(9)
    pts = points(rng, 500, "city")
    rides = rides_at(spark, pts)
    q = spark.createDataFrame([(1, -73.97, 40.75, 0.5), (2, -73.97, 40.75, None), (3, -73.9, 40.7, 0.01)],
                              "queryId long, qLon float, qLat float, best float")
    met = near_reports(rides, q, best="best")
    rows = running_minima(met.where("best IS NULL OR km < best"), bucket=F.col("_slice")).collect()
    all_ = running_minima(query_distances(rides, [(1, -73.97, 40.75), (2, -73.97, 40.75), (3, -73.9, 40.7)])).collect()
    want = sorted((r["queryId"], r["rideId"]) for r in all_ if r["km"] < {1: np.float32(0.5), 2: math.inf, 3: np.float32(0.01)}[r["queryId"]])
    assert sorted((r["queryId"], r["rideId"]) for r in rows) == want
    counts = {r["queryId"]: r["count"] for r in met.groupBy("queryId").count().collect()}
    assert counts.get(1, 0) < counts[2]


def test_nulls_and_empty_inputs(spark):
    rides = rides_at(spark, points(random.Random(2), 20, "city"))
    assert op.nearest_taxi(rides.where("false"), [(1, 0.0, 0.0)]).count() == 0
    assert op.nearest_taxi(rides, spark.createDataFrame([], "queryId long, longitude double, latitude double")).count() == 0
    odd = rides.withColumn("endLon", F.when(F.col("rideId") % 2 == 0, F.col("endLon")))
    assert all(r["rideId"] % 2 == 0 for r in op.nearest_taxi(odd, [(1, -73.9, 40.7), (2, None, 1.0)]).collect())


def test_stab_finds_each_pair_once(spark):
    rng = random.Random(6)
    rows = [(k, s, s + rng.choice([0, 1, 5, 1000, 1 << 20, (1 << 20) + 1, 1 << 33, 1 << 45]))
            for k in range(300) for s in [rng.randrange(1 << 50)]] + [(900, None, 5), (901, 5, None), (902, -500, 500), (903, 9, 3)]
    marks = [(k, rng.choice([r[1] or 0, (r[2] or 0), (r[2] or 0) - 1, rng.randrange(1 << 50)])) for k, r in enumerate(rows)] + [(999, None), (998, -1)]
    got = stab(spark.createDataFrame(rows, "k long, s long, e long"), spark.createDataFrame(marks, "m long, t long"), "s", "e", "t")
    want = sorted((k, m) for k, s, e in rows for m, t in marks if None not in (s, e, t) and s <= t < e)
    assert sorted((r["k"], r["m"]) for r in got.collect()) == want


def test_ongoing_rides_for_many_queries(spark):
    rides = fx.rides(spark, SF_ORACLE).cache()
    rng = random.Random(3)
    queries = [(k, rng.choice([0, 5, 60, 600]), str(T0 + dt.timedelta(seconds=rng.randrange(32 * 86400)))) for k in range(20_000)]
    got = op.ongoing_rides_for_queries(rides, queries)
    by_query = {r["queryId"]: r["count"] for r in got.groupBy("queryId").count().collect()}
    for q, minutes, at in rng.sample(queries, 6) + [queries[0]]:
        want = op.ongoing_rides(rides, minutes, at)
        assert by_query.get(q, 0) == want.count()
    q, minutes, at = next(x for x in queries if x[1] == 60 and by_query.get(x[0]))
    assert sorted(map(tuple, got.where(F.col("queryId") == q).drop("queryId").collect())) == \
        sorted(map(tuple, op.ongoing_rides(rides, minutes, at).collect()))
    assert op.ongoing_rides_for_queries(rides, []).count() == 0


@pytest.mark.parametrize("few", [0, 10_000])
def test_stab_of_counted_intervals(spark, monkeypatch, few):
    monkeypatch.setattr(intervals, "FEW", few)
    rng = random.Random(7)
    rows = [(k, s, s + rng.choice([0, 1, 1 << 20, (1 << 30) + 1, 1 << 55])) for k in range(200) for s in [rng.randrange(1 << 40)]]
    rows += [(900, None, 5), (901, 5, None), (902, -500, 500)]
    marks = [(k, rng.randrange(1 << 41)) for k in range(200)] + [(k + 500, r[1]) for k, r in enumerate(rows)] + [(999, -1)]
    points = spark.createDataFrame(marks, "m long, t long")
    got = stab(spark.createDataFrame(rows, "k long, s long, e long"), points, "s", "e", "t", counted=True)
    want = sorted((k, m) for k, s, e in rows for m, t in marks if None not in (s, e, t) and s <= t < e)
    assert sorted((r["k"], r["m"]) for r in got.collect()) == want
    none = spark.createDataFrame([(1, 5, 5)], "k long, s long, e long")
    assert stab(none, points, "s", "e", "t", counted=True).collect() == []


@pytest.mark.parametrize("few", [0, 10_000])
def test_rides_of_a_small_file_are_not_broadcast(spark, tmp_path, monkeypatch, few):
    """Read from a file whose estimated size is far below the threshold of a broadcast."""
    monkeypatch.setattr(intervals, "FEW", few)
    rng = random.Random(3)
    pts = points(rng, 300, "city")
    rides_at(spark, pts).write.parquet(f"{tmp_path}/rides")
    rides = spark.read.parquet(f"{tmp_path}/rides")
    queries = [(k, -73.97, 40.75, str(T0 + dt.timedelta(seconds=k))) for k in range(3)]
    found = op.nearest_taxi_ttl(rides, queries)
    lines = found._jdf.queryExecution().sparkPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    below = lambda n: range(n, next((k for k in range(n + 1, len(lines)) if depth[k] <= depth[n]), len(lines)))
    assert any("FileScan" in line for line in lines)
    for n, line in enumerate(lines):
        if "BroadcastHashJoin" in line:
            sides = [k for k in below(n) if depth[k] == depth[n + 1]]
            sent = below(sides[0] if "BuildLeft" in line else sides[-1])
            assert not any("FileScan" in lines[k] for k in sent), "\n".join(lines)
    want = [m for q, lon, lat, at in queries for m in minima([p for p in pts if str(p[3]) >= at], [(q, lon, lat)])]
    assert sorted((r["queryId"], r["rideId"]) for r in found.collect()) == want
