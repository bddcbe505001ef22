import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import MUSEUM, POLE, STATION
from tripstream.functions import (address_of, cells_on_way, direction_angle, direction_bucket,
                                  distance_km, is_in_nyc, month_of, to_cell_id, to_coords, tokens)
from tripstream.functions.geo import _cells_on_way_batch
from tripstream.functions.sql import register_sql_functions


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_is_in_nyc(spark):
    r = one(spark, is_in_nyc(F.lit(STATION[0]).cast("float"), F.lit(STATION[1]).cast("float")),
            is_in_nyc(F.lit(POLE[0]).cast("float"), F.lit(POLE[1]).cast("float")),
            is_in_nyc(F.lit(-74.05), F.lit(41.0)))
    assert tuple(r) == (True, False, True)


def test_cell_and_coords_roundtrip(spark):
    lon, lat = F.lit(STATION[0]).cast("float"), F.lit(STATION[1]).cast("float")
    r = one(spark, to_cell_id(lon, lat).alias("c"), to_coords(to_cell_id(lon, lat)).alias("p"))
    x = math.floor((74.05 - abs(float(np.float32(STATION[0])))) / 0.0014)
    y = math.floor((41.0 - float(np.float32(STATION[1]))) / 0.00125)
    assert r.c == x + 250 * y
    assert abs(r.p.lon - STATION[0]) < 0.0014 and abs(r.p.lat - STATION[1]) < 0.00125


def test_sql_functions_match_columns(spark):
    register_sql_functions(spark)
    lon, lat = MUSEUM
    r = spark.sql(f"select toCellId(cast({lon} as float), cast({lat} as float)) c, "
                  f"toAreaId(cast({lon} as float), cast({lat} as float)) a, "
                  f"isInNYC(cast({lon} as float), cast({lat} as float)) n").first()
    c = one(spark, to_cell_id(F.lit(lon).cast("float"), F.lit(lat).cast("float")))[0]
    assert r.c == c == r.a and r.n


def _f32(v):
    return float(np.float32(v))


def test_distance_and_direction(spark):
    r = one(spark, distance_km(F.lit(STATION[0]).cast("float"), F.lit(STATION[1]).cast("float"),
                               F.lit(MUSEUM[0]).cast("float"), F.lit(MUSEUM[1]).cast("float")).alias("d"),
            direction_angle(F.lit(STATION[0]).cast("float"), F.lit(STATION[1]).cast("float"),
                            F.lit(MUSEUM[0]).cast("float"), F.lit(MUSEUM[1]).cast("float")).alias("a"))
    x = float(np.float32(_f32(STATION[1]) - _f32(MUSEUM[1])))
    y = float(np.float32(_f32(STATION[0]) - _f32(MUSEUM[0]))) * math.cos(_f32(MUSEUM[1]))
    assert abs(r.d - 110.25 * math.sqrt(x * x + y * y)) < 1e-9
    dx = float(np.float32(_f32(MUSEUM[1]) - _f32(STATION[1])))
    dy = float(np.float32(_f32(MUSEUM[0]) - _f32(STATION[0]))) * math.cos(_f32(STATION[1]))
    assert r.a == int(math.degrees(math.atan2(dx, dy))) + 179
    b = one(spark, direction_bucket(F.lit(-1)), direction_bucket(F.lit(359)), direction_bucket(F.lit(90)))
    assert tuple(b) == (0, 7, 2)


def _walk_one(lon1, lat1, lon2, lat2, limit=100000):
    """Row-at-a-time brute-force grid walk, used only to check the vectorised one."""
    def g(lon, lat):
        lon, lat = _f32(lon), _f32(lat)
        return math.floor((74.05 - abs(lon)) / 0.0014), math.floor((41.0 - lat) / 0.00125)
    x1, y1 = g(lon1, lat1)
    x2, y2 = g(lon2, lat2)
    if x1 <= x2:
        sx, sy, ex, ey = x1, y1, x2, y2
    else:
        sx, sy, ex, ey = x2, y2, x1, y1
    slope = (ey - sy) / ((ex - sx) + 0.00000001)
    cx, cy = sx, sy
    out = [cx + cy * 250]
    steps = 0
    while (cx < ex or cy != ey) and steps < limit:
        if slope > 0:
            y = (cx - sx + 0.5) * slope + sy - 0.5
            if curY_near(y, cy):
                cx += 1; cy += 1
            elif y < cy:
                cx += 1
            else:
                cy += 1
            if cx > ex or cy > ey:
                out.append(cx + cy * 250)
                break
        else:
            y = (cx - sx + 0.5) * slope + sy + 0.5
            if curY_near(y, cy):
                cx += 1; cy -= 1
            if y > cy:
                cx += 1
            else:
                cy -= 1
            if cx > ex or cy < ey:
                out.append(cx + cy * 250)
                break
        out.append(cx + cy * 250)
        steps += 1
    return out


def curY_near(y, cy):
    return cy - 0.05 < y < cy + 0.05


def test_cells_on_way_against_brute_force(spark):
    rng = np.random.default_rng(7)
    pts = [(STATION[0], STATION[1], MUSEUM[0], MUSEUM[1]), (MUSEUM[0], MUSEUM[1], STATION[0], STATION[1]),
           (-74.0, 40.7, -74.0, 40.8), (-74.0, 40.7, -73.9, 40.7)]
    for _ in range(300):
        pts.append(tuple(float(v) for v in (rng.uniform(-74.05, -73.7), rng.uniform(40.5, 41.0),
                                             rng.uniform(-74.05, -73.7), rng.uniform(40.5, 41.0))))
    cols = list(zip(*pts))
    got = _cells_on_way_batch(*(pd.Series(c) for c in cols))
    for p, g in zip(pts, got):
        assert list(g) == _walk_one(*p), p
    df = spark.createDataFrame([tuple(np.float32(v).item() for v in p) for p in pts[:20]],
                               "a float, b float, c float, d float")
    rows = df.select(cells_on_way("a", "b", "c", "d").alias("cells")).collect()
    assert [r.cells for r in rows] == [_walk_one(*p) for p in pts[:20]]


def test_text_helpers(spark):
    r = one(spark, month_of(F.lit("2015-03-05-10:00:00")).alias("m"),
            address_of(F.lit("Jane Doe <jane@example.org>")).alias("a"),
            tokens(F.lit("The Quick, brown fox\tis  QUICK message be, x1 fox\nend")).alias("t"))
    assert r.m == "2015-03" and r.a == "jane@example.org"
    assert r.t == ["brown", "fox", "quick", "fox", "end"]


def test_sql_distance_equals_column_form(spark):
    register_sql_functions(spark)
    a = spark.sql(f"select distanceKm(cast({STATION[0]} as float), cast({STATION[1]} as float), "
                  f"cast({MUSEUM[0]} as float), cast({MUSEUM[1]} as float)) d").first().d
    b = one(spark, distance_km(F.lit(STATION[0]).cast("float"), F.lit(STATION[1]).cast("float"),
                               F.lit(MUSEUM[0]).cast("float"), F.lit(MUSEUM[1]).cast("float")))[0]
    assert a == b
