"""Grid, distance and direction functions over the city area, as Column expressions.

All functions stay JVM-side (whole-stage codegen); inputs are float columns as in
the ride records, widened to double exactly where the record arithmetic widens.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# City bounding box, grid step and degree length.
LON_EAST = -73.7
LON_WEST = -74.05
LAT_NORTH = 41.0
LAT_SOUTH = 40.5
DELTA_LON = 0.0014
DELTA_LAT = 0.00125
GRID_X = 250
DEG_LEN = 110.25


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dbl(c) -> Column:
    return _col(c).cast("double")


def _flt(c) -> Column:
    return _col(c).cast("float")


def is_in_nyc(lon, lat) -> Column:
    """Inclusive bounding-box test (F1)."""
    lon, lat = _dbl(lon), _dbl(lat)
    return lon.between(LON_WEST, LON_EAST) & lat.between(LAT_SOUTH, LAT_NORTH)


def to_cell_id(lon, lat) -> Column:
    """Grid cell of a point (F2): x + 250 * y, numbered from the north-west corner."""
    x = F.floor((F.lit(abs(LON_WEST)) - F.abs(_dbl(lon))) / F.lit(DELTA_LON))
    y = F.floor((F.lit(LAT_NORTH) - _dbl(lat)) / F.lit(DELTA_LAT))
    return (x + y * GRID_X).cast("int")


def cell_center_lon(cell) -> Column:
    x = _col(cell) % GRID_X
    v = F.lit(abs(LON_WEST)) - x * F.lit(DELTA_LON) - F.lit(DELTA_LON / 2)
    return -(v.cast("float"))


def cell_center_lat(cell) -> Column:
    c = _col(cell)
    y = ((c - c % GRID_X) / GRID_X).cast("int")
    v = F.lit(LAT_NORTH) - y * F.lit(DELTA_LAT) - F.lit(DELTA_LAT / 2)
    return v.cast("float")


def to_coords(cell) -> Column:
    """Cell centre (F3) as struct<lon: float, lat: float>."""
    return F.struct(cell_center_lon(cell).alias("lon"), cell_center_lat(cell).alias("lat"))


def distance_km(lon1, lat1, lon2, lat2) -> Column:
    """Flat-earth distance (F5): differences in float, cosine of the second latitude
    (in degrees passed as radians, as the record arithmetic does)."""
    x = (_flt(lat1) - _flt(lat2)).cast("double")
    y = (_flt(lon1) - _flt(lon2)).cast("double") * F.cos(_dbl(lat2))
    return F.lit(DEG_LEN) * F.sqrt(x * x + y * y)


def direction_angle(start_lon, start_lat, dest_lon, dest_lat) -> Column:
    """Angle of the vector start→destination, shifted by 179 (F6); int truncation."""
    x = (_flt(dest_lat) - _flt(start_lat)).cast("double")
    y = (_flt(dest_lon) - _flt(start_lon)).cast("double") * F.cos(_dbl(start_lat))
    return F.degrees(F.atan2(x, y)).cast("int") + 179


def direction_bucket(angle) -> Column:
    """One of eight 45-degree buckets (F7), truncating division."""
    return (_col(angle) / 45).cast("int")


# ---------------------------------------------------------------------------
# cells crossed by the straight path between two points.
# The walk is sequential per row, so it runs as an Arrow-batched pandas UDF;
# each step is vectorised across all rows of a batch.

def _cells_on_way_batch(lon1, lat1, lon2, lat2) -> list:
    def grid(lon, lat):
        lon = lon.astype(np.float32).astype(np.float64)
        lat = lat.astype(np.float32).astype(np.float64)
        x = np.floor((abs(LON_WEST) - np.abs(lon)) / DELTA_LON).astype(np.int64)
        y = np.floor((LAT_NORTH - lat) / DELTA_LAT).astype(np.int64)
        return x, y
    x1, y1 = grid(lon1.to_numpy(), lat1.to_numpy())
    x2, y2 = grid(lon2.to_numpy(), lat2.to_numpy())
    swap = x1 > x2
    sx = np.where(swap, x2, x1); sy = np.where(swap, y2, y1)
    ex = np.where(swap, x1, x2); ey = np.where(swap, y1, y2)
    slope = (ey - sy) / ((ex - sx) + 0.00000001)
    pos = slope > 0
    cx = sx.copy(); cy = sy.copy()
    n = len(cx)
    # every step appends (row, cell) pairs; rows are regrouped once at the end
    step_rows = [np.arange(n)]
    step_cells = [cx + cy * GRID_X]

    def running(cx, cy):
        # x only grows and y only moves towards one side, so a walk that has
        # passed its end cell in either coordinate can never reach it: stop there.
        passed = (cx > ex) | np.where(pos, cy > ey, cy < ey)
        return ((cx < ex) | (cy != ey)) & ~passed

    active = running(cx, cy)
    while active.any():
        idx = np.nonzero(active)[0]
        ax, ay, s, p = cx[idx], cy[idx], slope[idx], pos[idx]
        yy = (ax - sx[idx] + 0.5) * s + sy[idx] + np.where(p, -0.5, 0.5)
        near = (yy > ay - 0.05) & (yy < ay + 0.05)
        nx = ax.copy(); ny = ay.copy()
        # rising path: diagonal if near, else right if below, else down a row
        m = p & near; nx[m] += 1; ny[m] += 1
        nx[p & ~near & (yy < ay)] += 1
        ny[p & ~near & ~(yy < ay)] += 1
        # falling or flat path: a diagonal step is followed by one more
        # right-or-up step tested against the updated row
        m = ~p & near; nx[m] += 1; ny[m] -= 1
        q = ~p
        right = q & (yy > ny)
        up = q & ~(yy > ny)
        nx[right] += 1
        ny[up] -= 1
        cx[idx] = nx; cy[idx] = ny
        step_rows.append(idx)
        step_cells.append(nx + ny * GRID_X)
        active = running(cx, cy)
    rows = np.concatenate(step_rows)
    cells = np.concatenate(step_cells).astype(np.int32)
    order = np.argsort(rows, kind="stable")          # keeps step order inside a row
    bounds = np.cumsum(np.bincount(rows, minlength=n))[:-1]
    return np.split(cells[order], bounds)


def _ship_by_value():
    # Python workers may not have this package installed: send the walk code
    # with the UDF instead of a reference to this module.
    import sys

    from pyspark import cloudpickle
    try:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except (ValueError, AttributeError):
        pass


def cells_on_way(lon1, lat1, lon2, lat2) -> Column:
    """array<int> of grid cells on the straight path between two points."""
    _ship_by_value()

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _udf(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(_cells_on_way_batch(a, b, c, d))

    return _udf(_col(lon1), _col(lat1), _col(lon2), _col(lat2))
