"""Registration of the grid and time functions as SQL functions.

They are SQL-bodied temporary functions, so Catalyst inlines their bodies:
predicates built from them are pushed below joins and into scans like any
other expression (no Python UDF boundary).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .geo import DEG_LEN, DELTA_LAT, DELTA_LON, GRID_X, LAT_NORTH, LAT_SOUTH, LON_EAST, LON_WEST


def _defs() -> list[str]:
    west = abs(LON_WEST)
    return [
        f"""CREATE OR REPLACE TEMPORARY FUNCTION isInNYC(lon FLOAT, lat FLOAT) RETURNS BOOLEAN
            RETURN cast(lon AS DOUBLE) BETWEEN {LON_WEST}D AND {LON_EAST}D
               AND cast(lat AS DOUBLE) BETWEEN {LAT_SOUTH}D AND {LAT_NORTH}D""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION toCellId(lon FLOAT, lat FLOAT) RETURNS INT
            RETURN cast(floor(({west}D - abs(cast(lon AS DOUBLE))) / {DELTA_LON}D)
                 + floor(({LAT_NORTH}D - cast(lat AS DOUBLE)) / {DELTA_LAT}D) * {GRID_X} AS INT)""",
        # toAreaId is the same function under a second name
        f"""CREATE OR REPLACE TEMPORARY FUNCTION toAreaId(lon FLOAT, lat FLOAT) RETURNS INT
            RETURN toCellId(lon, lat)""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION toCoords(cell INT)
            RETURNS STRUCT<lon: FLOAT, lat: FLOAT>
            RETURN named_struct(
              'lon', -cast({west}D - (cell % {GRID_X}) * {DELTA_LON}D - {DELTA_LON / 2}D AS FLOAT),
              'lat', cast({LAT_NORTH}D - cast((cell - cell % {GRID_X}) / {GRID_X} AS INT) * {DELTA_LAT}D
                          - {DELTA_LAT / 2}D AS FLOAT))""",
        """CREATE OR REPLACE TEMPORARY FUNCTION timeDiff(a TIMESTAMP, b TIMESTAMP) RETURNS BIGINT
            RETURN unix_millis(b) - unix_millis(a)""",
        # F5 for predicates: distance from (lon1, lat1) to (lon2, lat2)
        f"""CREATE OR REPLACE TEMPORARY FUNCTION distanceKm(lon1 FLOAT, lat1 FLOAT, lon2 FLOAT, lat2 FLOAT)
            RETURNS DOUBLE
            RETURN {DEG_LEN}D * sqrt(
              cast(lat1 - lat2 AS DOUBLE) * cast(lat1 - lat2 AS DOUBLE)
              + (cast(lon1 - lon2 AS DOUBLE) * cos(cast(lat2 AS DOUBLE)))
                * (cast(lon1 - lon2 AS DOUBLE) * cos(cast(lat2 AS DOUBLE))))""",
    ]


def register_sql_functions(spark: SparkSession) -> None:
    for stmt in _defs():
        spark.sql(stmt)
