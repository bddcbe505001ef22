"""Travel-time prediction (B6), batch form.

Per destination cell and direction bucket, a regression through the origin of
travel minutes on distance is learned from END events in ride order; every
START gets int(slope * distance) from the END events before it, or -1 when
fewer than two points (or no spread) are known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import direction_angle, direction_bucket, distance_km, to_cell_id
from ..functions.time import travel_minutes
from ..plans.prefix import duration_bucket, keyed_scan
from .rides import clean_rides

_TINY = 10 * 4.9e-324  # below this |sum(x^2)| the slope is undefined


def predict_travel_time(rides: DataFrame, bucket: str | None = None) -> DataFrame:
    r = clean_rides(rides).select(
        "rideId", "isStart", "eventTime",
        to_cell_id("endLon", "endLat").alias("cell"),
        direction_bucket(direction_angle("endLon", "endLat", "startLon", "startLat")).alias("direction"),
        distance_km("startLon", "startLat", "endLon", "endLat").alias("distance"),
        travel_minutes("startTime", "endTime").alias("minutes"),
        (~F.col("isStart")).alias("_isEnd"))
    end = F.col("_isEnd")
    x, y = F.col("distance"), F.col("minutes")
    scanned = keyed_scan(r, ["cell", "direction"], ["eventTime", "_isEnd", "rideId"],
                         duration_bucket("eventTime", bucket),
                         {"_sxy": ("sum", F.when(end, x * y)),
                          "_sxx": ("sum", F.when(end, x * x)),
                          "_n": ("count", F.when(end, F.lit(1)))},
                         inclusive=False)
    ok = (F.col("_n") >= 2) & (F.abs(F.col("_sxx")) >= F.lit(_TINY))
    raw = F.col("_sxy") / F.col("_sxx") * x
    # int conversion saturates at the int range instead of failing the job
    clamped = F.least(F.greatest(raw, F.lit(-2147483648.0)), F.lit(2147483647.0))
    pred = F.when(ok, clamped.cast("int")).otherwise(F.lit(-1))
    return scanned.filter(F.col("isStart")).select("rideId", "eventTime", "cell", "direction",
                                                   pred.alias("predictedMinutes"))
