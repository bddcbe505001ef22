"""Long-ride alerts (T8–T10), batch form.

A START is reported when no END of the same ride arrives within the limit.
T8 accepts an END exactly at start + limit, the pattern form T10 does not.
The streaming form with state and event-time timers is in
``tripstream.streaming.jobs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rides import clean_rides


def long_rides(rides: DataFrame, limit_minutes: int = 120, strict: bool = False) -> DataFrame:
    starts = rides.filter(F.col("isStart")).alias("s")
    ends = rides.filter(~F.col("isStart")).select("rideId", F.col("eventTime").alias("endAt")).alias("e")
    deadline = F.col("s.eventTime") + F.make_dt_interval(mins=F.lit(int(limit_minutes)))
    in_time = F.col("e.endAt") < deadline if strict else F.col("e.endAt") <= deadline
    return starts.join(ends, (F.col("s.rideId") == F.col("e.rideId")) & in_time, "left_anti")


def long_rides_clean(rides: DataFrame, limit_minutes: int = 120) -> DataFrame:
    """T8 over the cleansed rides."""
    return long_rides(clean_rides(rides), limit_minutes)


def long_rides_pattern(rides: DataFrame, limit_minutes: int = 120) -> DataFrame:
    """START followed by END within the limit (exclusive); timed-out STARTs."""
    return long_rides(rides, limit_minutes, strict=True)
