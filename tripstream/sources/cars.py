"""Connected-car text source (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.util import spread

# Token positions in a 23-field car record.
CAR_ID, EVENT_ID, CONSUMPTION, SPEED, THROTTLE, ENGINE_LOAD, LON, LAT, TIME = 0, 1, 7, 9, 12, 19, 20, 21, 22


def parse_car_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    tok = F.split(F.col(col), r"(,|;)\s*")
    checked = F.when(F.size(tok) == 23, tok).otherwise(
        F.raise_error(F.concat(F.lit("Invalid record: "), F.col(col))))
    t = lines.select(checked.alias("t"))

    def num(i):
        v = F.element_at("t", i + 1)
        return F.when(F.length(v) > 0, v.cast("float")).otherwise(F.lit(0.0).cast("float"))

    return t.select(
        F.element_at("t", EVENT_ID + 1).alias("id"), F.element_at("t", CAR_ID + 1).alias("carId"),
        F.to_timestamp(F.element_at("t", TIME + 1), "yyyy-MM-dd'T'HH:mm:ssZ").alias("eventTime"),
        num(LON).alias("longitude"), num(LAT).alias("latitude"), num(CONSUMPTION).alias("consumption"),
        num(SPEED).cast("double").alias("speed"), num(THROTTLE).cast("double").alias("throttle"),
        num(ENGINE_LOAD).alias("engineload"))


def read_car_events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """S3: text lines split on comma or semicolon (+ blanks); exactly 23 tokens."""
    lines = (spark.readStream if streaming else spark.read).text(path)
    ev = parse_car_lines(lines)
    return ev if streaming else spread(ev)
