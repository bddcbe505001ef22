"""Row shaping for external sinks.

The index and time-series clients are not part of this library; these
functions produce the documents / points as columns, and ``foreach_batch_sink``
hands each micro-batch to a caller-supplied writer (exactly the place where a
client library would be called).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def places_to_documents(places: DataFrame) -> DataFrame:
    """Popular-place rows → JSON documents {time, location "lat,lon", isStart, cnt},
    all values as strings (time in epoch milliseconds)."""
    doc = F.struct(F.unix_millis("windowEnd").cast("string").alias("time"),
                   F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")).alias("location"),
                   F.col("isStart").cast("string").alias("isStart"),
                   F.col("cnt").cast("string").alias("cnt"))
    return places.select(F.to_json(doc).alias("document"))


def to_points(df: DataFrame, measurement: str, field: str, time_col: str, value_col: str,
              key_col: str | None = None) -> DataFrame:
    """Rows → time-series points (measurement, time ms, field value, optional key tag)."""
    cols = [F.lit(measurement).alias("measurement"), F.unix_millis(time_col).alias("timeMs"),
            F.lit(field).alias("field"), F.col(value_col).cast("double").alias("value")]
    if key_col:
        cols.append(F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def foreach_batch_sink(stream: DataFrame, writer, checkpoint: str, mode: str = "append"):
    """Start a streaming query whose micro-batches go to ``writer(batch_df, batch_id)``."""
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(writer).start())
