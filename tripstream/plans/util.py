"""Small plan helpers shared by the operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every timestamp column to timestamp_ntz (naive UTC wall time), the
    type the SQL oracle reports for the same columns."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def ts_lit(value) -> Column:
    """Timestamp literal from a datetime or 'yyyy-MM-dd HH:mm:ss' text (UTC)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp")


def interval_seconds(text: str) -> int:
    """Seconds in a duration such as '15 minutes', '12 hours', '1 day'."""
    n, unit = text.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(float(n) * mult)


def drop_path(spark, path: str) -> None:
    """Delete a table that the caller wrote, through the file system of its path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def spread(df: DataFrame, min_partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Round-robin a narrow scan over the cluster before CPU-heavy per-row work.

    Only when the input has fewer splits than the default parallelism (e.g. one
    large single-row-group file); a scan that is already split finely (the
    normal case on a cluster) is left as it is, so no shuffle is added there.
    """
    try:
        sc = df.sparkSession.sparkContext
        target = min_partitions or sc.defaultParallelism
        narrow = df.rdd.getNumPartitions() < target
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no RDD view
        return df
    if not narrow:
        return df
    # hash-partitioning on a unique key also lets a later grouping on
    # (key, ...) reuse this partitioning instead of shuffling again
    return df.repartition(target, key) if key else df.repartition(target)
