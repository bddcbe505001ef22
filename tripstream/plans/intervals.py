"""Point-in-interval joins without pairs of rows that do not meet.

An interval [start, end) goes to the level k of the smallest power of two that is
not shorter, where it touches at most two buckets of 2^k; a point goes to its
bucket at every level. The two meet in an equi-join on (level, bucket) with the
exact bounds as a residual, so each pair that matches is found once, and the
rows moved are two per interval and some ``LEVELS`` per point. A bucket holds
only intervals of about its own length that begin near the point; buckets with
many rows are split by adaptive execution.

Spark's size estimate leaves out the rows that ``explode`` adds: it takes the points
at all levels for as small as their file and would broadcast them, whole, through the
driver. Intervals that are counted before the plan is made (``counted``) rule that out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Levels for times in microseconds: from about a second to about 70 years.
LOWEST, LEVELS = 20, 32
#: Counted intervals that are broadcast; more of them meet the points in a merge join.
FEW = 10_000


def stab(intervals: DataFrame, points: DataFrame, start: str, end: str, at: str, counted: bool = False) -> DataFrame:
    """Every pair with start <= at < end (long columns; ``intervals`` and ``points``
    share no column name). Empty intervals and nulls meet nothing. ``counted``: the
    intervals are a table (such as a checkpoint) and read once before: the points go
    only to the levels that there are and are never broadcast."""
    kept = intervals.where(F.col(end) > F.col(start))
    # bits of (length - 1): the least k with 2^k >= length
    bits = F.length(F.bin(F.col(end) - F.col(start) - 1))
    level = F.least(F.greatest(bits, F.lit(LOWEST)), F.lit(LOWEST + LEVELS - 1))
    kept = kept.withColumn("_level", level)
    first = F.expr(f"shiftright({start}, _level)")
    last = F.expr(f"shiftright({end} - 1, _level)")
    kept = kept.withColumn("_bucket", F.explode(F.sequence(first, last)))
    levels = F.sequence(F.lit(LOWEST), F.lit(LOWEST + LEVELS - 1))
    if counted:
        # LEVELS numbers at most
        seen = kept.agg(F.collect_set("_level").alias("levels"), F.count("*").alias("rows")).first()
        levels = F.array(*[F.lit(k) for k in sorted(seen["levels"])]).cast("array<int>")
        kept = F.broadcast(kept) if seen["rows"] <= FEW else kept.hint("merge")
    wide = points.withColumn("_l", F.explode(levels)) \
        .withColumn("_b", F.expr(f"shiftright({at}, _l)"))
    met = kept.join(wide, (F.col("_level") == F.col("_l")) & (F.col("_bucket") == F.col("_b"))
                    & (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end)))
    return met.drop("_level", "_bucket", "_l", "_b")
