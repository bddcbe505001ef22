"""Skew-safe running aggregates per key over an ordered stream of rows.

Many jobs need "for each row, an aggregate over the earlier rows of the same
key" (newest customer so far, running minimum distance, regression sums, rank,
next stop). A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a
key into one task, which fails when one key holds a large share of the data.

``keyed_scan`` splits such keys. ``ordered_parts`` numbers ranges of the order of
every key whose share of a bounded sample is above one task's, so a hot key, a
burst and rows of equal time (told apart by the later order columns) spread over
as many parts as their share asks for; all other keys are one part. The bounds
are collected before the plan is built, so they stay the same when a task is run
again, and meet the rows through a broadcast of one row per split key. The rows
move once, by (key, part), for steps 3 and 4; step 1 reads only the columns it
needs and combines them before its exchange:

1. partial aggregate per (key, part);
2. carry-in per (key, part) over earlier parts - a window over the small part
   table (one row per key and part, not per event);
3. running aggregate inside (key, part);
4. combine carry-in and in-part value.

Rows that are equal in all order columns stay together: give a unique last one.
A caller that knows a good monotone bucket of the first order column can pass it
instead.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import interval_seconds

KINDS = ("sum", "count", "min", "max", "last", "next")


#: Sampled rows per shuffle partition, and at most in all.
SAMPLE_PER_PART, SAMPLE_MOST = 60, 100_000


def part_bounds(df: DataFrame, keys: list[str], order: list[str]) -> list[tuple]:
    """(key values, bounds) of every key with more rows than an even task would
    hold: the rows at which its parts after the first begin, in order. From one
    sample of ``SAMPLE_PER_PART`` rows per shuffle partition."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = df.select(*dict.fromkeys([*keys, *order]))
    rows, wanted = narrow.count(), min(SAMPLE_PER_PART * n, SAMPLE_MOST)
    if not rows:
        return []
    sample = narrow.sample(min(1.0, wanted / rows), 7) if wanted < rows else narrow
    # sorted by Spark, so that its order and not Python's decides
    pair = F.struct(F.struct(*keys).alias("k"), F.struct(*order).alias("o"))
    drawn = sample.agg(F.array_sort(F.collect_list(pair)).alias("s")).first()["s"]
    of_key: dict[tuple, list] = {}
    for r in drawn:
        of_key.setdefault(tuple(r["k"]), []).append(r["o"])
    found = []
    for key, places in of_key.items():
        parts = min(math.ceil(2 * n * len(places) / len(drawn)), len(places))
        if len(places) * n > len(drawn) and parts > 1:
            found.append((key, [places[k * len(places) // parts] for k in range(1, parts)]))
    return found


def ordered_parts(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``_part``: along the order (nulls first) of a key's rows the parts
    never decrease, and a key with a large share of the rows has many."""
    found = part_bounds(df, keys, order)
    if not found:
        return df.withColumn("_part", F.lit(0))
    types = {f.name: f.dataType for f in df.schema.fields}
    place = T.StructType([T.StructField(c, types[c]) for c in order])
    schema = T.StructType([*[T.StructField(f"_bk{i}", types[k]) for i, k in enumerate(keys)],
                           T.StructField("_chunks", T.ArrayType(T.ArrayType(place)))])
    rows = []
    for key, bounds in found:
        size = math.isqrt(len(bounds)) + 1
        rows.append((*key, [bounds[i:i + size] for i in range(0, len(bounds), size)]))
    # one row per split key, some two bounds per shuffle partition in all
    table = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    on = None
    for i, k in enumerate(keys):
        same = df[k].eqNullSafe(table[f"_bk{i}"])
        on = same if on is None else on & same
    at = F.struct(*[F.col(c) for c in order])
    # bounds come in chunks: first the chunk by its first bound, then the bound in it
    joined = df.join(table, on, "left").withColumn(
        "_chunk", F.size(F.filter(F.transform("_chunks", lambda c: c[0]), lambda b: b <= at)))
    before = F.aggregate(F.slice("_chunks", F.lit(1), F.col("_chunk") - 1), F.lit(0), lambda n, c: n + F.size(c))
    inside = F.size(F.filter(F.get("_chunks", F.col("_chunk") - 1), lambda b: b <= at))
    part = F.when(F.col("_chunk") > 0, before + inside).otherwise(F.lit(0))
    return joined.withColumn("_part", part).drop("_chunk", "_chunks", *[f"_bk{i}" for i in range(len(keys))])


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """The only exchange of a scan's rows: the join and the windows by ``keys`` after
    it all ask for this partitioning. Its number is given, else
    adaptive execution puts rows that compress well into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def duration_bucket(ts: str, bucket: str | None) -> Column | None:
    """Time bucket of ``ts`` for a duration such as '10 minutes'; None for None."""
    return time_bucket(ts, interval_seconds(bucket)) if bucket is not None else None


def time_bucket(ts, seconds: int) -> Column:
    """Bucket number of a timestamp for buckets of ``seconds`` length."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c) / F.lit(int(seconds) * 1_000_000))


def _stand_in(dt) -> Column:
    """A non-null value of the key's type (only paired with the key's null flag)."""
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    if isinstance(dt, T.BinaryType):
        return F.lit(b"")
    return F.lit(0).cast(dt)


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None,
               specs: dict[str, tuple[str, Column]], inclusive: bool = True,
               reverse: bool = False) -> DataFrame:
    """Add one column per spec holding the running aggregate over the rows of the
    same key that precede each row in ``order`` (or follow it, if ``reverse``).

    ``order`` is a list of column names giving a total order inside a key (nulls
    first); ``bucket`` must be non-decreasing along that order (derive it from
    the first order column, null where that is null); None deals the rows out by
    ``ordered_parts``. ``specs`` maps an output name to (kind, value column) with
    kind in sum | count | min | max | last (last non-null value in scan order) |
    next (first non-null value at or after the row, i.e. looking ahead; only
    with ``reverse=False``). ``inclusive`` decides whether the row itself is
    part of its frame. Mixing ``last`` and ``next`` specs gives the previous and
    the following marker of a row in one pass over the data.
    """
    for name, (kind, _) in specs.items():
        if kind not in KINDS:
            raise ValueError(f"unknown aggregate kind {kind!r} for {name}")
        if kind == "next" and reverse:
            raise ValueError("'next' looks ahead already; use it with reverse=False")
    columns = df.columns
    if bucket is None:
        df = ordered_parts(df.select("*", *[v.alias(f"_v_{name}") for name, (_, v) in specs.items()]), keys, order)
        bucket = F.col("_part")
    else:
        df = df.select("*", *[v.alias(f"_v_{name}") for name, (_, v) in specs.items()])
    # Internal key columns: a non-null stand-in plus a null flag per key, so rows
    # with a null key form their own group (as in a plain window) while the join
    # and the windows below stay plain equi-keys on the same columns: one shuffle.
    b = df
    ikeys = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for i, k in enumerate(keys):
        b = b.withColumn(f"_kv{i}", F.coalesce(F.col(k), _stand_in(types[k])))
        b = b.withColumn(f"_kz{i}", F.col(k).isNull())
        ikeys += [f"_kv{i}", f"_kz{i}"]
    keys = ikeys
    # nulls of the order come first, so their bucket does too
    b = b.withColumn("_bk", F.coalesce(bucket.cast("long"), F.lit(-(2**63)).cast("long")))

    ord_struct = F.struct(*[F.col(c) for c in order])
    if reverse:
        in_order = [F.col(c).desc() for c in order]
        bk_order = F.col("_bk").desc()
    else:
        in_order = [F.col(c).asc() for c in order]
        bk_order = F.col("_bk").asc()

    # 1. one row per (key, bucket)
    aggs = []
    for name, (kind, _) in specs.items():
        v = F.col(f"_v_{name}")
        if kind == "sum":
            aggs.append(F.sum(v).alias(f"_b_{name}"))
        elif kind == "count":
            aggs.append(F.count(v).alias(f"_b_{name}"))
        elif kind == "min":
            aggs.append(F.min(v).alias(f"_b_{name}"))
        elif kind == "max":
            aggs.append(F.max(v).alias(f"_b_{name}"))
        elif kind == "next":  # first non-null value of the bucket
            aggs.append(F.min_by(v, F.when(v.isNotNull(), ord_struct)).alias(f"_b_{name}"))
        else:  # last non-null value in scan order inside the bucket
            key_ord = F.when(v.isNotNull(), ord_struct)
            pick = F.min_by(v, key_ord) if reverse else F.max_by(v, key_ord)
            aggs.append(pick.alias(f"_b_{name}"))
    buckets = b.groupBy(*keys, "_bk").agg(*aggs)

    # 2. carry-in from earlier buckets of the same key
    wb = Window.partitionBy(*keys).orderBy(bk_order).rowsBetween(Window.unboundedPreceding, -1)
    wf = Window.partitionBy(*keys).orderBy(bk_order).rowsBetween(1, Window.unboundedFollowing)
    carry = []
    for name, (kind, _) in specs.items():
        c = F.col(f"_b_{name}")
        if kind == "next":
            expr = F.first(c, ignorenulls=True).over(wf)
        elif kind in ("sum", "count"):
            expr = F.sum(c).over(wb)
        elif kind == "min":
            expr = F.min(c).over(wb)
        elif kind == "max":
            expr = F.max(c).over(wb)
        else:
            expr = F.last(c, ignorenulls=True).over(wb)
        carry.append(expr.alias(f"_c_{name}"))
    buckets = buckets.select(*keys, "_bk", *carry)

    # 3. running value inside the bucket, 4. combine
    wi = (Window.partitionBy(*keys, "_bk").orderBy(*in_order)
          .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    wa = (Window.partitionBy(*keys, "_bk").orderBy(*in_order)
          .rowsBetween(0 if inclusive else 1, Window.unboundedFollowing))
    joined = dealt(b, [*keys, "_bk"]).join(buckets, on=[*keys, "_bk"], how="left")
    out = []
    for name, (kind, _) in specs.items():
        v, c = F.col(f"_v_{name}"), F.col(f"_c_{name}")
        if kind == "sum":
            expr = F.coalesce(F.sum(v).over(wi), F.lit(0)) + F.coalesce(c, F.lit(0))
        elif kind == "count":
            expr = F.count(v).over(wi) + F.coalesce(c, F.lit(0))
        elif kind == "min":
            expr = F.least(F.min(v).over(wi), c)
        elif kind == "max":
            expr = F.greatest(F.max(v).over(wi), c)
        elif kind == "next":
            expr = F.coalesce(F.first(v, ignorenulls=True).over(wa), c)
        else:
            expr = F.coalesce(F.last(v, ignorenulls=True).over(wi), c)
        out.append(expr.alias(name))
    return joined.select(*[F.col(c) for c in columns], *out)
