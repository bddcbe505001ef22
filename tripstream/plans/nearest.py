"""Which points can come nearer to a query than all earlier ones: a grid in rings.

A query's nearest distance so far falls with time, and only points below it can
be new minima. ``candidates`` bounds it without pairing: for cells of ``SIZES``,
coarse to fine, the first time a cell held a point is one grouped minimum. Once
the query's own cell of size s has held one, its nearest is within the diagonal
of s, so from then until the next finer cell fills, only points of the cells
around (two to the north and south, three to the east and west) can be nearer. A
point therefore meets the queries whose bound at its time reaches it, through an
equi-join on (size, cell, slice of time).

Distances are 110.25 * sqrt(dlat^2 + (dlon * cos(lat))^2) with the point's own
latitude as the cosine's plain argument, so the cosine can be small anywhere.
Points come in classes of the power of two of |cos|, whose cells are as much
wider in longitude; in the last class longitude does not bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cell sizes in degrees of latitude; the first holds every place. The last is near
#: the step of a 32-bit coordinate, so a cell of it has few different places.
SIZES = (512.0, 128.0, 32.0, 8.0, *(2.0 ** -k for k in range(-2, 15)))
CLASSES = 8
KM = 110.25
#: Slices of time: each has about as many points as all before it.
SLICES = 16


def _class(lat: Column) -> Column:
    """0 for |cos| in (1/2, 1], 1 for (1/4, 1/2], ..."""
    k = F.floor(-F.log2(F.greatest(F.abs(F.cos(lat.cast("double"))), F.lit(1e-9)))).cast("int")
    return F.least(F.greatest(k, F.lit(0)), F.lit(CLASSES))


def _cell(value: Column, origin: float) -> Column:
    return F.when(F.col("_size") == 0, F.lit(0)).otherwise(F.floor((value.cast("double") + origin) / F.col("_s")).cast("int"))


def _in_cells(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """``df`` (with a class ``_k``) at every size: ``_size``, and its cell ``_y``, ``_x``."""
    sizes = F.array(*[F.struct(F.lit(k).alias("_size"), F.lit(s).alias("_s")) for k, s in enumerate(SIZES)])
    df = df.withColumn("_sz", F.explode(sizes)).select("*", "_sz._size", "_sz._s").drop("_sz")
    wide = F.floor((F.col(lon).cast("double") + 180.0) / (F.col("_s") * F.pow(F.lit(2.0), F.col("_k")))).cast("int")
    whole = (F.col("_size") == 0) | (F.col("_k") == CLASSES)     # longitude does not bound
    return df.withColumns({"_y": _cell(F.col(lat), 90.0), "_x": F.when(whole, F.lit(0)).otherwise(wide)})


def first_per_place(points: DataFrame, order: list[str], lon: str, lat: str) -> DataFrame:
    """Of the points at one place only the first can be nearer than all before
    it: ``points`` without the others. Combined before the shuffle, so a place
    with a large share of all points is no large group."""
    rest = [c for c in points.columns if c not in (lon, lat)]
    row = F.struct(*[F.col(c) for c in rest])
    kept = points.groupBy(lon, lat).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("_row"))
    return kept.select(lon, lat, "_row.*").select(*points.columns)


def candidates(points: DataFrame, queries: DataFrame, time: str, lon: str, lat: str, query: str = "queryId",
               qlon: str = "qLon", qlat: str = "qLat", best: str | None = None) -> DataFrame:
    """Pairs of ``points`` (``time`` a timestamp) and ``queries`` that hold every new
    minimum of a query, each once, with ``_slice``, a number that rises with time
    and splits a query's pairs about evenly. ``best``: a column of the queries
    with the nearest distance known before the first point (null: none). Rows
    without coordinates or time meet nothing."""
    queries = queries.where(F.col(qlon).isNotNull() & F.col(qlat).isNotNull())
    points = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull() & F.col(time).isNotNull()) \
        .withColumns({"_k": _class(F.col(lat)), "_t": F.unix_micros(time)})
    # what the plan needs to know of the points: the classes there are (nine at
    # most), and times that cut them into slices as large as all before each
    seen = points.agg(F.collect_set("_k").alias("kinds"), F.percentile_approx(
        "_t", [2.0 ** -k for k in range(SLICES, 0, -1)], 200_000).alias("cuts")).first()
    kinds = F.array(*[F.lit(k) for k in sorted(seen["kinds"])]).cast("array<int>")
    cuts = F.array(*[F.lit(c) for c in sorted(set(seen["cuts"] or []))]).cast("array<bigint>")
    number = lambda t: F.size(F.filter(cuts, lambda c: c < t))
    celled = _in_cells(points, lon, lat)
    own = _in_cells(queries.withColumn("_k", F.explode(kinds)), qlon, qlat)
    cell = ["_size", "_k", "_y", "_x"]
    # when a query's own cells were first held, by size
    bounding = own.where(F.col("_k") < CLASSES)
    held = celled.join(bounding.select(*cell).distinct(), cell, "left_semi").groupBy(*cell).agg(F.min("_t").alias("_first"))
    never = F.lit(2 ** 62).cast("long")
    reach = F.coalesce(F.min("_first"), never)
    if best is not None:
        # a distance known before: cells with a diagonal not below it count as held
        reach = F.when(F.max(F.col(best)) <= KM * 1.41 * F.max("_s"), -never).otherwise(reach)
    since = own.join(held, cell, "left").groupBy(query, "_size").agg(reach.alias("_since"))
    steps = since.groupBy(query).agg(F.array_sort(F.collect_list(F.struct("_size", "_since"))).alias("_steps")) \
        .select(query, F.transform("_steps", lambda s: s["_since"]).alias("_steps"))
    begins = F.when(F.col("_size") == 0, -never).otherwise(F.col("_begin"))
    steps = steps.select(query, "_steps", F.posexplode("_steps").alias("_size", "_begin")) \
        .select(query, "_size", begins.alias("_from"), F.coalesce(F.get("_steps", F.col("_size") + 1), never).alias("_until")) \
        .where("_from < _until")
    rings = own.join(steps, [query, "_size"])
    rings = rings.withColumn("_slice", F.explode(F.sequence(number(F.col("_from")), number(F.col("_until"))))).drop("_s")
    north = F.when(F.col("_size") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(-2), F.lit(2)))
    east = F.when((F.col("_size") == 0) | (F.col("_k") == CLASSES), F.array(F.lit(0))).otherwise(F.sequence(F.lit(-3), F.lit(3)))
    rings = rings.withColumn("_dy", F.explode(north)).withColumn("_dx", F.explode(east))
    rings = rings.withColumns({"_y": F.col("_y") + F.col("_dy"), "_x": F.col("_x") + F.col("_dx")}).drop("_dy", "_dx")
    placed = celled.drop("_s").withColumn("_slice", number(F.col("_t")))
    met = placed.join(rings, [*cell, "_slice"]).where((F.col("_t") > F.col("_from")) & (F.col("_t") <= F.col("_until")))
    return met.select(*[c for c in points.columns if c not in ("_k", "_t")], *queries.columns, "_slice")
