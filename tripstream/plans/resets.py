"""Running minima that are forgotten after a time without improvement.

A report (a row that is strictly nearer than the minimum of its key) sets the
minimum; a minimum that has not improved for ``reset`` is forgotten, so the next
row is a report whatever its value. Each report depends on the one before it, and
a key may hold most of the rows, so no task may walk a key's rows in order.

Only the lowest value of an instant and its time carry over, so rows are first
combined to instants, and time is cut into slices of the length ``reset``:

1. Inside a slice nothing can be forgotten. Entered at an instant, a slice is left
   with the lowest value from there to its end, at its first occurrence. These
   places (the suffix minima) are the slice's *exits*.
2. An exit fixes the next entry: in the following slice the first instant that is
   lower, or that is more than ``reset`` later; if there is none, the first instant
   of the next slice that has any, which is always more than ``reset`` later. So
   every exit leads to one exit of a later slice. Two neighbouring slices of a key
   are all that one group reads.
3. The exits reached from a key's first instant are marked in blocks of slices: an exit
   in a block's first two slices leads past the block (a slice may be jumped over, so
   a path enters there), blocks of blocks are combined likewise until one block spans
   every key, and from there the path is walked down again, block by block. A task
   reads some ``GROUP`` exits; the plans stay as small however many slices there are.
4. Entries on the path tell each slice where its reports begin and which minimum
   they have to beat; inside it they are plain running minima by ``keyed_scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .prefix import keyed_scan

#: Exits that one group of a path's walk reads, unless ``NARROWEST`` slices have more.
GROUP, NARROWEST = 100_000, 4


def _steps(reset_us: int):
    """Exits of the slice ``_g`` of one key with the entries that they lead to in the
    slice after it (none: nulls), from the instants of both."""
    def steps(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("_t")
        key, g = pdf.iloc[0, 0], int(pdf["_g"].iloc[0])
        own = (pdf["_slice"] == g).to_numpy()
        t, m = pdf["_t"].to_numpy("int64"), pdf["_m"].to_numpy("float64")
        t1, m1, t2, m2 = t[own], m[own], t[~own], m[~own]
        if not len(t1):
            return pd.DataFrame({c: [] for c in (pdf.columns[0], *EDGE)})

        def exits(v):
            return np.flatnonzero(v == np.minimum.accumulate(v[::-1])[::-1])

        leave = exits(m1)
        n = len(leave)
        lower = np.searchsorted(-np.minimum.accumulate(m2), -m1[leave], side="right")
        late = np.searchsorted(t2, t1[leave] + reset_us, side="right")
        entry = np.minimum(lower, late)
        found = entry < len(t2)
        into = np.full(n, -1, dtype="int64")
        to, leave2 = into.copy(), exits(m2)
        into[found] = t2[entry[found]]
        to[found] = t2[leave2[np.searchsorted(leave2, entry[found])]]
        out = pd.DataFrame({"_g": g, "_t": t1[leave], "_first": t1[0], "_exit": t1[leave[0]]})
        out["_into"] = pd.Series(into).astype("Int64").mask(~found)
        out["_to"] = pd.Series(to).astype("Int64").mask(~found)
        # forgotten by then: nothing to beat
        out["_beat"] = pd.Series(m1[leave]).mask(~found | (lower > late) | (into > t1[leave] + reset_us))
        out.insert(0, pdf.columns[0], key)
        return out
    return steps


EDGE = ("_g", "_t", "_first", "_exit", "_into", "_to", "_beat")


def _past(width: int):
    """Exits in the first two slices of a block of ``width`` slices with the exit that
    their path enters the next block at (none if it ends before), from the block's exits."""
    def past(pdf):
        import numpy as np

        pdf = pdf.sort_values("_t", ignore_index=True)
        t, to, n, block = (pdf[c].to_numpy("int64") for c in ("_t", "_to", "_n", "_block"))
        at = np.minimum(np.searchsorted(t, to), len(t) - 1)
        last = np.where(t[at] == to, at, np.arange(len(t)))
        while True:
            further = last[last]
            if (further == last).all():
                break
            last = further
        pdf[["_to", "_m"]] = pdf[["_to", "_m"]].to_numpy("int64")[last]
        leaves = ((n - 1) % width < 2) & ((pdf["_m"].to_numpy("int64") - 1) // width != block)
        return pdf.loc[leaves, [pdf.columns[0], *STEP]]
    return past


def _walk(columns: list[str]):
    """The ``columns`` of a block's exits on the path from the exit that it is entered
    at (the row that leads to itself)."""
    def walk(pdf):
        import numpy as np

        entered = pdf["_to"] == pdf["_t"]
        rows = pdf[~entered].sort_values("_t", ignore_index=True)
        t, to = rows["_t"].to_numpy("int64"), rows["_to"].to_numpy("int64")
        path = []
        for x in pdf.loc[entered, "_t"]:
            while (at := int(np.searchsorted(t, x))) < len(t) and t[at] == x:
                path.append(at)
                x = to[at]
        return rows.loc[path, columns]
    return walk


STEP = ("_t", "_n", "_to", "_m")


def _entries(instants: DataFrame, key: str, reset_us: int) -> DataFrame:
    """(key, ``_slice``, ``_from``, ``_beat``): where each slice's reports begin and what
    they have to beat (null: nothing)."""
    both = instants.withColumn("_g", F.explode(F.array(F.col("_slice"), F.col("_slice") - 1)))
    kind = instants.schema[key].dataType.simpleString()
    edges = (both.groupBy(key, "_g").applyInPandas(
        _steps(reset_us), f"{key} {kind}, _g long, _t long, _first long, _exit long, _into long, _to long, _beat double")
        .checkpoint())
    # one row per key and slice
    slices = edges.groupBy(key, "_g").agg(F.first("_first").alias("_first"), F.first("_exit").alias("_exit"),
                                          F.count("*").alias("_exits"))
    w = Window.partitionBy(key).orderBy("_g")
    place = F.struct("_g", "_first", "_exit", "_n")
    slices = slices.withColumn("_n", F.row_number().over(w).cast("long"))
    slices = slices.select("*", F.lead(place, 1).over(w).alias("_next"), F.lead(place, 2).over(w).alias("_after"))
    later = F.when(F.col("_next._g") > F.col("_g") + 1, F.col("_next")).otherwise(F.col("_after"))
    led = edges.drop("_first", "_exit").join(slices.select(key, "_g", "_n", later.alias("_later")), [key, "_g"])
    found = F.col("_into").isNotNull()
    led = led.select(key, "_t", "_n", F.coalesce("_to", "_later._exit").alias("_to"),
                     F.when(found, F.col("_n") + 1).otherwise(F.col("_later._n")).alias("_m"),
                     F.when(found, F.col("_g") + 1).otherwise(F.col("_later._g")).alias("_slice"),
                     F.coalesce("_into", "_later._first").alias("_from"), "_beat").where(F.col("_from").isNotNull())
    start = slices.where(F.col("_n") == 1).select(key, F.col("_g").alias("_slice"), F.col("_first").alias("_from"),
                                                  F.lit(None).cast("double").alias("_beat"), F.col("_exit").alias("_t"))
    size = slices.agg(F.max("_n").alias("most"), F.max("_exits").alias("exits")).first()
    most, step = size["most"] or 0, max(NARROWEST, GROUP // (size["exits"] or 1))
    step_schema = f"{key} {kind}, _t long, _n long, _to long, _m long"

    def blocks(df, width):
        return df.withColumn("_block", F.expr(f"(_n - 1) div {width}")).groupBy(key, "_block")

    levels, width = [led], step
    while width < most:                                    # up: a level's plan is one grouping
        levels[-1] = levels[-1].checkpoint()
        levels.append(blocks(levels[-1].select(key, *STEP), width).applyInPandas(_past(width), step_schema))
        width *= step
    first = start.select(key, "_t", F.lit(1).cast("long").alias("_n"))
    enter = first.withColumns({"_to": F.col("_t"), "_m": F.col("_n")})
    for level in reversed(levels[1:]):                     # and down
        passed = blocks(level.unionByName(enter), width).applyInPandas(_walk([key, *STEP]), step_schema).checkpoint()
        enter = first.unionByName(passed.select(key, F.col("_to").alias("_t"), F.col("_m").alias("_n"))) \
            .withColumns({"_to": F.col("_t"), "_m": F.col("_n")})
        width //= step
    entry = [key, "_slice", "_from", "_beat"]
    enter = enter.withColumns({"_slice": F.lit(0).cast("long"), "_from": F.col("_t"), "_beat": F.lit(None).cast("double")})
    passed = blocks(levels[0].unionByName(enter), width).applyInPandas(
        _walk(entry), f"{key} {kind}, _slice long, _from long, _beat double")
    return start.select(*entry).unionByName(passed).checkpoint()


def resetting_minima(rows: DataFrame, key: str, order: list[str], value: str, reset: int) -> DataFrame:
    """The rows of ``rows`` that are strictly below the minimum of their key, which is
    forgotten when it has not improved for more than ``reset`` microseconds.
    ``order``: a timestamp column and the columns that tell its rows apart. Rows
    without key, time or value, or with a NaN, are no reports. Its iteration writes
    small tables (``checkpoint``): two neighbouring slices of a key have to fit a
    task with one row per instant."""
    ensure_checkpoint_dir(rows.sparkSession)
    at: Column = F.unix_micros(order[0])
    r = rows.where(F.col(key).isNotNull() & F.col(order[0]).isNotNull() & F.col(value).isNotNull()
                   & ~F.isnan(F.col(value).cast("double")))
    r = r.withColumns({"_t": at, "_m": F.col(value).cast("double")}) \
        .withColumn("_slice", F.expr(f"cast(floor(_t / {int(reset)}) as long)"))
    instants = r.groupBy(key, "_slice", "_t").agg(F.min("_m").alias("_m"))
    entries = _entries(instants, key, int(reset))
    begun = r.join(entries, [key, "_slice"]).where((F.col("_t") >= F.col("_from"))
                                                   & (F.col("_beat").isNull() | (F.col("_m") < F.col("_beat"))))
    scanned = keyed_scan(begun, [key, "_slice"], list(order), F.col("_slice"), {"_prev": ("min", F.col("_m"))},
                         inclusive=False)
    return scanned.where(F.col("_prev").isNull() | (F.col("_m") < F.col("_prev"))).select(*rows.columns)
