"""Queries and rules that arrive while a stream runs.

Each job is one streaming query over the union of the data and a control stream,
handled by micro-batch. Within a batch the data is treated under the control rows
of earlier batches; then the batch's control rows take effect, in order of their
``seq``. Event time is that of the data alone: ``watermark`` is the latest event
time so far less ``delay``, and a silent control stream holds nothing back (T14).

State and results are tables in shared folders, one version per batch id. A batch
that runs again after a failure reads the version of the batch before it and
writes its own version and results over what the failed attempt left, so each
row of the results is there once. Versions no longer needed are deleted.

* ``LatestTable``: the newest event per taxi. A batch adds what it changes; every
  ``COMPACT`` batches the changes are merged, so a batch costs its own rows, and
  the whole table is read only when a control row asks for it.
* ``live_predicates`` (B4), ``live_ongoing`` (B1): control rows are answered from
  the table, later events by the newest predicate.
* ``live_nearest`` (B2): the state is one row per query with its nearest distance;
  rides meet the queries that they can improve (``operators.near_reports``).
* ``live_rules`` (B5): the state is the items that wait for a rule's second shape;
  all colors run through one keyed scan, so a hot color spreads over tasks.

Control rows are typed by people: those of one batch are collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import operators as op
from ..functions.sql import register_sql_functions
from ..operators.geoqueries import near_reports, running_minima, with_rule_columns
from ..operators.rules import rule_rows, scan_rules
from ..plans.util import interval_seconds
from ..schemas import RIDE, RIDE_COLUMNS
from .jobs import RIDE_DELAY

COMPACT = 20


class Versions:
    """Tables below ``path``, one version per batch id."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _fs(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def where(self, name: str, batch: int) -> str:
        return f"{self.path}/{name}/{batch:012d}"

    def write(self, name: str, batch: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.where(name, batch))

    def batches(self, name: str) -> list[int]:
        """Batch ids with a whole version, ascending."""
        where, fs = self._fs(f"{self.path}/{name}")
        if not fs.exists(where):
            return []
        ids = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(i) for i in ids if fs.exists(self._fs(f"{self.path}/{name}/{i}/_SUCCESS")[0]))

    def read(self, name: str, batch: int, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.where(name, batch))

    def latest(self, name: str, batch: int, schema: str) -> DataFrame:
        """The newest version up to ``batch``; no rows if there is none."""
        at = [b for b in self.batches(name) if b <= batch]
        return self.read(name, at[-1], schema) if at else self.spark.createDataFrame([], schema)

    def forget(self, name: str, before: int) -> None:
        for b in self.batches(name):
            if b < before:
                where, fs = self._fs(self.where(name, b))
                fs.delete(where, True)


class LatestTable:
    """Newest event per taxi (A15), kept up by batch."""

    def __init__(self, versions: Versions, compact: int = COMPACT):
        self.versions, self.compact = versions, compact
        self.schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RIDE.fields)

    def upsert(self, rides: DataFrame, batch: int) -> None:
        self.versions.write("changes", batch, op.latest_per_taxi(rides))
        if batch % self.compact == self.compact - 1:
            whole = self.versions.batches("latest")
            self.versions.write("latest", batch, self.read(batch))
            # one merged version back stays for a batch that runs again
            kept = max([b for b in whole if b < batch], default=-1)
            self.versions.forget("changes", kept + 1)
            self.versions.forget("latest", kept)

    def read(self, batch: int) -> DataFrame:
        """The table as of the end of ``batch``."""
        v = self.versions
        base = max([b for b in v.batches("latest") if b < batch], default=-1)
        parts = [v.read("latest", base, self.schema)] if base >= 0 else []
        parts += [v.read("changes", b, self.schema) for b in v.batches("changes") if base < b <= batch]
        if not parts:
            return v.spark.createDataFrame([], self.schema)
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return op.latest_per_taxi(whole)


PROGRESS = "latest_us long, predicate string"


def _start(data: DataFrame, control: DataFrame, state: str, out: str, checkpoint: str,
           step: Callable[[Versions, DataFrame, list, int], DataFrame], trigger: dict | None) -> StreamingQuery:
    """One query over data and control rows; ``step`` gets a batch's and returns its results."""
    spark = data.sparkSession
    versions = Versions(spark, state)
    rows = data.select(F.struct(*data.columns).alias("row"), F.lit(None).cast(control.select(
        F.struct(*control.columns).alias("c")).schema["c"].dataType).alias("asked"))
    asks = control.select(F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.struct(*control.columns).alias("asked"))

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            asked = [r["asked"] for r in batch.where("asked IS NOT NULL").select("asked").orderBy("asked.seq").collect()]
            result = step(versions, batch.where("row IS NOT NULL").select("row.*"), asked, number)
            result.write.mode("overwrite").parquet(f"{out}/batch={number}")
        finally:
            batch.unpersist()

    writer = rows.unionByName(asks).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _clock(versions: Versions, rides: DataFrame, number: int) -> tuple[int | None, int | None, str | None]:
    """Latest event time (us) before this batch and after it, and the predicate before it."""
    before = versions.latest("progress", number - 1, PROGRESS).first()
    old = before["latest_us"] if before else None
    own = rides.agg(F.max(F.unix_micros("eventTime")).alias("t")).first()["t"]
    return old, max([t for t in (old, own) if t is not None], default=None), before["predicate"] if before else None


def _tick(versions: Versions, number: int, latest: int | None, predicate: str | None = None) -> None:
    versions.write("progress", number, versions.spark.createDataFrame([(latest, predicate)], PROGRESS).coalesce(1))
    versions.forget("progress", number - 5)


def _watermark(latest: int | None, delay: str) -> Column:
    """The watermark as a literal; before the first event the start of the epoch."""
    return F.timestamp_micros(F.lit(0 if latest is None else latest - interval_seconds(delay) * 1_000_000))


def live_predicates(rides: DataFrame, control: DataFrame, state: str, out: str, checkpoint: str,
                    delay: str = RIDE_DELAY, trigger: dict | None = None, compact: int = COMPACT) -> StreamingQuery:
    """``control`` (seq, predicate) brings Spark SQL predicates over a ride's
    columns (see ``operators.match_rides``). Results: ``source`` is QUERY (the
    predicate as it arrives), PBE (the latest event of a taxi that satisfies it
    then), PE (a later event that does) or ERROR (a text that is no condition on a
    ride: its message; the predicate before it stays). ``seq`` tells the QUERY, PBE
    and ERROR rows' control row."""
    register_sql_functions(rides.sparkSession)
    columns = ["source", "seq", "predicate", "watermark", *RIDE_COLUMNS]

    def matching(events: DataFrame, predicate: str, mark: Column, source: str, seq) -> DataFrame:
        return with_rule_columns(events, mark).filter(F.expr(predicate)).select(
            F.lit(source).alias("source"), F.lit(seq).cast("long").alias("seq"), F.lit(predicate).alias("predicate"),
            mark.alias("watermark"), *RIDE_COLUMNS)

    def step(versions: Versions, events: DataFrame, asked: list, number: int) -> DataFrame:
        old, new, predicate = _clock(versions, events, number)
        table = LatestTable(versions, compact)
        table.upsert(events, number)
        blank = events.where("false")
        result = matching(events, predicate, _watermark(old, delay), "PE", None) if predicate \
            else matching(blank, "true", _watermark(old, delay), "PE", None)
        mark = _watermark(new, delay)
        for row in asked:
            said, source = row["predicate"], "QUERY"
            try:
                found = matching(table.read(number), said, mark, "PBE", row["seq"])
                predicate, result = said, result.unionByName(found)
            except (AnalysisException, ParseException) as wrong:
                source, said = "ERROR", f"{said}: {str(wrong).splitlines()[0]}"
            note = events.sparkSession.range(1).select(
                F.lit(source).alias("source"), F.lit(row["seq"]).cast("long").alias("seq"), F.lit(said).alias("predicate"),
                mark.alias("watermark"), *[F.lit(None).cast(blank.schema[c].dataType).alias(c) for c in RIDE_COLUMNS])
            result = result.unionByName(note)
        _tick(versions, number, new, predicate)
        return result.select(*columns)

    return _start(rides, control, state, out, checkpoint, step, trigger)


def live_ongoing(rides: DataFrame, control: DataFrame, state: str, out: str, checkpoint: str,
                 delay: str = RIDE_DELAY, trigger: dict | None = None, compact: int = COMPACT) -> StreamingQuery:
    """B1: ``control`` (seq, minutes): at a control row, the taxis whose latest event is
    a START at least that many whole minutes before the watermark."""
    def step(versions: Versions, events: DataFrame, asked: list, number: int) -> DataFrame:
        _, new, _ = _clock(versions, events, number)
        table = LatestTable(versions, compact)
        table.upsert(events, number)
        result = events.where("false").select(F.lit(0).cast("long").alias("seq"), *RIDE_COLUMNS)
        age = F.floor((F.unix_millis(_watermark(new, delay)) - F.unix_millis("eventTime")) / 60000)
        for row in asked:
            found = table.read(number).where(F.col("isStart") & (age >= int(row["minutes"])))
            result = result.unionByName(found.select(F.lit(row["seq"]).cast("long").alias("seq"), *RIDE_COLUMNS))
        _tick(versions, number, new)
        return result

    return _start(rides, control, state, out, checkpoint, step, trigger)


MINIMA = "queryId long, qLon float, qLat float, best float"


def live_nearest(rides: DataFrame, control: DataFrame, state: str, out: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """B2: ``control`` (seq, longitude, latitude) brings location queries, ``seq`` is
    their id; results are the ever-closer ending taxis (queryId, eventTime, rideId,
    taxiId, km) of the batches after it, by event time within a batch. Distances
    known so far bound which rides a query meets."""
    def step(versions: Versions, events: DataFrame, asked: list, number: int) -> DataFrame:
        known = versions.latest("minima", number - 1, MINIMA)
        reports = near_reports(events, known, best="best").where("best IS NULL OR km < best")
        closer = running_minima(reports, bucket=F.col("_slice"))
        versions.write("found", number, closer.select("queryId", "eventTime", "rideId", "taxiId", "km"))
        found = versions.read("found", number, "queryId long, eventTime timestamp, rideId long, taxiId long, km float")
        least = found.groupBy("queryId").agg(F.min("km").alias("_km"))
        moved = known.join(least, "queryId", "left").select("queryId", "qLon", "qLat", F.coalesce("_km", "best").alias("best"))
        new = events.sparkSession.createDataFrame(
            [(r["seq"], float(r["longitude"]), float(r["latitude"]), None) for r in asked], MINIMA)
        versions.write("minima", number, moved.join(new, "queryId", "left_anti").unionByName(new))
        for name in ("found", "minima"):
            versions.forget(name, number - 2)
        return found

    return _start(rides, control, state, out, checkpoint, step, trigger)


RULES = "rule string, first string, second string"


def live_rules(items: DataFrame, control: DataFrame, state: str, out: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """``control`` (seq, first, second) brings two-shape rules, named ``Rule_<seq>``,
    which see the items (seq, shape, color) of later batches, by ``seq`` within a
    batch. Results as ``operators.match_rules``."""
    def step(versions: Versions, batch: DataFrame, asked: list, number: int) -> DataFrame:
        rules = versions.latest("rules", number - 1, RULES)
        kind = batch.schema["color"].dataType.simpleString()
        waiting = versions.latest("waiting", number - 1, f"rule string, color {kind}, seq long, first string, second string")
        # items that wait are of earlier batches and come first
        old = waiting.select("seq", F.col("first").alias("shape"), "color", "rule", "first", "second", F.lit(0).alias("_late"))
        own = rule_rows(batch, rules).withColumn("_late", F.lit(1))
        versions.write("scanned", number, scan_rules(old.unionByName(own), ["_late", "seq"]))
        scanned = versions.spark.read.parquet(versions.where("scanned", number))
        firsts = scanned.where("shape = first")
        versions.write("waiting", number, firsts.where("_next IS NULL").select("rule", "color", "seq", "first", "second"))
        new = batch.sparkSession.createDataFrame([(f"Rule_{r['seq']}", r["first"], r["second"]) for r in asked], RULES)
        versions.write("rules", number, rules.unionByName(new).coalesce(1))
        for name in ("scanned", "waiting", "rules"):
            versions.forget(name, number - 2)
        return firsts.where("_next IS NOT NULL").select("rule", "color", F.col("seq").alias("firstSeq"), F.col("_next").alias("secondSeq"))

    return _start(items, control, state, out, checkpoint, step, trigger)


def read_results(spark: SparkSession, out: str) -> DataFrame:
    """The results of a live job with ``batch``, the number of the batch of each row."""
    return spark.read.parquet(out)
