"""Control rows that arrive while the stream runs: live queries and rules."""

import itertools
import os
import tempfile

from pyspark.sql import functions as F

from conftest import MUSEUM, SF_SMALL, STATION, ride, rides_df
from tripstream import operators as op
from tripstream.sources import fixtures as fx
from tripstream.streaming import live


class Feed:
    """A folder that files are put into between runs on one checkpoint."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.dir, self.n = spark, schema, tempfile.mkdtemp(prefix="ts-feed-"), itertools.count()

    def put(self, df):
        df.coalesce(1).write.parquet(os.path.join(self.dir, f"f{next(self.n)}"))

    def stream(self):
        return (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", "true").parquet(self.dir))


class Job:
    def __init__(self, spark, start, data_schema, control_schema):
        self.spark, self.start = spark, start
        self.data, self.control = Feed(spark, data_schema), Feed(spark, control_schema)
        self.state, self.out, self.ckpt = (tempfile.mkdtemp(prefix=f"ts-{k}-") for k in ("state", "out", "ckpt"))

    def ask(self, *rows):
        self.control.put(self.spark.createDataFrame(list(rows), self.control.schema))

    def run(self, **more):
        q = self.start(self.data.stream(), self.control.stream(), self.state, self.out, self.ckpt, **more)
        q.awaitTermination(600)
        assert q.exception() is None
        return live.read_results(self.spark, self.out)


def predicates(spark):
    from tripstream.schemas import RIDE
    return Job(spark, live.live_predicates, RIDE, "seq long, predicate string")


def seen(df, source):
    return sorted((r["seq"], r["rideId"], r["isStart"]) for r in df.where(F.col("source") == source).collect())


def test_predicate_after_a_start(spark):
    job = predicates(spark)
    job.data.put(rides_df(spark, [ride(1, True, 0, start=(0, 0))]))
    job.ask((1, "isStart"))
    assert seen(job.run(), "PBE") == [(1, 1, True)]


def test_nearby_taxis(spark):
    job = predicates(spark)
    job.data.put(rides_df(spark, [ride(1, True, 0, start=STATION), ride(1, False, 0, 5, start=STATION, end=MUSEUM)]))
    job.ask((1, f"distanceKm({MUSEUM[0]}, {MUSEUM[1]}, lon, lat) < 1.0"))
    out = job.run()
    assert seen(out, "PBE") == [(1, 1, False)] and seen(out, "PE") == []
    assert [r["predicate"] for r in out.where("source = 'QUERY'").collect()][0].startswith("distanceKm")


def test_predicate_in_mid_stream_and_after_a_restart(spark):
    job = predicates(spark)
    job.data.put(rides_df(spark, [ride(1, True, 0, taxi=1), ride(2, True, 1, taxi=2), ride(2, False, 1, 9, taxi=2)]))
    job.run()
    job.ask((1, "isStart"))
    job.run()
    job.data.put(rides_df(spark, [ride(3, True, 20, taxi=2), ride(1, False, 0, 21, taxi=1)]))
    out = job.run()
    assert seen(out, "PBE") == [(1, 1, True)] and seen(out, "PE") == [(None, 3, True)]
    # a text that is no predicate leaves the old one; a new one takes its place
    job.ask((2, "no such thing ("), (3, "nothing > 1"))
    job.data.put(rides_df(spark, [ride(4, True, 30, taxi=4)]))
    out = job.run()
    assert sorted(r["seq"] for r in out.where("source = 'ERROR'").collect()) == [2, 3]
    assert seen(out, "PE") == [(None, 3, True), (None, 4, True)]
    job.ask((4, "NOT isStart AND watermark >= timestamp '2020-01-01 12:29:00'"))
    job.run()
    job.data.put(rides_df(spark, [ride(5, True, 40, taxi=5), ride(3, False, 20, 41, taxi=2)]))
    out = job.run()
    assert [x for x in seen(out, "PBE") if x[0] == 4] == [(4, 1, False)]
    assert seen(out, "PE") == [(None, 3, False), (None, 3, True), (None, 4, True)]


def test_a_batch_that_runs_again_writes_nothing_twice(spark):
    """The state and results of a batch replayed after a failure are those of one run."""
    job = predicates(spark)
    job.data.put(rides_df(spark, [ride(1, True, 0, taxi=1)]))
    job.ask((1, "isStart"))
    job.run()
    first = sorted(map(str, live.read_results(spark, job.out).collect()))
    commits = os.path.join(job.ckpt, "commits")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))      # the batch was done but not committed
    assert sorted(map(str, job.run().collect())) == first


def test_latest_table_over_many_batches(spark):
    """Merged and unmerged versions give the table of the batch operator."""
    rides = fx.rides(spark, SF_SMALL).cache()
    table = live.LatestTable(live.Versions(spark, tempfile.mkdtemp(prefix="ts-latest-")), compact=3)
    for k in range(8):
        part = rides.where(F.pmod(F.hash("rideId"), F.lit(8)) == k)
        table.upsert(part, k)
        table.upsert(part, k)                        # again
        so_far = rides.where(F.pmod(F.hash("rideId"), F.lit(8)) <= k)
        assert sorted(map(tuple, table.read(k).collect())) == sorted(map(tuple, op.latest_per_taxi(so_far).collect()))
    assert len(table.versions.batches("changes")) <= 6 and len(table.versions.batches("latest")) <= 2


def test_ongoing_rides_asked_in_mid_stream(spark):
    from tripstream.schemas import RIDE
    job = Job(spark, live.live_ongoing, RIDE, "seq long, minutes long")
    job.data.put(rides_df(spark, [ride(1, True, 0, taxi=1), ride(2, True, 50, taxi=2), ride(3, True, 5, taxi=3), ride(3, False, 5, 40, taxi=3)]))
    job.run()
    job.ask((7, 40), (8, 0))
    out = job.run(delay="60 seconds")
    assert sorted((r["seq"], r["rideId"]) for r in out.collect()) == [(7, 1), (8, 1)]      # at minute 49
    job.data.put(rides_df(spark, [ride(4, True, 95, taxi=4)]))
    job.run()
    job.ask((9, 40))
    assert sorted(r["rideId"] for r in job.run().where("seq = 9").collect()) == [1, 2]


def test_location_queries_in_mid_stream(spark):
    from tripstream.schemas import RIDE
    rides = fx.rides(spark, SF_SMALL).where(~F.col("isStart")).cache()
    cut = "timestamp '2024-01-10 00:00:00'"
    job = Job(spark, live.live_nearest, RIDE, "seq long, longitude double, latitude double")
    job.ask((1, *STATION))
    job.run()
    job.data.put(rides.where(f"eventTime < {cut}"))
    job.run()
    job.ask((2, *MUSEUM), (3, 0.0, 90.0))
    job.run()
    job.data.put(rides.where(f"eventTime >= {cut}"))
    out = job.run()
    got = sorted((r["queryId"], r["rideId"], r["km"]) for r in out.collect())
    early = op.nearest_taxi(rides, [(1, *STATION)])
    late = op.nearest_taxi(rides.where(f"eventTime >= {cut}"), [(2, *MUSEUM), (3, 0.0, 90.0)])
    assert got == sorted((r["queryId"], r["rideId"], r["km"]) for r in early.unionByName(late).collect())


def test_rules_in_mid_stream(spark):
    items = fx.items(spark, SF_SMALL).cache()
    job = Job(spark, live.live_rules, items.schema, "seq long, first string, second string")
    job.ask((0, "view", "purchase"))
    job.run()
    job.data.put(items.where("seq < 400"))
    job.run()
    job.ask((1, "click", "click"))
    job.run()
    job.data.put(items.where("seq >= 400 AND seq < 700"))
    job.run()
    job.data.put(items.where("seq >= 700"))
    got = sorted(map(str, job.run().select("rule", "color", "firstSeq", "secondSeq").collect()))
    first = op.match_rules(items, [("view", "purchase")])
    second = op.match_rules(items.where("seq >= 400"), [("x", "y"), ("click", "click")])
    assert got == sorted(map(str, first.unionByName(second).collect())) and second.count() > 5


def test_silent_control_stream_does_not_stop_windows(spark):
    """Windows over the data close though the control side brings nothing."""
    from tripstream.streaming import jobs
    rides = fx.rides(spark, SF_SMALL)
    data, control = Feed(spark, rides.schema), Feed(spark, "seq long, predicate string")
    os.makedirs(control.dir, exist_ok=True)
    data.put(rides)
    data.put(rides_df(spark, [ride(-1, True, 60 * 24 * 3000, taxi=-1)]))
    data.put(rides_df(spark, [ride(-2, True, 60 * 24 * 3001, taxi=-1)]))
    asks = control.stream().select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rides.schema.fields])
    places = jobs.popular_places_stream(data.stream().unionByName(asks), 3, "4 days", "1 day")
    q = (places.writeStream.format("memory").queryName("silent").trigger(availableNow=True)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="ts-silent-")).start())
    q.awaitTermination(600)
    assert spark.table("silent").count() == op.popular_places(rides, 3, "4 days", "1 day").count() > 0
