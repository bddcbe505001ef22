import random
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripstream.plans import keyed_scan


def test_keyed_scan_equals_plain_windows(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        key = 0 if rnd.random() < 0.5 else rnd.randint(1, 4)   # one hot key
        rows.append((key, rnd.randint(0, 400), i, rnd.choice([None, rnd.random()])))
    df = spark.createDataFrame(rows, "k int, t int, id int, v double")
    bucket = F.floor(F.col("t") / 37)
    specs = {"s": ("sum", F.col("v")), "c": ("count", F.col("v")), "mn": ("min", F.col("v")),
             "mx": ("max", F.col("v")), "l": ("last", F.col("v"))}
    for inclusive in (True, False):
        for reverse in (False, True):
            got = keyed_scan(df, ["k"], ["t", "id"], bucket, specs, inclusive, reverse)
            o = [F.col("t").desc(), F.col("id").desc()] if reverse else ["t", "id"]
            w = Window.partitionBy("k").orderBy(*o).rowsBetween(Window.unboundedPreceding,
                                                               0 if inclusive else -1)
            ref = df.select("*", F.coalesce(F.sum("v").over(w), F.lit(0.0)).alias("s"),
                            F.count("v").over(w).alias("c"), F.min("v").over(w).alias("mn"),
                            F.max("v").over(w).alias("mx"), F.last("v", True).over(w).alias("l"))
            norm = lambda rs: sorted((r.id, round(r.s, 9), r.c, r.mn, r.mx, r.l) for r in rs)
            assert norm(got.collect()) == norm(ref.collect()), (inclusive, reverse)
        ahead = keyed_scan(df, ["k"], ["t", "id"], bucket, {"n": ("next", F.col("v"))}, inclusive)
        wa = Window.partitionBy("k").orderBy("t", "id").rowsBetween(0 if inclusive else 1,
                                                                   Window.unboundedFollowing)
        ref = df.select("id", F.first("v", True).over(wa).alias("n"))
        assert sorted(tuple(r) for r in ahead.select("id", "n").collect()) == \
            sorted(tuple(r) for r in ref.collect()), inclusive


def test_single_hot_key_is_spread_over_tasks(spark):
    """All rows share one key: the in-bucket windows still run in many tasks."""
    n = 20_000
    df = spark.range(n).select((F.col("id") % 1 + 7).alias("k"), (F.col("id") * 37).alias("t"),
                                   F.col("id").alias("id"), F.lit(1.0).alias("v"))
    out = keyed_scan(df, ["k"], ["t", "id"], F.floor(F.col("t") / 10000),
                     {"c": ("count", F.col("v"))})
    dealt = keyed_scan(df, ["k"], ["t", "id"], None, {"c": ("count", F.col("v"))})
    for scan in (out, dealt):
        per_task = scan.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(per_task) >= 4 and max(r["count"] for r in per_task) < n / 2
    per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) >= 4
    assert max(r["count"] for r in per_task) < n / 2
    assert out.agg(F.max("c")).first()[0] == n


def test_scale_conf_sizes_partitions():
    from tripstream.session import scale_conf
    c = scale_conf(100 * (1 << 40), 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (128 << 20) + 1
    assert int(scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16


def test_bursts_ties_and_outliers_are_split(spark):
    """One key, most rows at one instant and an outlier: no part holds most rows."""
    from tripstream.plans.prefix import ordered_parts
    df = spark.range(8000).select(F.lit(7).alias("k"), F.when(F.col("id") < 6000, 5).when(F.col("id") < 7999, F.col("id"))
                                  .otherwise(10**12).alias("t"), "id")
    parts = ordered_parts(df, ["k"], ["t", "id"]).groupBy("_part").count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 4000
    got = keyed_scan(df, ["k"], ["t", "id"], None, {"c": ("count", F.lit(1))})
    assert got.where("c <> id + 1").count() == 0


def test_null_order_values_in_dealt_and_bucketed_scans(spark):
    df = spark.createDataFrame([(1, None, 1, None), (1, None, 2, 7), (1, 3, 3, None), (1, 40, 4, 9), (1, 41, 5, None)],
                               "k int, t int, id int, v int")
    specs = {"n": ("next", F.col("v")), "l": ("last", F.col("v")), "s": ("sum", F.col("v"))}
    want = [(1, 7, None, 0), (2, 7, 7, 7), (3, 9, 7, 7), (4, 9, 9, 16), (5, None, 9, 16)]
    for bucket in (None, F.floor(F.col("t") / 10)):
        got = keyed_scan(df, ["k"], ["t", "id"], bucket, specs)
        assert sorted(tuple(r) for r in got.select("id", "n", "l", "s").collect()) == want
        back = keyed_scan(df, ["k"], ["t", "id"], bucket, {"l": ("last", F.col("v"))}, reverse=True)
        assert sorted(tuple(r) for r in back.select("id", "l").collect()) == [(1, 7), (2, 7), (3, 9), (4, 9), (5, None)]


def test_dealt_scan_equals_bucketed(spark):
    df = spark.range(300).select((F.col("id") % 4).alias("k"), (F.col("id") * 7 % 101).alias("t"),
                                 F.col("id").alias("id"), (F.col("id") % 5).cast("double").alias("v"))
    specs = {"s": ("sum", F.col("v")), "l": ("last", F.col("v")), "n": ("next", F.col("v"))}
    a = keyed_scan(df, ["k"], ["t", "id"], None, specs, inclusive=False)
    b = keyed_scan(df, ["k"], ["t", "id"], F.floor(F.col("t") / 10), specs, inclusive=False)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_null_keys_are_scanned_like_other_keys(spark):
    df = spark.createDataFrame([(None, 1, 1, 1.0), (None, 50, 2, 1.0), (None, 99, 3, 1.0), (1, 5, 4, 1.0)],
                               "k int, t int, id int, v double")
    a = keyed_scan(df, ["k"], ["t", "id"], F.floor(F.col("t") / 10), {"c": ("count", F.col("v"))})
    b = keyed_scan(df, ["k"], ["t", "id"], None, {"c": ("count", F.col("v"))})
    assert sorted((r.id, r.c) for r in a.collect()) == sorted((r.id, r.c) for r in b.collect()) == \
        [(1, 1), (2, 2), (3, 3), (4, 1)]


def test_stand_in_values_for_key_types(spark):
    import datetime as dt
    df = spark.createDataFrame([(None, None, 1, 1.0), (dt.datetime(2020, 1, 1), "a", 2, 1.0)],
                               "k timestamp, s string, t int, v double")
    got = keyed_scan(df, ["k", "s"], ["t"], F.floor(F.col("t") / 10), {"c": ("count", F.col("v"))})
    assert sorted(r.c for r in got.collect()) == [1, 1]


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_the_rows_move_once(spark, tmp_path):
    """One exchange of the events; what the part table needs is combined before its own."""
    path = str(tmp_path / "events")
    spark.range(30000).selectExpr("id % 3 AS k", "id AS t", "id", "'text' AS payload").write.parquet(path)
    df = spark.read.parquet(path)
    for bucket in (None, F.floor(F.col("t") / 1000)):
        plan = _plan(keyed_scan(df, ["k"], ["t", "id"], bucket, {"c": ("count", F.lit(1)), "n": ("next", F.col("t"))}))
        scans = [line for line in plan.split("\n") if "FileScan" in line]
        assert len(scans) == 2 and sum("payload" in line for line in scans) == 1
        assert plan.count("REPARTITION_BY_NUM") == 1
        # every other exchange takes aggregated rows
        for line in plan.split("Exchange hashpartitioning")[1:]:
            assert "REPARTITION_BY_NUM" in line or re.search(r"HashAggregate|SortAggregate|Project", line)


def test_part_bounds_of_hot_keys_only(spark):
    from tripstream.plans.prefix import part_bounds
    df = spark.range(4000).selectExpr("IF(id % 2 = 0, 0, id) AS k", "id AS t", "id")
    found = part_bounds(df, ["k"], ["t", "id"])
    assert [k for k, _ in found] == [(0,)] and 4 <= len(found[0][1]) < 16
    assert part_bounds(df.where("k > 0"), ["k"], ["t", "id"]) == [] == part_bounds(df.where("false"), ["k"], ["t", "id"])


def test_the_operators_move_their_events_once(spark):
    """driving_sessions, driving_segments and sort_car_events: one exchange of the events each."""
    from conftest import SF_ORACLE
    from tripstream import operators as op
    from tripstream.sources import fixtures as fx
    cars = fx.car_events(spark, SF_ORACLE)
    for df in (op.driving_sessions(cars, "12 hours"), op.driving_segments(cars)):
        plan = _plan(df)
        assert plan.count("FileScan") <= 2 and plan.count("REPARTITION_BY_NUM") == 1
