"""Running minima with a reset (B3) against a sequential walk of each key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import BASE, MUSEUM, STATION, ride, rides_df
from tripstream import operators as op
from tripstream.plans import resets
from tripstream.plans.resets import resetting_minima

HOUR = 3_600_000_000
REPORT = "k long, t timestamp, n long, v double"


def walk(rows, reset):
    """Per key in order: (key, n) of the reports."""
    out, best = [], {}
    for k, t, n, v in sorted((r for r in rows if None not in r), key=lambda r: (r[0], r[1], r[2])):
        m = best.get(k)
        if m is not None and (t - m[1]) > dt.timedelta(microseconds=reset):
            m = None
        if m is None or v < m[0]:
            best[k] = (v, t)
            out.append((k, n))
        elif k in best and m is None:
            del best[k]
    return sorted(out)


def check(spark, rows, reset):
    df = spark.createDataFrame(rows, REPORT)
    got = sorted((r.k, r.n) for r in resetting_minima(df, "k", ["t", "n"], "v", reset).collect())
    assert got == walk(rows, reset)
    return got


@pytest.mark.parametrize("values", ["few", "rising", "falling", "random"])
def test_same_as_a_walk(spark, values):
    rnd = random.Random(values)
    rows = []
    for k, (count, hours) in enumerate([(400, 24 * 20), (150, 30), (60, 24 * 60), (1, 1), (300, 3)]):
        for n in range(count):
            at = rnd.randrange(hours * 3600)
            if rnd.random() < 0.1:                       # bursts and whole multiples of the reset
                at -= at % (8 * 3600)
            v = {"few": rnd.randrange(3), "rising": at, "falling": -at, "random": rnd.random()}[values]
            rows.append((k, BASE + dt.timedelta(seconds=at), n, float(v)))
    assert len(check(spark, rows, 8 * HOUR)) > 50


def test_exactly_at_the_reset_and_in_one_instant(spark):
    t = lambda us: BASE + dt.timedelta(microseconds=us)
    rows = [(1, t(0), 0, 5.0), (1, t(8 * HOUR), 1, 7.0), (2, t(0), 0, 5.0), (2, t(8 * HOUR + 1), 1, 7.0),
            (3, t(0), 2, 5.0), (3, t(0), 1, 5.0), (3, t(0), 3, 4.0), (3, t(0), 4, 4.5), (3, t(30 * HOUR), 5, 9.0),
            (3, t(30 * HOUR), 6, 8.0)]
    assert check(spark, rows, 8 * HOUR) == [(1, 0), (2, 0), (2, 1), (3, 1), (3, 3), (3, 5), (3, 6)]


def test_nulls_and_no_rows(spark):
    rows = [(None, BASE, 1, 1.0), (1, None, 2, 1.0), (1, BASE, 3, None), (1, BASE, 4, float("nan")), (1, BASE, 5, 2.0)]
    df = spark.createDataFrame(rows, REPORT)
    assert [r.n for r in resetting_minima(df, "k", ["t", "n"], "v", HOUR).collect()] == [5]
    assert resetting_minima(df.limit(0), "k", ["t", "n"], "v", HOUR).collect() == []


@pytest.mark.parametrize("values", ["few", "falling", "constant"])
def test_blocks_of_blocks_are_the_same_as_a_walk(spark, monkeypatch, values):
    monkeypatch.setattr(resets, "GROUP", 1)              # blocks of 4 slices: four levels
    rnd = random.Random(values)
    rows = []
    for k, (count, hours) in enumerate([(500, 90), (150, 400), (30, 900), (1, 1), (9, 9)]):
        for n in range(count):
            at = rnd.randrange(hours * 60)
            if 30 < at // 60 < 50:                       # a gap of many slices
                continue
            v = {"few": rnd.randrange(3), "rising": at, "falling": -at, "constant": 1}[values]
            rows.append((k, BASE + dt.timedelta(minutes=at), n, float(v)))
    assert len(check(spark, rows, HOUR)) > 50


def test_plans_do_not_grow_with_the_slices(spark, monkeypatch):
    # a path of some 240 slices
    rows = [(1, BASE + dt.timedelta(minutes=37 * n), n, float(n % 3)) for n in range(400)]
    frame = type(spark.range(1))
    joins, plain = [], frame.checkpoint

    def counted(df, *args, **kw):
        joins.append(df._jdf.queryExecution().analyzed().toString().count("Join "))
        return plain(df, *args, **kw)
    monkeypatch.setattr(frame, "checkpoint", counted)
    check(spark, rows, HOUR)
    assert joins and max(joins) <= 2, joins


def live(spark, queries, **kw):
    return {r.queryId: (r["_till"] - r["_since"]) // 60_000_000
            for r in op.live_queries(spark, queries, **kw).collect()}


def test_queries_are_purged_by_arrivals(spark):
    at = lambda m: (BASE + dt.timedelta(minutes=m)).strftime("%Y-%m-%d %H:%M:%S")
    qs = [(1, -74.0, 40.7, at(0)), (2, -74.0, 40.7, at(10)), (3, -74.0, 40.7, at(15)), (4, 0.0, 0.0, at(20)),
          (5, -74.0, 40.7, at(26))]
    got = live(spark, qs)
    assert {k: got[k] for k in (1, 2)} == {1: 20, 2: 16} and set(got) == {1, 2, 3, 5}
    assert got[3] > 500_000_000 and got[5] > 500_000_000       # nobody comes that late after them
    assert live(spark, qs, expiry="age") == {1: 15, 2: 15, 3: 15, 5: 15}
    with pytest.raises(ValueError):
        op.live_queries(spark, qs, expiry="never")


def test_nearest_taxi_ttl(spark):
    far = (-73.90, 40.80)
    rs = rides_df(spark, [ride(1, False, 0, 10, end=MUSEUM, taxi=1), ride(2, False, 0, 20, end=far, taxi=2),
                          ride(3, False, 0, 20 + 9 * 60, end=far, taxi=3),
                          ride(4, False, 0, 13 * 60 + 30, end=STATION, taxi=4),
                          ride(5, False, 0, -5, end=STATION, taxi=5)])
    q = (5, *STATION, BASE.strftime("%Y-%m-%d %H:%M:%S"))
    taxis = lambda qs, **kw: sorted(r.taxiId for r in op.nearest_taxi_ttl(rs, qs, **kw).collect())
    assert taxis([q]) == [1, 3, 4]                     # no later query: live for ever
    purge = (6, 0.0, 0.0, (BASE + dt.timedelta(hours=13)).strftime("%Y-%m-%d %H:%M:%S"))
    assert taxis([q, purge]) == [1, 3]
    assert taxis([q], retention="12 hours", expiry="age") == [1, 3]
    assert op.nearest_taxi_ttl(rs.where(F.lit(False)), [q]).collect() == []
