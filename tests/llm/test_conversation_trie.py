"""The trie of conversations against plain Python, and its batches."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tripstream.llm import conversation_trie as trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(talks):
    """All prefixes of {conv_id: [(role, text), ...]}, by dictionaries."""
    members = collections.defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children[p]
        leaves[p] = sum(leaves[q] for q in below) or 1
        saved[p] = sum(saved[q] for q in below) + ((len(members[p]) - 1) * len(p[-1][1].split()) if p else 0)
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(talks[c]) == len(p)))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children[p]), leaves[p],
                    saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def frame(spark, talks):
    rows = [(c, k, role, text) for c, turns in talks.items() for k, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("path", "n", "node", "p", "total", "first"):
        df = df.withColumn(name, F.lit("x"))
    return df


def nodes(df):
    return [tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(trie.conversation_turns(df)).collect()]


def same(got, want):
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(want, key=key)


def turn(k):
    return ("user" if k % 2 else "assistant", f"turn {k} of words"[: 3 + 7 * (k % 3)])


def shapes():
    rng = random.Random(3)
    apart = [{c: [turn(rng.randrange(3)) for _ in range(rng.randint(1, 9))] for c in range(150)},
             {100 - k: [turn(j) for j in range(k)] for k in range(1, 40)},                    # each a prefix of the next
             {k: [turn(j) for j in range(k)] + [("user", f"own {k}")] for k in range(30)},    # one leaves at every depth
             {c: [turn(1), turn(2), turn(5)] for c in range(0, 9000, 90)},
             {-5: [turn(1)], 3: [turn(1), turn(2)]}, {1: [("", "")], 2: [("", ""), ("", "")]}]
    one = {10_000 * k + c: [("system", f"shape {k // 2}"), *turns] for k, talks in enumerate(apart) for c, turns in talks.items()}
    return {"many": one | {-7: [("", "")]},
            "long": {1: [turn(j) for j in range(700)], 2: [turn(j) for j in range(513)] + [turn(0)], 3: [turn(0)]}}


@pytest.mark.parametrize("shape", list(shapes()))
def test_against_dictionaries(spark, shape):
    talks = shapes()[shape]
    same(nodes(frame(spark, talks)), plain(talks))


def test_batches_are_few(spark, monkeypatch):
    """A comb of 200 depths goes in about as many batches as 200 has bits."""
    batches = []
    locate = trie.locate
    monkeypatch.setattr(trie, "locate", lambda *a: batches.append(1) or locate(*a))
    talks = {k: [turn(j) for j in range(k)] + [("user", f"own {k}")] for k in range(200)}
    paths = trie.write_table(trie.prefix_paths(trie.conversation_turns(frame(spark, talks))), "t")
    found = trie.sequences(paths)
    assert trie.build(found).count() >= 399 - 1 and 1 <= len(batches) <= 20


def test_nulls_ties_repeated_rows_and_empty_conversations(spark):
    rows = [(1, None, None, "a b"), (1, 0, "user", None), (1, 0, "user", None), (None, 0, "user", "lost"),
            (2, 0, "", "a b"), (2, 1, "user", ""), (2, 2, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks = {c: [("", "a b"), ("user", ""), ("user", "")] for c in (1, 2)}
    same(nodes(df), plain(talks))
    none = trie.conversation_turns(df).unionByName(
        spark.createDataFrame([(9, [])], "conv_id long, turns array<struct<digest:binary,words:long>>"))
    got = [tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(none).collect()]
    same(got, plain(talks | {9: []}))
    only = spark.createDataFrame([(9, []), (4, [])], "conv_id long, turns array<struct<digest:binary,words:long>>")
    same([tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(only).collect()], plain({9: [], 4: []}))
    tied = spark.createDataFrame([(1, 0, "x", "p"), (1, 0, "x", "q"), (2, 0, "x", "q"), (2, 0, "x", "p")],
                                 "conv_id long, turn long, role string, text string")
    assert max(r[3] for r in nodes(tied) if r[1] == 2) == 2


def test_empty_table_and_very_long_text(spark):
    df = spark.createDataFrame([(1, 0, "u", "w " * 500_000), (2, 0, "u", "w " * 500_000)],
                               "conv_id long, turn long, role string, text string")
    assert nodes(df.where("false")) == []
    assert sorted(r[6] for r in nodes(df)) == [500_000, 500_000]


def test_fattest_depth(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a int, b int").select("a", "b", trie.fattest("a", "b").alias("f"))
    for r in df.collect():
        assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda d: (d & -d))
