"""Lyndon arrays, runs and the registered query against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_docs import docs_of  # noqa: F401
from tripstream.llm import periodic_runs as periodic
from tripstream.llm import queries

SF = "/root/testdata/sf0.001"


def lyndon(x):
    """Longest Lyndon word at each place: below all its proper suffixes."""
    return [max(j - i for j in range(i + 1, len(x) + 1) if all(x[i:j] < x[k:j] for k in range(i + 1, j)))
            for i in range(len(x))]


def runs(x, min_words=24, min_periods=3):
    found = []
    for p in range(1, len(x) // min_periods + 1):
        s = 0
        while s < len(x) - p:
            e = s
            while e + p < len(x) and x[e] == x[e + p]:
                e += 1
            m = e + p - s
            if e > s and m >= max(min_words, min_periods * p) and not any(
                    x[s:s + m - q] == x[s + q:s + m] for q in range(1, p)):
                found.append((s, m, p))
            s = e + 1
    return sorted(found)


@given(st.lists(st.integers(0, 2), max_size=14))
@settings(max_examples=300, deadline=None)
def test_lyndon_array(x):
    rank = np.unique(np.array(x, dtype=int), return_inverse=True)[1].tolist()
    assert periodic.lyndon_array(rank) == lyndon(x)


def stretch(rng):
    n = rng.randint(1, 70)
    x = [rng.randrange(rng.randint(1, 5)) for _ in range(n)]
    a, p = rng.randrange(n), rng.randint(1, 9)
    for i in range(a, n):
        x[i] = x[a + (i - a) % p]
    if rng.random() < 0.5:
        x[rng.randrange(n)] = 7
    return x


def test_runs_of_symbols_and_texts():
    rng = random.Random(5)
    cases = [stretch(rng) for _ in range(400)]
    for x in cases:
        assert periodic.runs_of(np.array(x)) == runs(x)
        assert periodic.runs_of(np.array(x), 4, 2) == runs(x, 4, 2)
    found = periodic.text_runs([" ".join(map(str, x)).encode() for x in cases])
    assert [r for _, r in found] == [runs(x) for x in cases]


def test_equal_hashes_are_not_trusted(monkeypatch):
    monkeypatch.setattr(periodic._Extensions, "same", lambda self, a, b, m: np.ones(np.broadcast(a, b, m).shape, bool))
    x = np.array([0, 1] * 6 + [2] + [0, 1] * 20)
    assert set(periodic.runs_of(x)) <= set(runs(x.tolist()))


def plain(doc_id, text):
    """The contract, word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs(w)
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{p}\n" for s, m, p in found)), sha(" ".join(w[i] for i in range(n) if i not in gone)))


def key(row):
    return str(tuple(row))


def test_query_against_brute_force(spark):
    rows = queries.op11_periodic_runs(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {d["doc_id"] for d in docs if len((d["text"] or "").split()) < 700}
    assert len(rows) == len(docs) and sum(r["n_runs"] > 0 for r in rows) > 10 and len(short) > 150
    want = [plain(d["doc_id"], d["text"]) for d in docs if d["doc_id"] in short]
    assert sorted(map(key, want)) == sorted(key(r) for r in rows if r["doc_id"] in short)


TEXTS = ["", None, " \t\n\x0b\x0c\r", "a", "a " * 23, "a " * 24, "a b " * 12, "x" + " a b c" * 40 + " y z", "é ß " * 30,
         "    " * 30, "a\x00b c\n" * 30, ("a b a c " * 9 + "q ") * 8, "lang " * 20000, "w" * 300_000, " ".join(map(str, range(30000)))]


def test_odd_texts_repeated_rows_and_clashing_names(docs_of):
    df = docs_of(list(enumerate(TEXTS)) + [(5, TEXTS[5]), (None, TEXTS[7])]).selectExpr("*", "'x' AS runs", "'x' AS collapsed")
    rows = periodic.periodic_runs(df).collect()
    assert len(rows) == len(TEXTS) + 2 and rows[0]["score"] == "x"
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        got = [tuple(x) for x in r["runs"]]
        if len(w) < 2000:
            assert got == runs(w) and r["n_words"] == len(w)
    by_id = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in by_id[12]["runs"]] == [(0, 20000, 1)] and by_id[12]["collapsed"] == "lang"
    assert not by_id[13]["runs"] and not by_id[14]["runs"]


def test_empty_table(spark, docs_of):
    empty = periodic.periodic_runs(docs_of([(1, "a")]).where("false"))
    assert empty.count() == 0 and {"n_words", "runs", "collapsed"} <= set(empty.columns)


@pytest.mark.parametrize("period", [1, 2, 7, 8, 9, 500])
def test_every_shortest_run_is_found(period):
    """Runs of exactly the least length survive the search for recurring groups."""
    m = max(24, 3 * period)
    w = [f"u{i}" for i in range(40)] + [f"p{i % period}" for i in range(m)] + [f"v{i}" for i in range(40)]
    assert periodic.text_runs([" ".join(w).encode()])[0][1] == [(40, m, period)]
    w[40 + m - 1] = "other"
    assert periodic.text_runs([" ".join(w).encode()])[0][1] == []
