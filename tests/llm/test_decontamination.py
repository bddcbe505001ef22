"""Wu-Manber search against a plain comparison of all windows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from llm_docs import docs_of  # noqa: F401
from tripstream.llm import wu_manber as leaks


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    """(hit words, items) per document."""
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            b = words(body)
            size = min(len(b), window)
            patterns = {tuple(b[k:k + size]) for k in range(len(b) - size + 1)} if size else set()
            for k in range(len(w) - size + 1):
                if size and tuple(w[k:k + size]) in patterns:
                    hit.update(range(k, k + size))
                    found.add(item)
        out.append((len(w), sorted(hit), sorted(found)))
    return out


def test_search_on_random_words():
    rnd = random.Random(7)
    for _ in range(60):
        alphabet = ["a", "b", "C", "é", "日本", "x1"][:rnd.randint(2, 6)]
        make = lambda n: rnd.choice([" ", ". ", "-"]).join(rnd.choice(alphabet) for _ in range(rnd.randint(0, n)))
        items = [(str(k), make(rnd.choice([3, 14, 30]))) for k in range(rnd.randint(0, 6))]
        docs = [make(rnd.choice([0, 5, 60, 1200])) for _ in range(6)] + ["", None]
        window = rnd.choice([1, 3, 10])
        tables = leaks.PatternTables([k for k, _ in items], pa.array([b for _, b in items], pa.string()), window)
        w, first = leaks.split_words(pa.array(docs, pa.string()))
        spans, pairs = tables.find(w, first)
        hit = np.zeros(len(w), bool)
        for a, b in spans:
            hit[a:b] = True
        for k, (n, places, found) in enumerate(brute(docs, items, window)):
            assert first[k + 1] - first[k] == n
            assert np.flatnonzero(hit[first[k]:first[k + 1]]).tolist() == places
            assert sorted(items[j][0] for d, j in pairs if d == k) == found


DOCS = [(1, "x y one two three four five six seven eight nine ten z"), (2, None), (3, ""), (4, "One TWO three four five"),
        (5, "short item"), (6, "a short, item! again short item"), (None, "short item"), (5, "short item"),
        (7, "ten one two three four five six seven eight nine ten one two three four five six seven eight nine ten " * 200)]
ITEMS = [(10, "one two three four five six seven eight nine ten"), (9, "Short item"), (None, "one two"), (8, None), (7, ""),
         (11, "ten one two three four five six seven eight nine ten one"), (9, "again")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_operator_in_one_and_many_blocks(spark, docs_of, block_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = leaks.decontaminate(docs_of(DOCS), bench, block_bytes=block_bytes).collect()
    known = [(str(k), t) for k, t in ITEMS if k is not None]
    want = sorted((str(i), n, len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit))
                  for (i, _), (n, hit, found) in zip(DOCS, brute([t for _, t in DOCS], known, 10)))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                  for r in got) == want
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = leaks.decontaminate(docs_of(DOCS), none).collect()
    assert len(rows) == len(DOCS) and not any(r["contaminated"] for r in rows)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert leaks.decontaminate(docs_of(DOCS).where("false"), bench).count() == 0
