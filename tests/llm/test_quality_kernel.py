"""Document statistics, normal equations and calibration against plain versions,
and the classifier on held-out labels."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_docs import docs_of  # noqa: F401
from tripstream.llm import quality_kernel as kernel
from tripstream.llm import queries

SF = "/root/testdata/sf0.01"
TEXTS = ["", None, " \n\t ", "a", "\n", "Alle Wörter sind gut. Ja!", "a a a b\na a a b\n\nc", "x|y | z #\n### $$$ ***\nplain words here",
         "SHOUT!! LOUD!!\nlower", "é" * 40, "1 2 3 4 5 6", "w" * 200_000, "the same line\n" * 500, "tail\n", "one two three. " * 2000]


def plain(text):
    """The statistics of one text, character by character."""
    text = text or ""
    if not text:
        return [0.0] * len(kernel.STATS)
    n = len(text)
    share = lambda t, k, of: sum(k(c) for c in t) / of
    kinds = {"letter": lambda c: c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" or ord(c) > 127,
             "capital": lambda c: "A" <= c <= "Z", "digit": lambda c: "0" <= c <= "9", "sign": lambda c: c in "#*$%&|<>@_~^=+/\\{}[]",
             "bar": lambda c: c == "|", "shout": lambda c: c in "!?", "stop": lambda c: c == ".", "comma": lambda c: c in ",;:",
             "space": lambda c: c in " \t\n\r\x0b\x0c"}
    lines = text.split("\n")
    words = text.encode().split()
    length = [len(w.decode()) for w in words]
    w = len(words)
    mean = sum(length) / w if w else 0
    pairs = list(zip(words, words[1:]))
    per = lambda a, b: a / b if b else 0.0
    of_line = [x.encode().split() for x in lines]
    # a repeat counts in the line of its second word, also across a line feed
    repeats, last = [0] * len(lines), None
    for k, line in enumerate(of_line):
        for word in line:
            repeats[k] += word == last
            last = word
    pieces = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    return [*[share(text, kinds[k], n) for k in kernel._SHARES],
            *[max(share(x + "\n" * (k < len(lines) - 1), kinds[name], max(len(x) + (k < len(lines) - 1), 40)) for k, x in enumerate(lines))
              for name in kernel._WORST],
            math.log1p(n), math.log1p(w), mean, math.sqrt(max(per(sum(x * x for x in length), w) - mean * mean, 0)),
            per(sum(x <= 3 for x in length), w), per(sum(x > 12 for x in length), w), per(math.log1p(len(set(words))), math.log1p(w)),
            per(max(Counter(words).values(), default=0), w), per(sum(a == b for a, b in pairs), w),
            max(r / max(len(x), 8) for r, x in zip(repeats, of_line)), per(len(set(pairs)), w), math.log1p(len(lines)),
            math.log1p(n / len(lines)), (len(lines) - len(set(pieces))) / len(lines)]


def test_statistics_one_by_one():
    got = kernel.statistics(pa.array(TEXTS))
    want = np.array([plain(t) for t in TEXTS])
    assert got.shape == want.shape
    for k, name in enumerate(kernel.STATS):
        np.testing.assert_allclose(got[:, k], want[:, k], atol=1e-6, err_msg=name)
    for text in TEXTS:                          # alone, sliced and in company
        one = kernel.statistics(pa.array(["before", text, "after"]).slice(1, 1))
        np.testing.assert_allclose(one[0], plain(text), atol=1e-6)


def test_normal_equations_are_those_of_all_rows(spark):
    rng = np.random.RandomState(0)
    stats, label, fold = rng.normal(size=(500, len(kernel.STATS))), rng.randint(0, 2, 500), rng.randint(0, 3, 500)
    df = spark.createDataFrame([(s.tolist(), int(y), int(f)) for s, y, f in zip(stats, label, fold)],
                               "stats array<double>, label int, fold int").repartition(7)
    mean, scale = stats.mean(axis=0), stats.std(axis=0)
    sums = kernel._normal_equations(df, mean, scale)
    z = np.column_stack([kernel.fourier(stats, mean, scale), label])
    assert set(sums) == {0, 1, 2}
    for f, m in sums.items():
        np.testing.assert_allclose(m, z[fold == f].T @ z[fold == f], atol=1e-8)
    w = kernel.ridge(sum(sums.values()), 1e-3)
    held = 1e-3 * len(z) * np.eye(z.shape[1] - 1)
    held[-1, -1] = 0
    np.testing.assert_allclose(w, np.linalg.solve(z[:, :-1].T @ z[:, :-1] + held, z[:, :-1].T @ label), atol=1e-6)
    assert abs(kernel._error(sums[0], w) - ((z[fold == 0, :-1] @ w - label[fold == 0]) ** 2).sum()) < 1e-6


def test_features_approximate_the_gaussian_kernel(monkeypatch):
    monkeypatch.setattr(kernel, "directions", lambda f=kernel.directions: f(20000))
    x = np.random.RandomState(1).normal(size=(20, len(kernel.STATS)))
    z = kernel.fourier(x, np.zeros(x.shape[1]), np.ones(x.shape[1]))[:, :-1]
    square = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    want = np.exp(-square / (2 * kernel.WIDTH ** 2 * len(kernel.STATS)))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_isotonic_is_the_best_rising_fit():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 7)
        rows = [rng.randint(1, 5) for _ in range(n)]
        ones = [rng.randint(0, r) for r in rows]
        at, rate = kernel.isotonic(np.arange(n, dtype=float), np.array(rows, float), np.array(ones, float))
        assert (np.diff(rate) > 0).all() and (np.diff(at) > 0).all()
        # the fit at each step: largest over starts of the smallest mean up to an end
        best = [max(min(sum(ones[a:b + 1]) / sum(rows[a:b + 1]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert sorted(set(np.round(best, 9))) == sorted(set(np.round(rate, 9)))


def test_held_out_quality(spark):
    rows = queries.op13_quality_classifier(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows.count() == docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = rows.join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    assert len(known) > 80 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in known)
    good = [r["predicted"] for r in known if r["quality"] == 1]
    junk = [r["predicted"] for r in known if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(junk) <= 0.05 * len(junk)


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    other = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = kernel.train(docs, labels, learn), kernel.train(docs, other, learn)
    np.testing.assert_allclose(a.weights, b.weights)
    np.testing.assert_allclose(a.rates, b.rates)


@pytest.mark.parametrize("labels, want", [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (2, 0), (None, 1), (3, None)], 0.0)])
def test_without_both_labels(spark, docs_of, labels, want):
    df = docs_of([(k, t) for k, t in enumerate(TEXTS)])
    model = kernel.train(df, spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(True))
    assert {r["score"] for r in kernel.score_documents(df, model).collect()} == {want}


def test_odd_rows(spark, docs_of):
    df = docs_of([(k, t) for k, t in enumerate(TEXTS)] + [(3, "a"), (None, "x")])
    labels = spark.createDataFrame([(k, k % 2) for k in range(len(TEXTS))] + [(3, 0)], "doc_id long, quality int")
    model = kernel.train(df, labels, F.lit(True))
    rows = kernel.score_documents(df, model).collect()
    assert len(rows) == len(TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in rows) and rows[0]["word"] == "x"
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    described = kernel.score_statistics(kernel.document_statistics(df), model).collect()
    assert sorted((r["doc_id"] or -1, r["score"]) for r in described) == sorted((r["doc_id"] or -1, r["score"]) for r in rows)
    empty = kernel.score_documents(df.where("false"), model)
    assert empty.count() == 0
    assert kernel.train(df.where("false"), labels, F.lit(True)).rates[0] == 0.5
