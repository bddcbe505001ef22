"""Multiple-instance learning: held-out accuracy, locating, odd inputs."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_docs import docs_of  # noqa: F401
from tripstream.llm import queries
from tripstream.llm import toxicity_mil as tox

SF = "/root/testdata/sf0.01"
CLEAN = ["the sun is out. we walk home.", "a good day! the tea is warm.", "birds sing\nrain falls.", "one two three. four five."]


def sample(n=240):
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for k in range(n):
        parts = [CLEAN[i] for i in rng.integers(0, 4, 4)]
        if k % 4 == 0:
            parts.insert(int(rng.integers(0, 4)), "you vile grobnak person.")
        texts.append(" ".join(parts))
        labels.append(int(k % 4 == 0))
    return texts, np.array(labels)


def test_learns_from_document_labels_and_locates_the_sentence():
    texts, labels = sample()
    model = tox.fit(texts[:160], labels[:160])
    score, p = model.score(tox.split_sentences(pa.array(texts[160:])))
    assert ((score >= 0.7) == (labels[160:] > 0)).all()
    text = "The sun is out. You vile GROBNAK person. a good day!"
    s = tox.split_sentences(pa.array([text]))
    _, p = model.score(s)
    assert p.argmax() == 1 and (p[[0, 2]] < 0.1).all()
    assert text[s.span[1, 0]:s.span[1, 1]].strip() == "You vile GROBNAK person."


def test_learns_many_rare_words():
    """200 offending words, each in about one in a hundred toxic documents."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    word = lambda: "".join(rng.choice(letters, 9))
    rare, usual = [word() for _ in range(200)], np.array([word() for _ in range(800)])
    texts, labels = [], []
    for k in range(3200):
        parts = [" ".join(rng.choice(usual, 8)) + "." for _ in range(8)]
        if k % 2 == 0:
            for w in rng.choice(rare, 2, replace=False):
                parts[rng.integers(0, 8)] = f"{rng.choice(usual)} {w} {rng.choice(usual)}."
        texts.append(" ".join(parts))
        labels.append(int(k % 2 == 0))
    labels = np.array(labels)
    model = tox.fit(texts[:2800], labels[:2800])
    score, _ = model.score(tox.split_sentences(pa.array(texts[2800:])))
    found = score >= 0.7
    assert found[labels[2800:] > 0].mean() > 0.8 and found[labels[2800:] == 0].mean() < 0.05


def test_labels_of_long_texts_count(spark, docs_of):
    """All toxic texts are longer than the sample takes by itself."""
    texts, labels = sample(80)
    docs = docs_of([(k, t + " " * 400 * int(y)) for k, (t, y) in enumerate(zip(texts, labels))])
    known = spark.createDataFrame([(k, int(y)) for k, y in enumerate(labels)], "doc_id long, toxic int")
    model = tox.train(docs, known, F.lit(True), sample_chars=300)
    score, _ = model.score(tox.split_sentences(pa.array(["you vile grobnak person.", "the sun is out."])))
    assert score[0] >= 0.7 and score[1] < 0.3


def test_noisy_or():
    model = tox.Model(np.zeros(1 << tox.FEATURE_BITS, np.float32), -1.0)
    p = 1 / (1 + np.exp(1.0))
    score, _ = model.score(tox.split_sentences(pa.array(["a. b. c.", "a", "", None, " ... "])))
    assert score == pytest.approx([1 - (1 - p) ** 3, p, p, p, p])


def test_held_out_accuracy(spark):
    rows = queries.op2_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    clean = [r["predicted"] for r in held if not r["toxic"]]
    toxic = [r["predicted"] for r in held if r["toxic"]]
    assert np.mean(clean) < 0.05 and np.mean(toxic) > 0.6


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    a = tox.train(docs, labels, learn, sample_toxic=20, sample_clean=40)
    turned = labels.withColumn("toxic", F.when(learn, F.col("toxic")).otherwise(1 - F.col("toxic")))
    b = tox.train(docs.drop("lang", "source"), turned, learn, sample_toxic=20, sample_clean=40)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_odd_rows_and_empty_tables(spark, docs_of):
    texts, known = sample(40)
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (None, "vile grobnak"), (0, texts[0])]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(k, int(v)) for k, v in enumerate(known)] + [(None, 1), (5, None), (1, 1), (1, 0)],
                                   "doc_id long, toxic int")
    model = tox.train(docs, labels, F.col("doc_id") >= 0)
    out = tox.score_documents(docs, model)
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert out.where("false").count() == 0
    none = tox.train(docs.where("false"), labels, F.col("doc_id") >= 0)
    assert len({r["score"] for r in tox.score_documents(docs, none).collect()}) == 1
    one = tox.train(docs, labels.where("toxic = 0"), F.col("doc_id") >= 0)
    assert len({r["predicted"] for r in tox.score_documents(docs, one).collect()}) == 1


def plain_score(text, weights, bias):
    """Noisy-or over the sentences of one text, word by word."""
    miss, any_words = 1.0, False
    for sentence in re.split(r"[.!?\n]", (text or "").lower()):
        logit, found = bias, set(re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", sentence))
        for w in found:
            for kind, part in [(0, w), *[(k, w[:k]) for k in tox.PREFIXES]]:
                logit += float(weights[zlib.crc32(part.encode(), kind) % (1 << tox.FEATURE_BITS)])
        if found:
            any_words = True
            miss *= 1 - 1 / (1 + math.exp(-max(-40.0, min(40.0, logit))))
    return 1 - miss if any_words else 1 / (1 + math.exp(-bias))


def test_whole_table_against_a_plain_scorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = tox.fit(*sample())
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = tox.score_documents(docs, model, keep=["doc_id"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["score"] == pytest.approx(plain_score(texts[r["doc_id"]], model.weights, model.bias), abs=1e-5)
        assert r["predicted"] == int(r["score"] >= 0.7)
