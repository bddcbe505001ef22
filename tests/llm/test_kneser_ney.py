"""The distributed model against a plain one that counts in dictionaries."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_docs import docs_of  # noqa: F401
from tripstream.llm import kneser_ney as lm
from tripstream.llm.queries import op1_lm_scoring

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def brute(train, texts):
    pair, count = collections.Counter(), collections.Counter()
    for t in train:
        previous = "^"
        for w in tokens(t):
            pair[previous, w] += 1
            count[w] += 1
            previous = w
    types = collections.Counter(b for _, b in pair)
    total, ones = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (a, _), c in pair.items():
        total[a] += c
        ones[a][min(c, 3) - 1] += 1

    def cut(counts):
        n = collections.Counter(counts)
        return lm.discounts(n[1], n[2], n[3], n[4])
    d2, d1 = cut(pair.values()), cut(types.values())
    big, v, size = sum(types.values()), len(types), sum(count.values())
    left = sum(d1[min(c, 3) - 1] for c in types.values()) / big if big else 1.0

    def lower(w):
        t = types[w]
        return ((t - d1[min(t, 3) - 1]) / big if t else 0) + left / (v + 1)
    out = []
    for text in texts:
        score = base = 0.0
        known, previous = 0, "^"
        for w in tokens(text):
            c = pair[previous, w]
            p = (c - d2[min(c, 3) - 1]) / total[previous] if c else 0.0
            gamma = sum(d * k for d, k in zip(d2, ones[previous])) / total[previous] if total[previous] else 1.0
            score += math.log10(p + gamma * lower(w))
            base += math.log10((count[w] + 1) / (size + v + 1))
            known += count[w] > 0
            previous = w
        out.append((len(tokens(text)), known, size, base, score))
    return out


def test_whole_table_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    want = dict(zip((r[0] for r in rows), brute([r[1] for r in rows if not held(r[0])], [r[1] for r in rows])))
    got = op1_lm_scoring(spark, SF).collect()
    assert len(got) == len(rows)
    gain = []
    for r in got:
        n, known, size, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, size)
        assert r["held_out"] == held(r["doc_id"])
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-9)
        if r["held_out"]:
            gain.append((r["score"] - r["base_score"]) / n)
    assert np.mean(gain) > 0


def test_odd_texts_and_busy_word(spark, docs_of):
    texts = ["the " * 400 + "cat the dog", "the cat", "the cat", "", None, " \t\n", "É é A a", "x\0y \x1c z", "dog " * 3000]
    df = docs_of(list(enumerate(texts)) + [(None, "the dog")])
    learn = F.coalesce(F.col("doc_id") < 6, F.lit(True))
    model = lm.train_model(df, learn, shards=5)
    assert len(model.shards.busy) and model.shards.spread.max() > 1
    want = brute([t for k, t in enumerate(texts) if k < 6] + ["the dog"], texts + ["the dog"])
    got = {r["doc_id"]: r for r in lm.score_documents(df, model).collect()}
    for k, (n, known, size, base, score) in zip([*range(len(texts)), None], want):
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, size)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)


def test_probabilities_sum_to_one(spark, docs_of):
    train = ["a b c a b d", "b c a", "a a a b", "d c b a e"]
    model = lm.train_model(docs_of(list(enumerate(train))), F.lit(True), shards=3)
    scorer = lm.Scorer(model)
    vocabulary = ["a", "b", "c", "d", "e"]
    for context in [*vocabulary, "unseen"]:
        texts = pa.array([f"{context} {w}" for w in vocabulary] + [context, f"{context} new"])
        alone = lm.Tokens(texts)
        # P(w | context): from the pair counts of the second token
        a = alone.hashes[alone.previous[alone.first[:-1] + 1]]
        b = alone.hashes[alone.token[alone.first[:-1] + 1]]
        _, lower, _, _ = scorer.words(b)
        _, _, total, gamma = scorer.words(a)
        c = scorer.pairs(a, b)
        d = np.select([c == 0, c == 1, c == 2], [0.0, *model.pair_discounts[:2]], model.pair_discounts[2])
        assert ((c - d) / np.maximum(total, 1) + gamma * lower).sum() == pytest.approx(1)


def test_nothing_to_learn_from(spark, docs_of):
    df = docs_of([(1, "a b"), (2, None)])
    model = lm.train_model(df, F.lit(False))
    rows = lm.score_documents(df, model).collect()
    assert [(r["score"], r["base_score"], r["n_known"], r["train_tokens"]) for r in rows] == [(0.0, 0.0, 0, 0)] * 2
    assert lm.score_documents(df.where("false"), model).count() == 0


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    a, b = np.sort(rng.integers(0, 2**64, 50, dtype=np.uint64)), rng.integers(0, 2**64, 50, dtype=np.uint64)
    a[10:20] = a[10]
    b[10:20].sort()
    count = rng.integers(1, 300, 50).astype(np.uint64)
    for x, y in zip(lm.unpack_pairs(lm.pack_pairs(a, b, count)), (a, b, count)):
        assert (x == y).all()
    assert [len(x) for x in lm.unpack(lm.pack(count[:0], count))] == [0, 50]
