"""Toxicity by multiple-instance learning over sentences.

A document's label says only whether some sentence is toxic. A sentence's score
is a logistic function of the sum of its words' weights; a word has weights for
itself and for its first three to eight characters. The document's score is the
noisy-or of its sentences, 1 - prod(1 - p), and the weights are fitted to the
document labels through it, so the sentences that make a document toxic are
learnt without sentence labels and can be located afterwards.

The model is fitted on a bounded sample of labelled rows (the ids
with the smallest hash, ``SAMPLE_TOXIC`` of the toxic and ``SAMPLE_CLEAN`` of the
clean ones, weighted by the share of their label among all labelled rows; texts up to ``SAMPLE_CHARS`` characters, and where
those of a label run out its shortest longer ones, up to ``SAMPLE_CHARS`` times the missing rows in all; never cut). Scoring covers every whole text; its cost
per batch is one weight sum per distinct word.

Null and empty texts have no sentence and get the score of the model's bias.
Labels that contradict each other for an id count as toxic; null labels and ids
are not learnt from. Without both kinds of label every score is the base rate.
Repeated rows are scored one by one; input columns named like an output are
replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, strings_between, text_bytes, write_table

SAMPLE_TOXIC = 1_500
SAMPLE_CLEAN = 3_500
SAMPLE_CHARS = 20_000
FEATURE_BITS = 20
PREFIXES = (3, 4, 5, 6, 7, 8)
STEPS = 200

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".!?\n"]] = True


def _feature(kind: int, text: str) -> int:
    return zlib.crc32(text.encode(), kind) & ((1 << FEATURE_BITS) - 1)


def word_features(words: list[str]) -> np.ndarray:
    """Feature numbers per word: the word, then its prefixes; a prefix longer
    than the word repeats the word's own number with another kind."""
    out = np.empty((len(words), 1 + len(PREFIXES)), dtype=np.int32)
    out[:, 0] = [_feature(0, w) for w in words]
    for column, k in enumerate(PREFIXES, 1):
        out[:, column] = [_feature(k, w[:k]) for w in words]
    return out


@dataclass
class Sentences:
    """Distinct words of a batch's sentences as numbers, the first word of each sentence that has
    one, the first sentence of each text, and the sentences' byte spans."""
    words: list[str]
    number: np.ndarray
    first_word: np.ndarray
    first_sentence: np.ndarray
    span: np.ndarray


def split_sentences(text: pa.Array) -> Sentences:
    """Sentences end after ``.``, ``!``, ``?`` or a newline."""
    low = pc.utf8_lower(pc.fill_null(text, ""))
    data, ends = text_bytes(low)
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Sentences([], empty, np.zeros(1, np.int64), np.zeros(len(text) + 1, np.int64), empty.reshape(0, 2))
    word = _WORD[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[1:n] = word[1:] != word[:-1]
    cut[ends] = cut[n] = True
    cuts = np.flatnonzero(cut)
    stop = np.zeros(n + 1, dtype=bool)          # a sentence begins here
    stop[1:n] = _END[data[:-1]] & ~_END[data[1:]]
    stop[ends] = stop[0] = stop[n] = True
    begins = np.flatnonzero(stop)
    is_word = word[cuts[:-1]]
    coded = strings_between(data, cuts).filter(pa.array(is_word)).dictionary_encode()
    at = cuts[:-1][is_word]
    sentence = np.searchsorted(begins, at, side="right") - 1
    # a word counts once in a sentence
    many = max(len(coded.dictionary), 1)
    both = np.unique(sentence * many + coded.indices.to_numpy())
    sentence, number = both // many, both % many
    new = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]]) if len(at) else np.zeros(0, np.int64)
    kept = sentence[new]
    first_sentence = np.searchsorted(begins[kept], ends)
    return Sentences([w.decode() for w in coded.dictionary.to_pylist()], number,
                     np.r_[new, len(number)], first_sentence, np.stack([begins[kept], begins[kept + 1]], 1))


def _group_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each group between consecutive firsts; a group may be empty."""
    out = np.zeros(len(first) - 1)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[full])
    return out


def _sample_sentences(texts: list[str], step: int = 200) -> Sentences:
    """``split_sentences`` of the sample, ``step`` texts at a time, with one
    numbering of the words (small temporary arrays on the driver)."""
    numbers: dict[str, int] = {}
    words, sentences = 0, 0
    number, first_word, first_sentence = [], [np.zeros(1, np.int32)], [np.zeros(1, np.int32)]
    for k in range(0, len(texts), step):
        s = split_sentences(pa.array(texts[k:k + step], pa.string()))
        known = np.array([numbers.setdefault(w, len(numbers)) for w in s.words], dtype=np.int32)
        number.append(known[s.number] if len(known) else s.number.astype(np.int32))
        first_word.append((s.first_word[1:] + words).astype(np.int32))
        first_sentence.append((s.first_sentence[1:] + sentences).astype(np.int32))
        words += len(s.number)
        sentences += len(s.first_word) - 1
    return Sentences(list(numbers), np.concatenate(number), np.concatenate(first_word),
                     np.concatenate(first_sentence), np.zeros((0, 2), np.int64))


class Model:
    """Feature weights and bias; scores of sentences and documents. Without
    weights every document's score is that of the bias."""

    def __init__(self, weights: np.ndarray | None, bias: float):
        self.weights, self.bias = weights, bias

    def word_weights(self, words: list[str]) -> np.ndarray:
        return self.weights[word_features(words)].sum(axis=1) if words else np.zeros(0)

    def score(self, s: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """(document scores, sentence scores)."""
        if self.weights is None:
            return np.full(len(s.first_sentence) - 1, 1 / (1 + np.exp(-self.bias))), np.zeros(len(s.first_word) - 1)
        logit = _group_sums(self.word_weights(s.words)[s.number], s.first_word) + self.bias
        p = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        miss = _group_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), s.first_sentence)
        doc = -np.expm1(miss)
        doc[np.diff(s.first_sentence) == 0] = 1 / (1 + np.exp(-self.bias))
        return np.clip(doc, 0, 1), p


def _squares(g: np.ndarray, s: Sentences, column: np.ndarray, features: int) -> np.ndarray:
    """Of each feature, the sum over documents of the squared pull of the
    document's sentences ``g`` on it."""
    by_word = np.repeat(g, np.diff(s.first_word))
    document = np.repeat(np.repeat(np.arange(len(s.first_sentence) - 1), np.diff(s.first_sentence)),
                         np.diff(s.first_word))
    out = np.zeros(features)
    for c in column.T:
        both, where = np.unique(document * features + c[s.number], return_inverse=True)
        out += np.bincount(both % features, weights=np.bincount(where, weights=by_word) ** 2, minlength=features)
    return out


def fit(texts: list[str], labels: np.ndarray, rate: float | None = None, steps: int = STEPS,
        least: float = 4.0, share: float = 0.05,
        sure: float = 3.0) -> Model:
    """Weights by full-batch Adam on the noisy-or likelihood. Weights are evidence
    for toxicity only (never negative). In the first half of the steps a feature
    needs the pull of more toxic documents than ``least``, and than a ``share`` of
    them (one sentence's part of each) or ``sure`` standard errors of its own pull,
    whichever is less, to grow. The error is the root of the summed squares of the
    pulls of its documents, toxic and clean, at the first step, so the bar of a rare
    word of toxic documents alone is ``sure`` squared of them in a sample of any
    size. The second half refits those that did, with a tenth of that. ``rate`` is
    the share of toxic documents, if the sample has another one."""
    labels = np.asarray(labels, dtype=np.float64)
    weights = np.zeros(1 << FEATURE_BITS)
    own = float(labels.mean()) if len(labels) else 0.0
    rate = float(np.clip(own if rate is None else rate, 1e-4, 1 - 1e-4))
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(None, float(np.log(rate / (1 - rate))))
    s = _sample_sentences(texts)
    column = word_features(s.words)
    used = np.flatnonzero(np.bincount(column.ravel(), minlength=1 << FEATURE_BITS))
    place = np.zeros(1 << FEATURE_BITS, dtype=np.int32)
    place[used] = np.arange(len(used))
    column, number = place[column], s.number
    weight = np.where(labels > 0, rate / own, (1 - rate) / (1 - own))
    mean = max(1.0, len(s.first_word) / len(labels))
    bias = float(np.log(rate / mean / (1 - rate / mean)))
    w = np.zeros(len(used))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    per_text = np.diff(s.first_sentence)
    words_of = np.diff(s.first_word)
    one = rate / own / mean / len(labels)
    for t in range(1, steps + 1):
        if t == steps // 2:
            chosen = w > 0
        z = sum(w[c] for c in column.T)
        p = 1 / (1 + np.exp(-np.clip(_group_sums(z[number], s.first_word) + bias, -40, 40)))
        miss = np.exp(_group_sums(np.log1p(-np.minimum(p, 1 - 1e-9)), s.first_sentence))
        hit = np.maximum(1 - miss, 1e-6)
        # d loss / d logit of a sentence: p where the document is clean,
        # -p (1 - P) / P where it is toxic
        g = p * np.repeat(weight * np.where(labels > 0, -miss / hit, 1.0), per_text) / len(labels)
        if t == 1:
            first = np.minimum(share * labels.sum() * one, sure * np.sqrt(_squares(g, s, column, len(used))))
            first = np.maximum(first, least * one)
        pull = first if t < steps // 2 else 0.1 * first
        by_word = np.bincount(number, weights=np.repeat(g, words_of), minlength=len(s.words))
        gw = sum(np.bincount(c, weights=by_word, minlength=len(used)) for c in column.T) + pull
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9 ** t, 1 - 0.99 ** t
        w = np.maximum(w - 0.1 * (m / a) / (np.sqrt(v / b) + 1e-5), 0)
        if t >= steps // 2:
            w *= chosen
        bias -= 0.05 * (mb / a) / (np.sqrt(vb / b) + 1e-5)
    weights[used] = w
    return Model(weights.astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_toxic: int = SAMPLE_TOXIC,
          sample_clean: int = SAMPLE_CLEAN, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on labelled rows for which ``learn`` (a condition on the id) holds."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
             .groupBy("id").agg(F.max("label").alias("label")))
    texts = docs.where(learn).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sizes = texts.groupBy("id").agg(F.min(F.length("text")).alias("chars"))
    learnt = write_table(sizes.join(known, "id"), "toxicity-labels")
    counts = learnt.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("toxic")).first()
    if not counts["n"]:
        return fit([], np.zeros(0))
    ids = []
    for label, most in (("label > 0", sample_toxic), ("label <= 0", sample_clean)):
        of = learnt.where(label)
        short = of.where(F.col("chars") <= sample_chars).orderBy(F.xxhash64("id"), "id").limit(most).collect()
        ids += short
        left = (most - len(short)) * sample_chars
        if left:
            for r in (of.where(F.col("chars") > sample_chars).orderBy("chars", F.xxhash64("id"), "id")
                      .limit(most - len(short)).collect()):
                left -= r["chars"]
                if left < 0:
                    break
                ids.append(r)
    chosen = docs.sparkSession.createDataFrame(ids, learnt.schema)
    # bounded by the three parameters; of rows that share an id the first of the shortest counts
    rows = (texts.join(F.broadcast(chosen), "id").where(F.length("text") == F.col("chars")).groupBy("id", "label").agg(F.min("text").alias("text"))
            .orderBy(F.xxhash64("id"), "id").collect())
    texts, known = [r["text"] for r in rows], np.array([r["label"] for r in rows])
    del rows
    return fit(texts, known, counts["toxic"] / counts["n"])


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7,
                    sentence_threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` (1 if score >= threshold) and
    ``offending``: byte spans and scores of the sentences at or above
    ``sentence_threshold``, in the lower-cased text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def make():
        known = Model(*shared.value)

        def work(text):
            s = split_sentences(text)
            score, p = known.score(s)
            found = np.flatnonzero(p >= sentence_threshold)
            base = text_bytes(pc.utf8_lower(pc.fill_null(text, "")))[1]
            row = np.searchsorted(s.first_sentence, found, side="right") - 1
            spans = pa.StructArray.from_arrays(
                [pa.array(s.span[found, 0] - base[row], pa.int32()), pa.array(s.span[found, 1] - base[row], pa.int32()),
                 pa.array(p[found])], ["start", "end", "score"])
            ends = np.searchsorted(row, np.arange(len(text) + 1)).astype(np.int32)
            return [pa.array(score), pa.array((score >= threshold).astype(np.int32), pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), spans)]
        return work

    return map_texts(docs, text_col, "score double, predicted int, "
                     "offending array<struct<start:int,end:int,score:double>>", make, keep, step_bytes=8 << 20)
