"""Substring deduplication by hashed runs of consecutive sentences.

Sentences end after ``.``, ``!`` or ``?`` before white space and after a newline.
From every sentence the shortest run of consecutive sentences with at least
``min_words`` words is hashed, and the shortest one that ends with it; a run has
at least two sentences, or one of at least ``lone_words`` words. Sentences are
compared with A-Z lower-cased and white space collapsed. The run hashes of all
documents are joined; of equal runs the first, in order of (id, text hash,
sentence), stays, and every sentence that any other one covers is removed.

Counts and firsts are pre-aggregated before the shuffle and the join back is a
plain equi-join, so a run shared by a third of all documents is no burden to one
task beyond its own rows.

Null text stays null and empty stays empty, nothing removed. Rows equal in id
and text are one document and are cut alike (the first run stays in both).
Ids may be null or repeated: a document is known by its id and its text's hash.
Input columns named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, map_texts, release_memory, small_batches, text_bytes

#: Bytes of text of one step of a task.
STEP = 4 << 20
MIN_WORDS = 20
LONE_WORDS = 25

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True
# odd multiplier of the rolling hash and its inverse modulo 2^64
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


class Sentences:
    """Byte cuts of the sentences of a batch, their words and first sentences."""

    def __init__(self, text: pa.Array):
        self.data, self.ends = text_bytes(text)
        data, n = self.data, len(self.data)
        space = _SPACE[data]
        begin = np.zeros(n + 1, dtype=bool)        # a word begins here
        if n:
            begin[:n] = ~space
            begin[1:n] &= space[:-1]
            inner = self.ends[(self.ends > 0) & (self.ends < n)]
            begin[inner] = ~space[inner]
        cut = np.zeros(n + 1, dtype=bool)
        if n:
            cut[1:n] = (_STOP[data[:-1]] & space[1:]) | (data[:-1] == 0x0A)
        cut[self.ends] = True
        cuts = np.flatnonzero(cut)
        total = np.r_[0, np.cumsum(begin[:n])]
        # pieces without a word go with the sentence before them in the same text
        words = np.diff(total[cuts]) if len(cuts) > 1 else np.zeros(0, np.int64)
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.ends] = True
        keep = np.r_[(words > 0) | edge[cuts[:-1]], True] if len(cuts) > 1 else np.ones(len(cuts), bool)
        self.cuts = cuts[keep]
        self.words = np.diff(total[self.cuts])
        self.first = np.searchsorted(self.cuts, self.ends)

    def hashes(self) -> np.ndarray:
        raw = self.data.tobytes().lower()
        at = self.cuts.tolist()
        return np.array([xxhash.xxh64_intdigest(b" ".join(raw[a:b].split())) for a, b in zip(at, at[1:])],
                        dtype=np.uint64)

    def runs(self, min_words: int, lone_words: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) sentences of the shortest runs from and up to each
        sentence, distinct, inside one text."""
        n = len(self.words)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        total = np.r_[0, np.cumsum(self.words)]
        text = np.searchsorted(self.first, np.arange(n), side="right") - 1
        low, high = self.first[text], self.first[text + 1]
        i = np.arange(n)
        alone = self.words >= lone_words
        end = np.searchsorted(total, total[:-1] + min_words, side="left")
        end = np.where(alone, i + 1, np.maximum(end, i + 2))
        start = np.searchsorted(total, total[1:] - min_words, side="right") - 1
        start = np.where(alone, i, np.minimum(start, i - 1))
        ok, back = end <= high, start >= low
        pairs = np.unique(np.r_[i[ok] * (n + 1) + end[ok], start[back] * (n + 1) + i[back] + 1])
        return pairs // (n + 1), pairs % (n + 1)


def run_hashes(sentence: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of sentence hashes, wherever it stands."""
    n = len(sentence)
    back = np.cumprod(np.r_[np.uint64(1), np.full(n, _BACK, dtype=np.uint64)])
    forth = np.cumprod(np.r_[np.uint64(1), np.full(n, _STEP, dtype=np.uint64)])
    total = np.r_[np.uint64(0), np.cumsum(sentence * back[:n])]
    value = (total[end] - total[start]) * forth[start] + (end - start).astype(np.uint64)
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (value ^ (value >> np.uint64(29))).view(np.int64)


def sentence_runs(docs: DataFrame, id_col: str, text_col: str, min_words: int, lone_words: int) -> DataFrame:
    """(id, text hash, run, start, end): every hashed run of every document."""
    def make():
        def work(text):
            s = Sentences(text)
            start, end = s.runs(min_words, lone_words)
            value = run_hashes(s.hashes(), start, end)
            row = np.searchsorted(s.first, start, side="right") - 1
            own = s.first[row]
            runs = pa.StructArray.from_arrays(
                [pa.array(value), pa.array((start - own).astype(np.int32)), pa.array((end - own).astype(np.int32))],
                ["run", "start", "end"])
            ends = np.searchsorted(row, np.arange(len(text) + 1)).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), runs)]
        return work
    source = docs.select(F.col(id_col).alias("__s_id"), F.xxhash64(text_col).alias("__s_hash"),
                         F.col(text_col).alias("__s_text"))
    found = map_texts(source, "__s_text", "runs array<struct<run:long,start:int,end:int>>", make,
                      ["__s_id", "__s_hash"], STEP)
    return found.select("__s_id", "__s_hash", F.inline("runs"))


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          min_words: int = MIN_WORDS, lone_words: int = LONE_WORDS) -> DataFrame:
    """``docs`` with the text cut, and ``n_sentences``, ``n_removed`` (sentences)
    and ``removed_words``."""
    runs = sentence_runs(docs, id_col, text_col, min_words, lone_words)
    place = F.struct("__s_id", "__s_hash", "start")
    first = (runs.groupBy("run").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("run", "first"))
    later = (runs.join(first, "run")
             .where(~(F.col("__s_id").eqNullSafe(F.col("first.__s_id"))
                      & (F.col("__s_hash") == F.col("first.__s_hash")) & (F.col("start") == F.col("first.start"))))
             .groupBy("__s_id", "__s_hash").agg(F.collect_set(F.struct("start", "end")).alias("__s_later")))
    outputs = ("n_sentences", "n_removed", "removed_words")
    kept = [c for c in docs.columns if c.lower() not in outputs]
    whole = docs.select(*[F.col(f"`{c}`") for c in kept], F.xxhash64(text_col).alias("__s_own"))
    later = later.withColumnsRenamed({"__s_id": "__s_key", "__s_hash": "__s_value"})
    joined = (whole.join(later, whole[id_col].eqNullSafe(later["__s_key"])
                         & (F.col("__s_own") == F.col("__s_value")), "left")
              .select(*[F.col(f"`{c}`") for c in kept], "__s_later"))
    at = next(k for k, c in enumerate(kept) if c == text_col)
    schema = T.StructType([joined.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in outputs])

    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in small_batches(batches, text_col, STEP):
            texts = batch.column(at)
            s = Sentences(texts)
            later, raw = batch.column(len(kept)).to_pylist(), s.data.tobytes()
            cuts, out, counts = s.cuts.tolist(), [], [[], [], []]
            for k, text in enumerate(texts.to_pylist()):
                a, b = int(s.first[k]), int(s.first[k + 1])
                gone = np.zeros(b - a + 1, dtype=np.int64)
                for span in later[k] or ():
                    gone[span["start"]] += 1
                    gone[span["end"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                if gone.any():
                    text = b"".join(raw[cuts[a + j]:cuts[a + j + 1]] for j in np.flatnonzero(~gone)).decode().strip()
                out.append(text)
                full = s.words[a:b] > 0
                for column, value in zip(counts, (full.sum(), (gone & full).sum(), s.words[a:b][gone].sum())):
                    column.append(int(value))
            columns = [pa.array(out, texts.type) if k == at else batch.column(k) for k in range(len(kept))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(c, pa.int64()) for c in counts],
                                             names=[*kept, *outputs])
            release_memory()

    return joined.mapInArrow(run, schema)
