"""Benchmark decontamination by Wu-Manber search for many word patterns.

Words are maximal runs of ASCII letters and digits (A-Z lower-cased) and of
characters beyond ASCII. Every run of ``window`` consecutive words of a
benchmark item is a pattern; an item of fewer words, but not none, is one
pattern. Patterns of one length share a shift table over blocks of two words: it
says how far the search may move on when it sees a block, so most positions are
never looked at. Where the shift is 0, the hash bucket of the pattern's last
block (with its first block as the prefix filter) selects patterns, and a
direct comparison of all words confirms an occurrence. Texts are searched by
many cursors at once, each over its own stretch of a text.

Benchmark items are taken in blocks of a bounded number of bytes, spread by a
hash of the item's id; each block's words are broadcast and searched in all
documents in turn, and the spans found add up. The number of blocks follows the
benchmark's size.

Null text has no words. Items with null id are ignored; items that share an id
count once. Repeated documents are searched one by one; an empty benchmark hits
nothing. Input columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, strings_between, text_bytes

WINDOW = 10
#: Bytes of benchmark text in one broadcast block (about; an item stays whole).
BLOCK_BYTES = 16 << 20
#: Positions that one cursor searches.
STRETCH = 512

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words in order, first word of each text and the end)."""
    data, ends = text_bytes(text)
    n = len(data)
    word = _WORD[data]
    cut = np.zeros(n + 1, dtype=bool)
    if n:
        cut[1:n] = word[1:] != word[:-1]
    cut[ends] = True
    cut[n] = True
    cuts = np.flatnonzero(cut)
    if len(cuts) < 2:
        return pa.array([], pa.binary()), np.zeros(len(ends), np.int64)
    runs = strings_between(_LOWER[data], cuts)
    is_word = word[cuts[:-1]]
    before = np.r_[0, np.cumsum(is_word)]
    return runs.filter(pa.array(is_word)), before[np.searchsorted(cuts, ends)]


@dataclass
class _Length:
    """Search tables for the patterns of one length."""
    patterns: np.ndarray   # distinct, one row of word numbers each
    shift: np.ndarray      # by block hash
    order: np.ndarray      # patterns by bucket
    buckets: np.ndarray    # bucket of each, sorted
    first_item: np.ndarray  # items of pattern k: items[first_item[k]:first_item[k + 1]]
    items: np.ndarray


class PatternTables:
    """Word numbers and the search tables of a block of benchmark items."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int):
        words, first = split_words(texts)
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        numbers = coded.indices.to_numpy().astype(np.int64) + 1
        self.ids = ids
        self.base = len(self.words) + 1
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
            size = min(b - a, window)
            if size > 0:
                rows = np.lib.stride_tricks.sliding_window_view(numbers[a:b], size)
                by_length.setdefault(int(size), []).append((rows, np.full(len(rows), k)))
        self.lengths = {size: self._tables(size, np.concatenate([r for r, _ in found]),
                                           np.concatenate([k for _, k in found]))
                        for size, found in by_length.items()}

    def block(self, left, right, size: int):
        """Key of a block; one word alone where patterns have one word."""
        return right if size == 1 else left * self.base + right

    def bucket(self, first, last) -> np.ndarray:
        return last * np.int64(1_000_003) ^ first

    def _tables(self, size: int, rows: np.ndarray, item: np.ndarray) -> _Length:
        patterns, at = np.unique(rows, axis=0, return_inverse=True)
        at = at.reshape(-1)
        pairs = np.unique(np.stack([at, item], 1), axis=0)
        first_item = np.searchsorted(pairs[:, 0], np.arange(len(patterns) + 1))
        width = min(size, 2)
        slots = 1 << max(12, int(len(patterns) * size * 4).bit_length())
        shift = np.full(slots, size - width + 1, dtype=np.int32)
        for end in range(width - 1, size):
            key = self.block(patterns[:, max(end - 1, 0)], patterns[:, end], size)
            np.minimum.at(shift, self.slot(key, slots), size - 1 - end)
        bucket = self.bucket(self.block(patterns[:, 0], patterns[:, width - 1], size),
                             self.block(patterns[:, size - width], patterns[:, size - 1], size))
        order = np.argsort(bucket, kind="stable")
        return _Length(patterns, shift, order, bucket[order], first_item, pairs[:, 1])

    @staticmethod
    def slot(key, slots: int):
        return ((key * np.int64(0x9E3779B97F4A7C1 | 1)) >> np.int64(20)) & np.int64(slots - 1)

    def search(self, numbers: np.ndarray, first: np.ndarray, size: int):
        """(start word, pattern) of every occurrence inside one text."""
        t = self.lengths[size]
        starts = np.maximum(np.diff(first) - size + 1, 0)
        stretches = -(-starts // STRETCH)
        text = np.repeat(np.arange(len(starts)), stretches)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        at = first[text] + nth * STRETCH + size - 1          # last word under the window
        stop = np.minimum(at + STRETCH, first[text + 1])
        found = []
        slots = len(t.shift)
        while len(at):
            step = t.shift[self.slot(self.block(numbers[at - 1], numbers[at], size), slots)]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        start = np.concatenate(found) - size + 1 if found else np.zeros(0, np.int64)
        width = min(size, 2)
        bucket = self.bucket(self.block(numbers[start], numbers[start + width - 1], size),
                             self.block(numbers[start + size - width], numbers[start + size - 1], size))
        low = np.searchsorted(t.buckets, bucket, side="left")
        many = np.searchsorted(t.buckets, bucket, side="right") - low
        picked = np.repeat(np.arange(len(start)), many)
        pattern = t.order[np.repeat(low, many) + np.arange(len(picked))
                          - np.repeat(np.cumsum(many) - many, many)]
        start = start[picked]
        same = np.ones(len(start), dtype=bool)
        for k in range(size):
            same &= numbers[start + k] == t.patterns[pattern, k]
        return start[same], pattern[same]

    def find(self, words: pa.Array, first: np.ndarray):
        """(start, length, text, item) arrays; spans and (text, item) pairs."""
        numbers = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64) + 1
        spans, pairs = [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
        for size, t in self.lengths.items():
            start, pattern = self.search(numbers, first, size)
            if not len(start):
                continue
            spans.append(np.stack([start, start + size], 1))
            text = np.searchsorted(first, start, side="right") - 1
            seen = np.unique(np.stack([text, pattern], 1), axis=0)
            many = t.first_item[seen[:, 1] + 1] - t.first_item[seen[:, 1]]
            at = np.repeat(t.first_item[seen[:, 1]], many) + np.arange(many.sum()) \
                - np.repeat(np.cumsum(many) - many, many)
            pairs.append(np.stack([np.repeat(seen[:, 0], many), t.items[at]], 1))
        return np.concatenate(spans), np.unique(np.concatenate(pairs), axis=0)


def _list_column(rows: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """List array of n rows: value k belongs to row rows[k] (sorted)."""
    ends = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


_BUILT: list = []


def _built(tables, window: int) -> PatternTables:
    """The block's search tables, built once per worker process."""
    for key, size, patterns in _BUILT:
        if key is tables.value and size == window:
            return patterns
    ids, texts = tables.value
    patterns = PatternTables(ids, pa.array(texts, pa.string()), window)
    _BUILT[:] = [*_BUILT[-1:], (tables.value, window, patterns)]
    return patterns


def _search_block(docs: DataFrame, tables, text_col: str, window: int, keep: list[str]) -> DataFrame:
    """``keep`` and n_words, spans (merged word intervals) and items of one block."""

    def make():
        patterns = _built(tables, window)

        def work(text):
            words, first = split_words(text)
            n = len(text)
            spans, pairs = patterns.find(words, first)
            size = len(words) + 1
            change = np.bincount(spans[:, 0], minlength=size) - np.bincount(spans[:, 1], minlength=size)
            hit = np.r_[False, np.cumsum(change[:-1]) > 0, False]
            # a hit stretch ends where its text does
            edge = np.diff(hit.astype(np.int8))
            opens, closes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            cut = first[1:-1][hit[first[1:-1]] & hit[first[1:-1] + 1]]
            opens = np.unique(np.r_[opens, cut])
            closes = np.unique(np.r_[closes, cut])
            rows = np.searchsorted(first, opens, side="right") - 1
            made = pa.StructArray.from_arrays(
                [pa.array(opens - first[rows], pa.int32()), pa.array(closes - first[rows], pa.int32())],
                ["start", "end"])
            names = pa.array(patterns.ids, pa.string()).take(pa.array(pairs[:, 1]))
            return [pa.array(np.diff(first), pa.int64()), _list_column(rows, made, n),
                    _list_column(pairs[:, 0], names, n)]
        return work

    return map_texts(docs, text_col, "n_words long, spans array<struct<start:int,end:int>>, items array<string>",
                     make, keep)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``n_hit`` (words inside
    an occurrence), ``n_items``, ``items`` (ids as text, sorted), ``items_sha256``
    (of the ids joined by commas), ``spans`` (hit word intervals) and
    ``contaminated``."""
    outputs = ("n_words", "n_hit", "n_items", "items", "items_sha256", "spans", "contaminated")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outputs]
    spark = docs.sparkSession
    bench = (benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text"))
             .dropna())
    total = bench.agg(F.sum(F.octet_length("text") + F.octet_length("id"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    found = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("__wm_text"))
    for k in range(blocks):
        # bounded: the items of one block, about block_bytes
        rows = bench.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()
        tables = spark.sparkContext.broadcast(([r["id"] for r in rows], [r["text"] for r in rows]))
        last = k == blocks - 1
        own = kept + ([] if last else ["__wm_text"]) + (["__wm_spans", "__wm_items"] if k else [])
        found = _search_block(found, tables, "__wm_text", window, own)
        if k:
            found = (found.withColumn("spans", F.concat("__wm_spans", "spans"))
                     .withColumn("items", F.concat("__wm_items", "items")).drop("__wm_spans", "__wm_items"))
        if not last:
            found = found.withColumnsRenamed({"spans": "__wm_spans", "items": "__wm_items"}).drop("n_words")
    if blocks > 1:
        merged = F.aggregate(
            F.array_sort("spans"), F.array().cast("array<struct<start:int,end:int>>"),
            lambda acc, x: F.when(
                (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > x["start"]),
                F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                    F.element_at(acc, -1)["start"].alias("start"),
                    F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
            .otherwise(F.concat(acc, F.array(x))))
        found = found.withColumn("spans", F.when(F.size("spans") > 0, merged).otherwise(F.col("spans")))
    found = found.withColumn("items", F.array_sort(F.array_distinct("items")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return found.select(
        *[F.col(f"`{c}`") for c in kept], "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "spans",
        (F.size("spans") > 0).alias("contaminated"))
