"""Periodic runs of words by Baier's grouping.

A run is a stretch of consecutive words whose smallest period q fits at least
``MIN_PERIODS`` times, of ``MIN_WORDS`` words or more, and that no neighbouring
word extends with that period.

``lyndon_array`` is phase one of Baier's suffix sorter: groups of positions are
taken from the highest to the lowest, and every position hands its group's word
to the nearest position on its left that is still in a lower group, which moves
to a new group right above its own. A group's word at its turn is the longest
Lyndon word that starts at its members, so the Lyndon array comes out directly,
without the suffix order. Every run has a Lyndon root that is the longest Lyndon
word at its place under the word order or under its reverse. Each position's
word under either order is such a candidate; it is extended to both sides by the
longest common extension (binary search over prefix hashes) and becomes a run if
the whole is long enough. Hashes only propose: a run's words are compared with
those one period on, and where they differ the extension is done word by word.

Only stretches in which every ``GRAM`` words in a row occur twice in the text
are grouped. Inside a run of ``MIN_WORDS`` words every such group recurs one
period away, so no run lies outside them; hashes of equal groups are equal, so
none is missed by them either.

A text is one row's work, in linear space and about n log n time; a text of many
million words takes a task as many times ten microseconds if it is periodic
throughout. Null and empty texts and those shorter than ``MIN_WORDS`` have no
runs. Repeated rows are treated one by one, an empty table gives an empty one,
and input columns named like an output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

MIN_WORDS = 24
MIN_PERIODS = 3
GRAM = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)


def lyndon_array(rank: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position; ``rank``: the order's
    numbers of the symbols, from 0 without gaps."""
    n = len(rank)
    high = max(rank, default=-1)
    found = [0] * n
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    group = list(rank)
    members: list[dict[int, None]] = [{} for _ in range(high + 1)]
    for i, g in enumerate(group):
        members[g][i] = None
    size = [1] * (high + 1)
    below, above = list(range(-1, high)), list(range(1, high + 2))
    g = high
    while g >= 0:
        length, times = size[g], {}
        for i in members[g]:                   # ascending
            found[i] = length
            lower, after = left[i], right[i]
            if after < n:
                left[after] = lower
            if lower >= 0:
                right[lower] = after
                times[lower] = times.get(lower, 0) + 1
        above[below[g]] = g
        if times:
            moved: dict[tuple[int, int], list[int]] = {}
            for i, k in times.items():
                moved.setdefault((group[i], k), []).append(i)
            top = {}                           # the highest new group above an old one
            for old, k in sorted(moved):
                which = moved[old, k]
                if old not in top and len(which) == len(members[old]):
                    size[old] += k * length    # all of it moves: the group keeps its place
                    top[old] = old
                    continue
                new, under = len(size), top.get(old, old)
                size.append(size[old] + k * length)
                members.append(dict.fromkeys(which))
                rest = members[old]
                for i in which:
                    del rest[i]
                    group[i] = new
                over = above[under]
                below.append(under)
                above.append(over)
                above[under] = new
                below[over] = new
                top[old] = new
        members[g] = {}
        g = below[g]
    return found


def _extent(x: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` that keeps ``period``, word by word."""
    differ = np.flatnonzero(x[:-period] != x[period:])
    k = int(np.searchsorted(differ, at))
    start = int(differ[k - 1]) + 1 if k else 0
    stop = int(differ[k]) if k < len(differ) else len(x) - period
    return start, max(stop, start) + period


class _Extensions:
    """Longest common extensions of pairs of positions a < b, from prefix hashes."""

    def __init__(self, x: np.ndarray):
        self.n = len(x)
        self.power = np.full(self.n + 1, _BASE)
        self.power[0] = 1
        self.power = np.cumprod(self.power, dtype=np.uint64)
        mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(31)
        self.sums = np.zeros(self.n + 1, np.uint64)
        self.sums[1:] = np.cumsum(mixed * self.power[:-1], dtype=np.uint64)

    def same(self, a, b, m) -> np.ndarray:
        """The ``m`` symbols from ``a`` and from ``b`` have one hash."""
        return (self.sums[a + m] - self.sums[a]) * self.power[b - a] == self.sums[b + m] - self.sums[b]

    def _longest(self, most: np.ndarray, fits) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while np.any(low < high):
            mid = (low + high + 1) // 2
            ok = fits(mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def forward(self, a, b) -> np.ndarray:
        return self._longest(self.n - b, lambda m: self.same(a, b, m))

    def backward(self, a, b) -> np.ndarray:
        return self._longest(a.copy(), lambda m: self.same(a - m, b - m, m))


def runs_of(x: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the symbols ``x``, by start and period."""
    n = len(x)
    if n < max(min_words, 2):
        return []
    x = np.unique(x, return_inverse=True)[1]
    ext, high = _Extensions(x), int(x.max())
    runs = set()
    for rank in (x, high - x):
        period = np.array(lyndon_array(rank.tolist()))
        at = np.flatnonzero(period * min_periods <= n)
        at = at[at + period[at] <= n]
        q = period[at]
        if min_periods >= 3:                   # a run's first root occurs twice in a row
            keep = at + 2 * q <= n
            keep[keep] = ext.same(at[keep], (at + q)[keep], q[keep])
            at, q = at[keep], q[keep]
        first = at < q
        first[~first] = ~ext.same(at[~first] - q[~first], at[~first], q[~first])
        at, q = at[first], q[first]
        start = at - ext.backward(at, at + q)
        stop = at + q + ext.forward(at, at + q)
        long = (stop - start >= min_words) & (stop - start >= min_periods * q)
        for i, s, e, p in zip(at[long].tolist(), start[long].tolist(), stop[long].tolist(), q[long].tolist()):
            if not np.array_equal(x[s:e - p], x[s + p:e]):
                s, e = _extent(x, i, p)
                if e - s < max(min_words, min_periods * p):
                    continue
            runs.add((s, e - s, p))
    return sorted((s, m, p) for s, m, p in runs)


def _stretches(words: list[list[bytes]], min_words: int):
    """(text, first word, end) of the stretches that can hold a run, each with a
    word more on both sides: what neighbours the run is there."""
    ends = np.cumsum([len(w) for w in words])
    total = int(ends[-1]) if len(ends) else 0
    if total < min_words:
        return
    begins = np.r_[0, ends[:-1]]
    text = np.repeat(np.arange(len(words)), np.diff(np.r_[0, ends]))
    code = np.empty(total, np.uint64)
    for k, w in enumerate(words):
        if w:
            code[begins[k]:ends[k]] = np.fromiter(map(hash, w), np.int64, len(w)).view(np.uint64)
    gram = np.zeros(total - GRAM + 1, np.uint64)
    for j in range(GRAM):
        gram *= _BASE
        gram += code[j:total - GRAM + 1 + j]
    del code
    place = np.flatnonzero(ends[text[:len(gram)]] - np.arange(len(gram)) >= GRAM)
    gram = gram[place] + text[place].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(gram)
    same = gram[order]
    same = same[1:] == same[:-1]
    twice = np.zeros(total + 1, dtype=bool)
    twice[place[order[1:][same]]] = True
    twice[place[order[:-1][same]]] = True
    del gram, order, same
    at = np.flatnonzero(twice)
    if not len(at):
        return
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])]
    first = at[new]
    last = at[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a + GRAM >= min_words:
            k = int(text[a])
            base = int(begins[k])
            yield k, max(a - 1, base) - base, min(b + GRAM + 1, int(ends[k])) - base


def text_runs(texts: list[bytes], min_words: int = MIN_WORDS,
              min_periods: int = MIN_PERIODS) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """(words, runs) of each text."""
    words = [t.split() for t in texts]         # ASCII white space
    runs: list[set] = [set() for _ in texts]
    for k, a, b in _stretches(words, min_words):
        numbers: dict[bytes, int] = {}
        x = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words[k][a:b]), np.int64, b - a)
        runs[k].update((a + s, m, p) for s, m, p in runs_of(x, min_words, min_periods))
    return [(w, sorted(r)) for w, r in zip(words, runs)]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without what a run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int32)
    for s, m, p in runs:
        gone[s + p] += 1
        gone[s + m] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period in words, by
    start and period) and ``collapsed`` (the words that no run repeats, joined by
    one space)."""
    def make():
        def work(text):
            found = text_runs(text.cast(pa.binary()).fill_null(b"").to_pylist())
            ends = np.r_[0, np.cumsum([len(r) for _, r in found])].astype(np.int32)
            flat = np.array([run for _, r in found for run in r], dtype=np.int64).reshape(-1, 3)
            spans = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            return [pa.array([len(w) for w, _ in found], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), spans),
                    pa.array([b" ".join(collapse(w, r)) for w, r in found], pa.binary()).cast(pa.string())]
        return work

    return map_texts(docs, text_col, "n_words long, runs array<struct<start:long,length:long,period:long>>, "
                     "collapsed string", make, keep, step_bytes=4 << 20)
