"""Token counts of byte-level BPE by rank-synchronous merging of numpy arrays.

Texts are cut into pre-tokens with array operations over their UTF-8 bytes; the
distinct pre-tokens of a batch are held as one ragged array of symbol ids. In
each round every sequence finds its own lowest-rank pair and all occurrences of
that pair are merged at once (left to right where they overlap), until no
sequence has a mergeable pair; the surviving symbols are the tokens. A merge
never makes a pair of lower rank than its own, so this gives the same symbols as
merging one pair at a time.

The tokenizer file (``tokenizers`` JSON, byte-level BPE) is a path that exists on
every worker. Strings of its special tokens inside a text count as one token
each, as is the library's default.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted one by
one; input columns named like an output are replaced.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts, strings_between, text_bytes

LETTER, NUMBER, SPACE, OTHER, SPECIAL = 0, 1, 2, 3, 4
NO_RANK = np.int32(2**31 - 1)

# White space of the split pattern (\s).
SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: letter (\\p{L}), number (\\p{N}), space, other."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    table[list(SPACES)] = SPACE
    return table


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte's character."""
    cls = _classes()[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int64)
        size = np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4))
        code = np.where(size == 2, first & 0x1F, np.where(size == 3, first & 0x0F, first & 0x07))
        for k in (1, 2, 3):
            more = size > k
            code[more] = (code[more] << 6) | (data[lead[more] + k] & 0x3F)
        found = _classes()[code]
        for k in range(4):
            more = size > k
            cls[lead[more] + k] = found[more]
    return cls


def pretoken_cuts(data: np.ndarray, ends: np.ndarray, special: list[bytes]) -> np.ndarray:
    """Byte positions where pre-tokens begin, and the end of the data.

    ``ends``: text offsets (n + 1). The pre-tokens are those of the pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
    applied to each text, with special strings cut out first.
    """
    n = len(data)
    if n == 0:
        return np.zeros(1, np.int64)
    cls = byte_classes(data)
    hard = np.zeros(n + 1, dtype=bool)
    hard[ends] = True
    raw = None
    for mark in special:
        raw = raw or data.tobytes()
        at = raw.find(mark)
        while at >= 0:
            stop = at + len(mark)
            if not hard[at + 1:stop].any():
                hard[at] = hard[stop] = True
                cls[at:stop] = SPECIAL
                at = raw.find(mark, stop)
            else:
                at = raw.find(mark, at + 1)
    cut = hard.copy()
    cut[1:n] |= cls[1:] != cls[:-1]
    # white space before something else: its last character stands alone, and a
    # blank goes with what follows
    after = np.flatnonzero(cut[1:n] & ~hard[1:n] & (cls[:-1] == SPACE) & (cls[1:] != SPACE)) + 1
    blank = data[after - 1] == 0x20
    cut[after[blank] - 1] = True
    cut[after[blank]] = False
    last = after[~blank] - 1
    while len(last):
        inside = (data[last] & 0xC0) == 0x80
        cut[last[~inside]] = True
        last = last[inside] - 1
    # contractions: an apostrophe that begins a pre-token, before a letter
    quote = np.flatnonzero((data[:-1] == 0x27) & cut[:n - 1] & ~hard[1:n] & (cls[1:] == LETTER))
    if len(quote):
        one = data[quote + 1]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        two = data[np.minimum(quote + 2, n - 1)]
        pair = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) \
            | ((one == ord("l")) & (two == ord("l")))
        long = ~short & pair & (quote + 2 < n) & ~hard[np.minimum(quote + 2, n)]
        for found, size in ((quote[short], 2), (quote[long], 3)):
            cut[found + 1] = False
            cut[found + size] = True
    return np.flatnonzero(cut)


class MergeTable:
    """Ranks and results of symbol pairs, by a sorted array of pair keys."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = [t["content"].encode() for t in spec["added_tokens"] if t["special"]]
        self.size = max(vocab.values()) + 1
        # printable bytes stand for themselves, the others for 256, 257, ...
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        names = {b: chr(b) if b in set(plain) else chr(next(other)) for b in range(256)}
        self.byte_id = np.array([vocab[names[b]] for b in range(256)], dtype=np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each piece of ``data`` between consecutive offsets."""
        size = np.diff(offsets)
        out = (size > 0).astype(np.int64)
        live = np.flatnonzero(size > 1)
        if not len(live):
            return out
        if len(live) < len(size):
            data = data[np.repeat(size > 1, size)]
        symbols = self.byte_id[data]
        owner = np.repeat(live, size[live])
        ranks = np.full(len(symbols), NO_RANK, dtype=np.int32)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            length = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NO_RANK
            if done.any():
                out[owner[starts[done]]] = length[done]
                keep = np.repeat(~done, length)
                symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
                if not len(symbols):
                    break
                lowest, length = lowest[~done], length[~done]
            hit = np.flatnonzero(ranks == np.repeat(lowest, length))
            # of neighbouring occurrences (a a a) take every second one
            new = np.r_[True, np.diff(hit) > 1]
            if not new.all():
                first = np.flatnonzero(new)
                place = np.arange(len(hit)) - np.repeat(first, np.diff(np.r_[first, len(hit)]))
                hit = hit[place % 2 == 0]
            symbols[hit] = self.made[ranks[hit]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))
            symbols, owner = symbols[keep], owner[keep]
            # the pair to the right of a merge begins where the merged right part was
            ranks = ranks[keep]
            for place in (at, at[at > 0] - 1):
                pair = place[place + 1 < len(symbols)]
                joined = owner[pair] == owner[pair + 1]
                ranks[place] = NO_RANK
                pair = pair[joined]
                ranks[pair] = self.rank(symbols[pair], symbols[pair + 1])
        return out


@functools.lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def count_batch(table: MergeTable, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, tokens) of each text."""
    data, ends = text_bytes(text)
    cuts = pretoken_cuts(data, ends, table.special)
    pieces = strings_between(data, cuts).dictionary_encode()
    unique, offsets = text_bytes_of_binary(pieces.dictionary)
    counts = table.count(unique, offsets)
    for mark in table.special:
        at = np.flatnonzero(np.asarray(pieces.dictionary) == mark) if len(pieces.dictionary) else []
        counts[at] = 1
    total = np.r_[0, np.cumsum(counts[pieces.indices.to_numpy()])]
    at = np.searchsorted(cuts, ends)
    return np.diff(ends), np.diff(total[at])


def text_bytes_of_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], (off - off[0]).astype(np.int64)


def token_counts(docs: DataFrame, tokenizer_path: str, text_col: str = "text", limit: int = 1024,
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit)."""

    def make():
        table = merge_table(tokenizer_path)

        def work(text):
            n_bytes, n_tokens = count_batch(table, text)
            return [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                    pa.array(n_tokens > limit)]
        return work

    return map_texts(docs, text_col, "n_bytes long, n_tokens long, over_limit boolean", make, keep,
                     step_bytes=12 << 20)
