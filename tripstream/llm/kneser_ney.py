"""Language-model scores: an interpolated modified Kneser-Ney bigram model.

Tokens of a text are its words (runs of characters other than ASCII white space,
A-Z lower-cased) and one end; the first is predicted from a start mark. With
c(a b) the count of a pair, the model is

    P(b | a) = (c(a b) - D(c(a b))) / c(a .) + gamma(a) P(b)
    P(b)     = (t(b) - D'(t(b))) / T + gamma' / (V + 1)

t(b) is the number of different tokens before b, T their sum, V the number of
different tokens; the discounts D, for counts 1, 2 and 3 or more, come from the
counts of counts, and gamma gives the discounted mass to the lower order, down
to a uniform share for unknown words.

Counting runs in Spark. Each batch of texts sends its distinct pairs, dictionary
coded and compressed, to the shard of the pair's first word; a first word with a
large share of all tokens is spread over several shards by the second one. A
shard merges its pairs, writes them as a sorted array of pair hashes with counts
into the shared folder, and passes on what it knows of each word; a second
shuffle merges that into sorted arrays of word hashes. Nothing of the corpus'
size passes through the driver. Scoring maps the arrays into memory and looks up
a batch's distinct pairs shard by shard; on storage that cannot be mapped a
worker reads one shard at a time.

Words and pairs are known by 64-bit hashes. Null and empty texts are an end
alone. A null id counts as not held out. Without training texts every token has
probability 1. Repeated rows count and are scored as often as they come; input
columns named like an output are replaced.
"""

from __future__ import annotations

import io
import os
import uuid
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, shared_path, strings_between, text_bytes, write_table

STEP = 12 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
# no word has white space, so these are not hashes of words
START, END = (np.uint64(xxhash.xxh64_intdigest(m)) for m in (b" start", b" end"))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(31))) * _A + b
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(29))


def _range(x: np.ndarray, parts) -> np.ndarray:
    """Which of equally wide ranges of the 64-bit numbers each one is in."""
    return ((x >> np.uint64(32)) * np.asarray(parts, dtype=np.uint64) >> np.uint64(32)).astype(np.int64)


# ---------------------------------------------------------------- tokens

class Tokens:
    """Distinct words of a batch (hashes) and every text's tokens by number;
    ``end`` and ``start`` are the last two numbers."""

    def __init__(self, text: pa.Array):
        data, ends = text_bytes(text)
        n = len(data)
        space = _SPACE[data]
        cut = np.zeros(n + 1, dtype=bool)
        if n:
            cut[1:n] = space[1:] != space[:-1]
        cut[ends] = cut[n] = True
        cuts = np.flatnonzero(cut)
        if n:
            word = ~space[cuts[:-1]]
            coded = strings_between(_LOWER[data], cuts).filter(pa.array(word)).dictionary_encode()
            before = np.r_[0, np.cumsum(word)][np.searchsorted(cuts, ends)]
            number = coded.indices.to_numpy()
            hashes = [xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()]
        else:
            before, number, hashes = np.zeros(len(ends), np.int64), np.zeros(0, np.int32), []
        self.hashes = np.array([*hashes, int(END), int(START)], dtype=np.uint64)
        end, start = len(hashes), len(hashes) + 1
        self.first = before + np.arange(len(ends))         # one end per text
        self.token = np.full(self.first[-1], end, dtype=np.int32)
        own = np.repeat(np.arange(len(ends) - 1), np.diff(before))
        self.token[np.arange(len(number)) + own] = number
        self.previous = np.r_[np.int32(start), self.token[:-1]] if len(self.token) else self.token
        self.previous[self.first[:-1]] = start


# ---------------------------------------------------------------- packing

def _planes(x: np.ndarray) -> bytes:
    """Bytes of an unsigned array, all first bytes, then all second bytes, ..."""
    top = int(x.max()) if len(x) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    x = np.ascontiguousarray(x.astype(kind))
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T
    return np.int64([len(x), x.itemsize]).tobytes() + np.ascontiguousarray(planes).tobytes()


def _unplane(raw: memoryview, at: int) -> tuple[np.ndarray, int]:
    n, size = np.frombuffer(raw, np.int64, 2, at)
    planes = np.frombuffer(raw, np.uint8, n * size, at + 16).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.uint64), at + 16 + int(n * size)


def pack(*columns: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(_planes(c) for c in columns), 1)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw, at, out = memoryview(zstandard.decompress(blob)), 0, []
    while at < len(raw):
        column, at = _unplane(raw, at)
        out.append(column)
    return out


def _gaps(x: np.ndarray) -> np.ndarray:
    """Differences of a sorted array, the first value in front."""
    return np.r_[x[:1], x[1:] - x[:-1]]


def pack_pairs(a: np.ndarray, b: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs in order of (a, b): lengths of the runs of a, numbers of b."""
    starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    other, number = np.unique(b, return_inverse=True)
    return pack(_gaps(a[starts]), np.diff(np.r_[starts, len(a)]), _gaps(other), number, count)


def unpack_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first, length, other, number, count = unpack(blob)
    return (np.repeat(np.cumsum(first, dtype=np.uint64), length.astype(np.int64)),
            np.cumsum(other, dtype=np.uint64)[number.astype(np.int64)], count)


def _summed(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order and the sums of the values of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    if not len(key):
        return [key, *values]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return [key[starts], *(np.add.reduceat(v[order], starts) for v in values)]


# ---------------------------------------------------------------- storage

def _local(path: str) -> str | None:
    """The path in the mounted file system, or None for other storage."""
    parsed = urlparse(path)
    return parsed.path if parsed.scheme in ("", "file") else None


def save_arrays(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Write arrays under their final names in one step each, so that a task
    that is run again leaves the same files."""
    local = _local(folder)
    for key, array in arrays.items():
        if local is not None:
            os.makedirs(local, exist_ok=True)
            made = os.path.join(local, f".{name}.{key}.{uuid.uuid4().hex}")
            with open(made, "wb") as f:
                np.save(f, array)
            os.replace(made, os.path.join(local, f"{name}.{key}.npy"))
        else:
            from pyarrow import fs
            store, base = fs.FileSystem.from_uri(folder)
            store.create_dir(base)
            buffer = io.BytesIO()
            np.save(buffer, array)
            with store.open_output_stream(f"{base}/{name}.{key}.npy") as f:
                f.write(buffer.getvalue())


def load_array(folder: str, name: str, key: str) -> np.ndarray | None:
    """The array, memory-mapped where the storage allows it; None if not there."""
    local = _local(folder)
    if local is not None:
        path = os.path.join(local, f"{name}.{key}.npy")
        return np.load(path, mmap_mode="r") if os.path.exists(path) else None
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(folder)
    path = f"{base}/{name}.{key}.npy"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with store.open_input_file(path) as f:
        return np.load(io.BytesIO(f.read()))


# ---------------------------------------------------------------- counting

@dataclass(frozen=True)
class Shards:
    """Which shard a pair is in: by its first word, a busy one's also by the
    second. ``busy``: sorted hashes, ``spread``: their numbers of shards."""
    count: int
    busy: np.ndarray
    spread: np.ndarray

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = _range(a, self.count)
        if len(self.busy):
            at = np.minimum(np.searchsorted(self.busy, a), len(self.busy) - 1)
            hit = np.flatnonzero(self.busy[at] == a)
            more = _range(pair_hash(a[hit], b[hit]), self.spread[at[hit]])
            out[hit] = (out[hit] + more) % self.count
        return out


def _busy_words(train: DataFrame, text_col: str, shards: int) -> Shards:
    """The words that may have more than one in ``2 * shards`` tokens: counted
    only in batches where they have one in ``4 * shards``, which leaves out less
    than that share of any word. At most ``4 * shards`` words."""
    def make():
        def work(text):
            t = Tokens(text)
            count = np.bincount(t.token, minlength=len(t.hashes))
            many = np.flatnonzero(count * 4 * shards >= max(len(t.token), 1))
            rows = [[] for _ in range(len(text))]
            if rows:
                rows[0] = [{"w": int(w.view(np.int64)), "n": int(n)} for w, n in zip(t.hashes[many], count[many])]
                rows[0].append({"w": None, "n": len(t.token)})
            return [pa.array(rows, pa.list_(pa.struct([("w", pa.int64()), ("n", pa.int64())])))]
        return work
    seen = (map_texts(train, text_col, "seen array<struct<w:long,n:long>>", make, [], STEP)
            .select(F.inline("seen")).groupBy("w").agg(F.sum("n").alias("n")))
    seen = write_table(seen, "lm-busy")
    total = (seen.where("w IS NULL").first() or {"n": 0})["n"]
    rows = seen.where(f"w IS NOT NULL AND n * {4 * shards} >= {total}").collect()
    found = sorted((int(np.int64(r["w"]).view(np.uint64)), r["n"]) for r in rows)
    spread = [min(shards, -(-2 * shards * n // max(total, 1))) for _, n in found]
    return Shards(shards, np.array([w for w, _ in found], np.uint64), np.array(spread, np.uint64))


def _count_pairs(train: DataFrame, text_col: str, shards: Shards) -> DataFrame:
    """(shard, pairs): the distinct pairs of each batch, packed by shard."""
    def make():
        def work(text):
            t = Tokens(text)
            many = np.int64(len(t.hashes))
            pair, count = np.unique(t.previous * many + t.token, return_counts=True)
            a, b = t.hashes[pair // many], t.hashes[pair % many]
            shard = shards.of(a, b)
            order = np.lexsort((b, a, shard))
            a, b, count, shard = a[order], b[order], count[order], shard[order]
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(a) else [0]
            rows = [[] for _ in range(len(text))]
            rows[0] = [{"shard": int(shard[x]), "pairs": pack_pairs(a[x:y], b[x:y], count[x:y])}
                       for x, y in zip(cuts, cuts[1:])]
            return [pa.array(rows, pa.list_(pa.struct([("shard", pa.int32()), ("pairs", pa.binary())])))]
        return work
    return (map_texts(train, text_col, "packed array<struct<shard:int,pairs:binary>>", make, [], STEP)
            .select(F.inline("packed")))


def _merge_pairs(packed: DataFrame, folder: str, shards: int) -> DataFrame:
    """Write each shard's array; (part, words, c1..c4): what it knows of the
    words in each range of hashes, and its counts of counts (part -1)."""
    def merge(key, pdf):
        import pandas as pd
        a, b, count = (np.concatenate(x) for x in zip(*(unpack_pairs(p) for p in pdf["pairs"])))
        order = np.lexsort((b, a))
        a, b, count = a[order], b[order], count[order]
        starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        a, b, count = a[starts], b[starts], np.add.reduceat(count, starts)
        value = pair_hash(a, b)
        order = np.argsort(value)
        kind = np.uint32 if count.max() < 2**32 else np.uint64
        save_arrays(folder, f"pairs-{key[0]}", keys=value[order], counts=count[order].astype(kind))
        runs = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        sums = [np.add.reduceat(x.astype(np.uint64), runs) for x in (count, count == 1, count == 2, count >= 3)]
        context = [a[runs], *sums]
        word = _summed(b, np.ones(len(b), np.uint64), count)
        rows = []
        ends = [np.searchsorted(_range(x[0], shards), np.arange(shards + 1)) for x in (word, context)]
        for part in range(shards):
            cut = [[x[c] for x in group] for group, c in
                   zip((word, context), (slice(e[part], e[part + 1]) for e in ends))]
            if len(cut[0][0]) or len(cut[1][0]):
                rows.append((part, pack(*(c for g in cut for c in (_gaps(g[0]), *g[1:]))), 0, 0, 0, 0))
        rows.append((-1, None, *(int((count == k).sum()) for k in (1, 2, 3, 4))))
        return pd.DataFrame(rows, columns=["part", "words", "c1", "c2", "c3", "c4"])
    return packed.groupBy("shard").applyInPandas(
        merge, "part int, words binary, c1 long, c2 long, c3 long, c4 long")


def _merge_words(known: DataFrame, folder: str) -> DataFrame:
    """Write the word arrays of each range; (tokens, types, words, c1..c4) of it."""
    def merge(key, pdf):
        import pandas as pd
        parts = [unpack(p) for p in pdf["words"]]
        word = _summed(*(np.concatenate(x) for x in zip(*((np.cumsum(p[0], dtype=np.uint64), *p[1:3]) for p in parts))))
        context = _summed(*(np.concatenate(x) for x in zip(*((np.cumsum(p[3], dtype=np.uint64), *p[4:]) for p in parts))))
        save_arrays(folder, f"words-{key[0]}", keys=word[0], types=word[1], counts=word[2])
        save_arrays(folder, f"contexts-{key[0]}", keys=context[0], counts=np.stack(context[1:], 1))
        return pd.DataFrame([(int(word[2].sum()), int(word[1].sum()), len(word[0]),
                              *(int((word[1] == k).sum()) for k in (1, 2, 3, 4)), int((word[1] >= 3).sum()))],
                            columns=["tokens", "types", "words", "c1", "c2", "c3", "c4", "c3up"])
    return known.groupBy("part").applyInPandas(
        merge, "tokens long, types long, words long, c1 long, c2 long, c3 long, c4 long, c3up long")


def discounts(c1: int, c2: int, c3: int, c4: int) -> tuple[float, float, float]:
    """Discounts for counts 1, 2 and 3 or more from the counts of counts; where
    these are too few, three quarters of the count's largest discount of 1."""
    y = c1 / (c1 + 2 * c2) if c1 and c2 else None
    out = []
    for k, (low, high) in enumerate(((c1, c2), (c2, c3), (c3, c4)), 1):
        d = k - (k + 1) * y * high / low if y is not None and low else 0.75
        out.append(float(min(max(d, 0.05), k - 0.05)))
    return out[0], out[1], out[2]


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the model's few numbers."""
    folder: str
    shards: Shards
    tokens: int
    types: int
    words: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    leftover: float


def train_model(docs: DataFrame, learn: Column, text_col: str = "text", shards: int | None = None) -> Model:
    """Count the texts for which ``learn`` holds. ``shards``: default the
    session's shuffle partitions."""
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    train = docs.where(learn).select(text_col)
    folder = shared_path(spark, "lm-model")
    busy = _busy_words(train, text_col, n)
    known = write_table(_merge_pairs(_count_pairs(train, text_col, busy), folder, n), "lm-words")
    of_pairs = known.where("part < 0").agg(*(F.sum(f"c{k}") for k in (1, 2, 3, 4))).first()
    total = write_table(_merge_words(known.where("part >= 0").select("part", "words"), folder), "lm-totals") \
        .groupBy().sum().first()
    if total is None or total[0] is None:
        return Model(folder, busy, 0, 0, 0, (0.75,) * 3, (0.75,) * 3, 1.0)
    tokens, types, words, c1, c2, c3, c4, c3up = total
    d = discounts(c1, c2, c3, c4)
    return Model(folder, busy, tokens, types, words, discounts(*of_pairs), d,
                 (d[0] * c1 + d[1] * c2 + d[2] * c3up) / types)


# ---------------------------------------------------------------- scoring

class Scorer:
    """Looks up words and pairs in the model's arrays."""

    def __init__(self, model: Model):
        self.model = model

    def _find(self, kind: str, shard: np.ndarray, keys: np.ndarray, columns: dict[str, np.ndarray]) -> None:
        """Fill ``columns`` (zeros) with the values of the keys that are there."""
        order = np.lexsort((keys, shard))
        cuts = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True]) if len(order) else []
        for x, y in zip(cuts, cuts[1:]):
            own = order[x:y]
            name = f"{kind}-{shard[own[0]]}"
            there = load_array(self.model.folder, name, "keys")
            if there is None or not len(there):
                continue
            at = np.minimum(np.searchsorted(there, keys[own]), len(there) - 1)
            hit = there[at] == keys[own]
            for column, out in columns.items():
                out[own[hit]] = load_array(self.model.folder, name, column)[at[hit]]

    def words(self, hashes: np.ndarray):
        """(counts, P(b), c(a .), gamma(a)) of each word."""
        m, n = self.model, len(hashes)
        part = _range(hashes, m.shards.count)
        count, types = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        context = np.zeros((n, 4), np.uint64)
        if m.words:
            self._find("words", part, hashes, {"counts": count, "types": types})
            self._find("contexts", part, hashes, {"counts": context})
        t = types.astype(np.float64)
        d = np.select([types == 0, types == 1, types == 2], [0.0, *m.word_discounts[:2]], m.word_discounts[2])
        lower = (t - d) / max(m.types, 1) + m.leftover / (m.words + 1)
        total = context[:, 0].astype(np.float64)
        mass = context[:, 1:].astype(np.float64) @ np.array(m.pair_discounts)
        gamma = np.where(total > 0, mass / np.maximum(total, 1), 1.0)
        return count, lower, total, gamma

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Counts of pairs."""
        found = np.zeros(len(a), np.uint64)
        if self.model.words:
            self._find("pairs", self.model.shards.of(a, b), pair_hash(a, b), {"counts": found})
        return found

    def score(self, text: pa.Array):
        """(tokens, known tokens, base score, score) of each text."""
        m, t = self.model, Tokens(text)
        count, lower, total, gamma = self.words(t.hashes)
        many = np.int64(len(t.hashes))
        pair, at = np.unique(t.previous * many + t.token, return_inverse=True)
        a, b = pair // many, pair % many
        c = self.pairs(t.hashes[a], t.hashes[b])
        d = np.select([c == 0, c == 1, c == 2], [0.0, *m.pair_discounts[:2]], m.pair_discounts[2])
        p = np.log10((c - d) / np.maximum(total[a], 1) + gamma[a] * lower[b])
        base = np.log10((count.astype(np.float64) + 1) / (m.tokens + m.words + 1))
        known = (count > 0)[t.token]
        starts = t.first[:-1]
        return (np.diff(t.first), np.add.reduceat(known.astype(np.int64), starts),
                np.add.reduceat(base[t.token], starts), np.add.reduceat(p[at], starts))


def score_documents(docs: DataFrame, model: Model, text_col: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    (log10, add-one unigrams), ``score`` (log10, the model) and ``perplexity``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)

        def work(text):
            n, known, base, score = scorer.score(text)
            return [pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(np.full(len(n), scorer.model.tokens), pa.int64()),
                    pa.array(base), pa.array(score), pa.array(10.0 ** np.minimum(-score / n, 300))]
        return work

    return map_texts(docs, text_col, "n_tokens long, n_known long, train_tokens long, base_score double, "
                     "score double, perplexity double", make, keep, STEP)
