"""Quality classifier: kernel ridge on document statistics.

``statistics`` reduces a whole text to ``STATS``: lengths, shares of character
kinds, of repeated words, pairs and lines, and for the worst line the shares of
signs, capitals, digits and repeats. They are standardised with the training
rows' means and deviations, clipped, and mapped to ``FEATURES`` random Fourier
features, sqrt(2/D) cos(w x + b) with normal w, which approximate a Gaussian
kernel of width ``WIDTH`` times the root of their number; a constant is added.

The ridge scores need only Z'Z and Z'y. Every task sums them over its rows, by
fold (``FOLDS``, by a hash of the id), and the sums are added up in the cluster
in blocks of ``BLOCK`` rows of the matrix, so no row of features is stored and
the driver gets one matrix per fold, however many rows are labelled: all of them
are learnt from. The sums without a fold give the weights that score that fold's
rows; the penalty is the one of ``PENALTIES`` with the least squared error over
the folds, which the sums give too.

Isotonic calibration turns the scores of the left-out folds into rates of label
1: rows and labels are counted per step of ``GRID`` of the score in Spark, and
neighbouring steps that fall are pooled. Between pooled blocks the rate is
interpolated, so scores stay in order. The weights that score documents are
those of all folds.

Null and empty texts have statistics of 0 and are scored as such. Labels that
contradict each other for an id count as 0, null labels and ids are not learnt
from; repeated rows of an id are learnt as often as they are there. Without both
labels every score is the share of label 1 (0.5 without labels). Input columns
named like an output are replaced; an empty table gives an empty one. Texts are
taken in steps of some megabytes, a longer text in a step of its own, in space
of about 30 times its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, remove_table, store_table, strings_between, text_bytes

FEATURES = 256
WIDTH = 0.7
CLIP = 4.0
FOLDS = 5
BLOCK = 32
PENALTIES = (1e-5, 1e-4, 1e-3, 1e-2, 1e-1)
#: Steps of a score of one for the calibration.
GRID = 1000
SEED = 1

#: Character kinds as bytes; those of other scripts count as letters.
KINDS = {
    "letter": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)], "capital": [*range(0x41, 0x5B)],
    "digit": [*range(0x30, 0x3A)], "sign": list(b"#*$%&|<>@_~^=+/\\{}[]"), "bar": list(b"|"), "shout": list(b"!?"),
    "stop": list(b"."), "comma": list(b",;:"), "space": [0x20, *range(0x09, 0x0E)],
    "character": [*range(0x80), *range(0xC0, 0x100)]}
_TABLES = {name: np.isin(np.arange(256), codes) for name, codes in KINDS.items()}
_SHARES = ("letter", "capital", "digit", "sign", "bar", "shout", "stop", "comma", "space")
_WORST = ("capital", "digit", "sign", "bar", "shout")
STATS = (*[f"{k}_share" for k in _SHARES], *[f"worst_{k}" for k in _WORST], "characters", "words", "word_length", "word_spread",
         "short_words", "long_words", "distinct_words", "most_frequent", "repeats", "worst_repeats", "distinct_pairs", "lines",
         "line_length", "double_lines")


def _parts(top, below):
    """top / below, 0 where there is nothing."""
    return np.divide(top, below, out=np.zeros(len(below)), where=below > 0)


def _distinct(group: np.ndarray, value: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different values of each group, and rows of its most frequent."""
    most = np.zeros(groups)
    if not len(group):
        return np.zeros(groups), most
    many = int(value.max()) + 1
    if groups * many >= 1 << 62:
        value = np.unique(value, return_inverse=True)[1]
        many = int(value.max()) + 1
    key = np.sort(group * many + value)
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    times, of = np.diff(np.r_[new, len(key)]), key[new] // many
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    most[of[first]] = np.maximum.reduceat(times, first)
    return np.bincount(of, minlength=groups).astype(float), most


def statistics(text: pa.Array) -> np.ndarray:
    """``STATS`` of each text, one row each."""
    data, ends = text_bytes(text)
    n, size = len(ends) - 1, len(data)
    if not size:
        return np.zeros((n, len(STATS)))
    first = np.zeros(size + 1, dtype=bool)
    first[ends] = True
    # lines: a text has one more than line feeds
    feeds = np.flatnonzero(data == 0x0A)
    begins = np.sort(np.concatenate([ends[:-1], feeds + 1]), kind="stable")
    feed_text = np.searchsorted(ends, feeds, side="right") - 1
    lines = 1 + np.bincount(feed_text, minlength=n)
    line_first = np.r_[0, np.cumsum(lines)]
    line_text = np.repeat(np.arange(n), lines)
    # the texts' first lines stand before the lines that begin at the same byte
    begins = np.empty(line_first[-1], np.int64)
    begins[line_first[:-1]] = ends[:-1]
    inner = np.ones(len(begins), dtype=bool)
    inner[line_first[:-1]] = False
    begins[inner] = feeds + 1
    stops = np.r_[begins[1:], size]
    stops[line_first[1:] - 1] = ends[1:]
    per_text, per_line = {}, {}
    for name, table in _TABLES.items():
        sums = np.zeros(size + 1, np.int32)
        np.cumsum(table[data], out=sums[1:])
        per_text[name] = (sums[ends[1:]] - sums[ends[:-1]]).astype(float)
        if name in _WORST or name == "character":
            per_line[name] = (sums[stops] - sums[begins]).astype(float)
        if name == "character":
            at_character = sums
    space = _TABLES["space"][data]
    word = np.zeros(size + 2, dtype=bool)
    word[1:-1] = ~space
    start = np.flatnonzero(word[1:-1] & (~word[:-2] | first[:-1]))
    stop = np.flatnonzero(word[1:-1] & (~word[2:] | first[1:])) + 1
    word_text = np.searchsorted(ends, start, side="right") - 1
    words = np.bincount(word_text, minlength=n).astype(float)
    length = (at_character[stop] - at_character[start]).astype(float)
    total = np.bincount(word_text, weights=length, minlength=n)
    mean = _parts(total, words)
    spread_ = np.sqrt(np.maximum(_parts(np.bincount(word_text, weights=length ** 2, minlength=n), words) - mean ** 2, 0))
    mark = np.zeros(size + 1, dtype=bool)
    mark[0] = mark[size] = mark[start] = mark[stop] = True
    cuts = np.flatnonzero(mark)
    is_word = word[cuts[:-1] + 1]
    code = strings_between(data, cuts).filter(pa.array(is_word)).dictionary_encode().indices.to_numpy().astype(np.int64)
    distinct, most = _distinct(word_text, code, n)
    together = word_text[1:] == word_text[:-1]
    again = together & (code[1:] == code[:-1])
    repeats = np.bincount(word_text[1:][again], minlength=n)
    word_line = np.searchsorted(begins, start[1:][again], side="right") - 1
    line_repeats = np.bincount(word_line, minlength=len(begins))
    line_words = np.bincount(np.searchsorted(begins, start, side="right") - 1, minlength=len(begins))
    pair = (code[1:] * (int(code.max(initial=0)) + 1) + code[:-1])[together]
    pairs, _ = _distinct(word_text[1:][together], pair, n)
    mark = np.zeros(size + 1, dtype=bool)
    mark[begins] = mark[size] = True
    line_code = strings_between(data, np.flatnonzero(mark)).dictionary_encode().indices.to_numpy().astype(np.int64)
    filled = begins < stops
    line_kinds, _ = _distinct(line_text[filled], line_code[:int(filled.sum())], n)
    worst = lambda share: np.maximum.reduceat(share, line_first[:-1])
    characters = per_text["character"]
    # a line of a few characters says little: its share counts as one of 40
    fair = np.maximum(per_line["character"], 40)
    columns = [*[_parts(per_text[k], characters) for k in _SHARES], *[worst(per_line[k] / fair) for k in _WORST],
               np.log1p(characters), np.log1p(words), mean, spread_,
               _parts(np.bincount(word_text[length <= 3], minlength=n), words),
               _parts(np.bincount(word_text[length > 12], minlength=n), words),
               _parts(np.log1p(distinct), np.log1p(words)), _parts(most, words), _parts(repeats, words),
               worst(line_repeats / np.maximum(line_words, 8)), _parts(pairs, words), np.log1p(lines), np.log1p(characters / lines),
               _parts(lines - line_kinds, lines)]
    stats = np.stack(columns, axis=1)
    stats[ends[1:] == ends[:-1]] = 0
    return stats


@dataclass
class Model:
    """Scaling, random directions, ridge weights and calibration; ``weights`` None:
    every score is ``rates[0]``."""
    mean: np.ndarray | None
    scale: np.ndarray | None
    weights: np.ndarray | None
    steps: np.ndarray
    rates: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.rates[0])
        return np.interp(fourier(stats, self.mean, self.scale) @ self.weights, self.steps, self.rates)


def directions(features: int = FEATURES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The random frequencies and phases; the same wherever they are drawn."""
    rng = np.random.RandomState(seed)
    return rng.normal(size=(len(STATS), features)) / (WIDTH * np.sqrt(len(STATS))), rng.uniform(0, 2 * np.pi, features)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of each row, and a last column of ones."""
    w, b = directions()
    x = np.clip((stats - mean) / scale, -CLIP, CLIP)
    z = np.ones((len(x), len(b) + 1))
    z[:, :-1] = np.cos(x @ w + b) * np.sqrt(2 / len(b))
    return z


def _normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Per fold the sums of [z, y]' [z, y] over ``rows`` (stats, label, fold)."""
    width = FEATURES + 2

    def sums(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                piece = batch.slice(k, 4096)
                stats = piece.column(0).flatten().to_numpy().reshape(-1, len(STATS))
                label, fold = piece.column(1).to_numpy(), piece.column(2).to_numpy()
                z = np.column_stack([fourier(stats, mean, scale), label.astype(float)])
                for f in np.unique(fold).tolist():
                    part = z[fold == f]
                    held[f] = held.get(f, 0) + part.T @ part
        for f, matrix in held.items():
            yield _blocks([(f, k, matrix[k:k + BLOCK]) for k in range(0, width, BLOCK)])

    def add(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for f, k, values in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held[f, k] = held.get((f, k), 0) + np.frombuffer(values).reshape(-1, width)
        if held:
            yield _blocks([(f, k, matrix) for (f, k), matrix in held.items()])

    schema = "fold int, at int, sums binary"
    out: dict[int, np.ndarray] = {}
    # a matrix per task that had rows; their blocks are added up by as many tasks
    added = rows.mapInArrow(sums, schema).repartition("fold", "at").mapInArrow(add, schema)
    for r in added.collect():           # FOLDS matrices of FEATURES squared
        out.setdefault(r["fold"], np.zeros((width, width)))[r["at"]:r["at"] + BLOCK] = np.frombuffer(r["sums"]).reshape(-1, width)
    return out


def _blocks(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([f for f, _, _ in rows], pa.int32()), pa.array([k for _, k, _ in rows], pa.int32()),
         pa.array([np.ascontiguousarray(m).tobytes() for _, _, m in rows], pa.binary())], names=["fold", "at", "sums"])


def ridge(sums: np.ndarray, penalty: float) -> np.ndarray:
    """Weights from [z, y]' [z, y]; the constant is not held down."""
    d = len(sums) - 1
    held = penalty * sums[d - 1, d - 1] * np.eye(d)
    held[-1, -1] = 0
    return np.linalg.lstsq(sums[:d, :d] + held, sums[:d, d], rcond=None)[0]


def _error(sums: np.ndarray, w: np.ndarray) -> float:
    """Squared error of weights over the rows of ``sums``."""
    v = np.r_[w, -1.0]
    return float(v @ sums @ v)


def isotonic(step: np.ndarray, rows: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbouring steps whose rates fall: (mean step, rate) of the blocks."""
    blocks: list[list[float]] = []
    for s, n, y in zip(step.tolist(), rows.tolist(), ones.tolist()):
        blocks.append([s * n, n, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def _constant(rate: float) -> Model:
    return Model(None, None, None, np.zeros(1), np.array([rate]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model:
    """Fit on all labelled rows for which ``learn`` (a condition on the id) holds."""
    described, at = store_table(document_statistics(docs.where(learn), text_col, keep=[id_col]), "quality-described")
    model = train_statistics(described, labels, F.lit(True), id_col, label_col)
    remove_table(docs.sparkSession, at)
    return model


def train_statistics(described: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
                     label_col: str = "quality") -> Model:
    """``train`` from documents that have ``stats``: texts do not meet the labels."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
             .groupBy("id").agg((F.min("label") > 0).cast("int").alias("label")))
    rows = described.where(learn).select(F.col(id_col).alias("id"), "stats").join(known, "id")
    spark = described.sparkSession
    rows, rows_at = store_table(
        rows.select("stats", "label", F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int").alias("fold")), "quality-rows")
    s = [F.get("stats", F.lit(k)) for k in range(len(STATS))]
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"), F.array(*map(F.avg, s)).alias("mean"),
                    F.array(*map(F.stddev_pop, s)).alias("scale")).first()
    if not seen["n"] or seen["ones"] in (0, seen["n"]):
        remove_table(spark, rows_at)
        return _constant(seen["ones"] / seen["n"] if seen["n"] else 0.5)
    mean, scale = np.array(seen["mean"]), np.array(seen["scale"])
    scale[scale < 1e-9] = 1.0
    sums = _normal_equations(rows, mean, scale)
    whole = sum(sums.values())
    left = {f: whole - m for f, m in sums.items()} if len(sums) > 1 else {f: whole for f in sums}
    errors = {p: sum(_error(sums[f], ridge(left[f], p)) for f in sums) for p in PENALTIES}
    penalty = min(errors, key=errors.get)
    out = {f: ridge(left[f], penalty) for f in sums}

    def left_out(batches):
        for batch in batches:
            stats = batch.column(0).flatten().to_numpy().reshape(-1, len(STATS))
            fold = batch.column(2).to_numpy()
            z, raw = fourier(stats, mean, scale), np.zeros(len(fold))
            for f in np.unique(fold).tolist():
                raw[fold == f] = z[fold == f] @ out[f]
            step = np.floor(np.clip(raw, -1, 2) * GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(1)], names=["step", "label"])

    steps = (rows.mapInArrow(left_out, "step int, label int").groupBy("step")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).orderBy("step").collect())   # 3 * GRID at most
    at, rates = isotonic(*(np.array([r[c] for r in steps], dtype=float) for c in ("step", "n", "ones")))
    remove_table(spark, rows_at)
    return Model(mean, scale, ridge(whole, penalty), (at + 0.5) / GRID, rates)


def document_statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``stats``, the ``STATS`` of the text."""
    def work(text):
        stats = statistics(text)
        cuts = np.arange(0, stats.size + 1, len(STATS), dtype=np.int32)
        return [pa.ListArray.from_arrays(pa.array(cuts), pa.array(stats.ravel()))]

    return map_texts(docs, text_col, "stats array<double>", lambda: work, keep, step_bytes=4 << 20)


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5,
                    keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if score >= threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # some kB

    def make():
        known = shared.value

        def work(text):
            score = np.clip(known.score(statistics(text)), 0, 1)
            return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
        return work

    return map_texts(docs, text_col, "score double, predicted int", make, keep, step_bytes=4 << 20)


def score_statistics(described: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``score_documents`` from documents that have ``stats``, which go."""
    from pyspark.sql import types as T
    kept = [c for c in described.columns if c.lower() not in ("stats", "score", "predicted")]
    shared = described.sparkSession.sparkContext.broadcast(model)
    source = described.select(*[F.col(f"`{c}`") for c in kept], F.col("stats"))
    schema = T.StructType([source.schema[c] for c in kept] + T.StructType.fromDDL("score double, predicted int").fields)

    def run(batches):
        for batch in batches:
            stats = batch.column(len(kept)).flatten().to_numpy().reshape(-1, len(STATS))
            score = np.clip(shared.value.score(stats), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(len(kept))], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*kept, "score", "predicted"])

    return source.mapInArrow(run, schema)
