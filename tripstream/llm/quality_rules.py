"""Quality rules: a table of thresholds compiled into one Spark projection.

Counts per text (words are runs of characters other than ASCII white space):

* ``n_words``, ``word_chars`` (code points in words),
* ``n_symbols`` (characters of ``[#*$%&|<>]``),
* ``n_dup_lines`` (lines with a word that equal an earlier line),
* ``n_repeat_words`` (words inside a three-word window that occurs twice or more),
* ``n_stop_words`` (words that are a stop word when lower-cased),
* ``n_lines`` (lines with a word).

Every rule is a row (name, metric, minimum, maximum) over a ratio of these
counts; a rule whose ratio is undefined (no words, no lines) holds. Only column
functions are used. Repeated windows are found by sorting (hash, position) pairs
of a text's windows, so the cost is n log n in the text's length; windows are
compared by a 64-bit hash within one text.

Null text counts as empty: all counts 0, and it fails the base rules. Repeated
rows are judged one by one. Input columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of the four corpus languages.
STOP_WORDS = (
    "the of and to in a is that for it with as was be by on not this are or from at which but an "
    "der die und den von zu das mit sich ist im dem nicht ein eine auf für er es des "
    "de la le et les en un une du que est pour qui dans sur pas au elle avec "
    "el y los las por con para se del al como su lo o no"
).split()


@dataclass(frozen=True)
class Threshold:
    """A row of the rule table: minimum <= metric <= maximum, ends included."""
    name: str
    metric: str
    minimum: float | None = None
    maximum: float | None = None


#: The base rules come first; a document is kept if it breaks no rule at all.
BASE = (
    Threshold("too_few_words", "n_words", minimum=50),
    Threshold("repeated_windows", "repeat_percent", maximum=50),
)
METHOD = (
    Threshold("mean_word_length", "mean_word_chars", minimum=2.5, maximum=12),
    Threshold("symbol_ratio", "symbols_per_word", maximum=0.1),
    Threshold("duplicate_lines", "dup_line_ratio", maximum=0.35),
    Threshold("stop_words", "stop_word_ratio", minimum=0.06),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_stop_words", "n_lines")


def _ratio(top: str, bottom: str, scale: float = 1.0) -> Column:
    return F.when(F.col(bottom) > 0, F.col(top) * F.lit(scale) / F.col(bottom))


def _metric(name: str) -> Column:
    return {
        "n_words": lambda: F.col("n_words"),
        "repeat_percent": lambda: _ratio("n_repeat_words", "n_words", 100.0),
        "mean_word_chars": lambda: _ratio("word_chars", "n_words"),
        "symbols_per_word": lambda: _ratio("n_symbols", "n_words"),
        "dup_line_ratio": lambda: _ratio("n_dup_lines", "n_lines"),
        "stop_word_ratio": lambda: _ratio("n_stop_words", "n_words"),
    }[name]()


def _breaks(rule: Threshold) -> Column:
    value, out = _metric(rule.metric), F.lit(False)
    if rule.minimum is not None:
        out = out | (value < F.lit(rule.minimum))
    if rule.maximum is not None:
        out = out | (value > F.lit(rule.maximum))
    return F.coalesce(out, F.lit(False))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once: as a lambda's variable it
    stays so where a filter is pushed below the projection that made it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def quality_counts(docs: DataFrame, text_col: str = "text", stop_words=STOP_WORDS) -> DataFrame:
    """Add the seven counts (long) to ``docs``."""
    clash = {c.lower() for c in COUNTS}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in clash]
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.select(
        *kept,
        F.array_remove(F.split(text, SPACE), "").alias("__q_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__q_lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    windows = _let(F.col("__q_words"), lambda w: F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))))
    # a window occurs twice or more if its neighbour in hash order has the same hash
    twice = _let(F.sort_array(windows), lambda s: F.filter(
        s, lambda x, i: (F.get(s, i + 1)["h"] == x["h"]) | (F.get(s, i - 1)["h"] == x["h"])))
    starts = F.sort_array(F.transform(twice, lambda x: x["p"]))
    # windows cover [p, p + 3); in order of p, each adds what the last did not cover
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + 3 - F.greatest(acc["end"] - p, F.lit(0))).alias("n"),
                                (p + 3).alias("end")),
        lambda acc: acc["n"])
    stop = F.filter("__q_words", lambda w: F.lower(w).isin(list(stop_words)))
    return step.select(
        *kept,
        F.size("__q_words").cast("long").alias("n_words"),
        F.length(F.array_join("__q_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(stop).cast("long").alias("n_stop_words"),
        F.size("__q_lines").cast("long").alias("n_lines"))


def quality_rules(docs: DataFrame, text_col: str = "text", base=BASE, method=METHOD,
                  stop_words=STOP_WORDS) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``kept`` and ``failed_rules``
    (names of the broken rules in table order)."""
    counted = quality_counts(docs, text_col, stop_words)
    flags = ("base_failed", "kept", "failed_rules")
    kept = [F.col(f"`{c}`") for c in counted.columns if c.lower() not in flags]
    names = F.array(*[F.when(_breaks(r), F.lit(r.name)) for r in (*base, *method)])
    any_of = lambda rules: F.coalesce(*[F.when(_breaks(r), F.lit(True)) for r in rules], F.lit(False))
    return counted.select(
        *kept, any_of(base).alias("base_failed"),
        (~any_of((*base, *method))).alias("kept"),
        F.array_compact(names).alias("failed_rules"))
