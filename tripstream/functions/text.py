"""Mail text helpers (F10–F12) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop words removed before term counting (the list repeats "to").
STOP_WORDS = (
    "the", "i", "a", "an", "at", "are", "am", "for", "and", "or", "is",
    "there", "it", "this", "that", "on", "was", "by", "of", "to", "in",
    "to", "message", "not", "be", "with", "you", "have", "as", "can",
)

# Token separators: space, tab, newline, carriage return, form feed.
TOKEN_SEPARATORS = r"[ \t\n\r\f]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(time) -> Column:
    """First seven characters (yyyy-MM) of the mail time."""
    return F.substring(_col(time), 1, 7)


def address_of(sender) -> Column:
    """Text after the last '<' without its last character."""
    tail = F.substring_index(_col(sender), "<", -1)
    return F.substring(tail, F.lit(1), F.length(tail) - 1)


def tokens(text, stop_words=STOP_WORDS) -> Column:
    """Whitespace tokens, lower-cased, kept when entirely ASCII letters and not a
    stop word (F12). Whole text, no prefix."""
    stops = F.array(*[F.lit(w) for w in sorted(set(stop_words))])
    parts = F.split(F.lower(_col(text)), TOKEN_SEPARATORS)
    return F.filter(parts, lambda w: w.rlike("^[a-z]+$") & ~F.array_contains(stops, w))


def is_word(word, stop_words=STOP_WORDS) -> Column:
    """Row-level form of the token test (codegen-friendly after an explode)."""
    w = _col(word)
    return w.rlike("^[a-z]+$") & ~w.isin(*sorted(set(stop_words)))


def raw_tokens(text) -> Column:
    """Lower-cased whitespace split of the whole text (before the word test)."""
    return F.split(F.lower(_col(text)), TOKEN_SEPARATORS)
