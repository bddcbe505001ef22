"""Time helpers (F8, F13, F15) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_diff_ms(a, b) -> Column:
    """Milliseconds from ``a`` to ``b`` (F8)."""
    return F.unix_millis(_col(b)) - F.unix_millis(_col(a))


def travel_minutes(start, end) -> Column:
    """(end - start) / 60000.0."""
    return time_diff_ms(start, end) / 60000.0


def parse_ride_time(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC (session time zone must be UTC)."""
    return F.to_timestamp(_col(c), "yyyy-MM-dd HH:mm:ss")


def format_ride_time(c) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")


def parse_iso_zoned(c) -> Column:
    """ISO-8601 timestamps with a zone offset, e.g. 2017-01-01T10:00:00.000+01:00."""
    return F.to_timestamp(_col(c))


def parse_mbox_date(c) -> Column:
    """``EEE MMM d HH:mm:ss yyyy`` → ``yyyy-MM-dd-HH:mm:ss``.

    Spark's datetime patterns cannot parse a weekday name, so the leading
    weekday is stripped before parsing (F13)."""
    body = F.regexp_replace(F.trim(_col(c)), r"^[A-Za-z]{3}\s+", "")
    body = F.regexp_replace(body, r"\s+", " ")
    ts = F.to_timestamp(body, "MMM d HH:mm:ss yyyy")
    return F.date_format(ts, "yyyy-MM-dd-HH:mm:ss")
