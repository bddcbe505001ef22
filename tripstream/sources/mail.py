"""Mail archive sources and sinks.

A mail record file separates records with ``##//##`` and fields with ``#|#``.
``ingest_mbox`` turns raw mbox archives into such records as one Spark job:
the text source splits the archive on the ``From <prefix>`` separator, and
headers/body are extracted with array and string expressions per mail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import parse_mbox_date
from ..operators.mail import distinct_mails
from ..schemas import MAIL_FIELDS

# Record and field delimiters of the mail record format.
RECORD_DELIM = "##//##"
FIELD_DELIM = "#|#"


def read_mails(spark: SparkSession, path: str, fields=None) -> DataFrame:
    """Mail records, projected to ``fields`` (names from MAIL_FIELDS)."""
    return parse_mail_records(spark.read.option("lineSep", RECORD_DELIM).text(path), fields)


def parse_mail_records(raw: DataFrame, fields=None) -> DataFrame:
    """Record texts (column ``value``) → ``fields``; blank records are skipped."""
    fields = list(fields or MAIL_FIELDS)
    parts = F.split(F.col("value"), r"#\|#")
    rec = raw.filter(F.length(F.regexp_replace("value", r"^\s+$", "")) > 0).select(parts.alias("p"))
    return rec.select(*[F.element_at("p", MAIL_FIELDS.index(f) + 1).alias(f) for f in fields])


def mail_records(mails: DataFrame) -> DataFrame:
    """Mails as record texts (column ``value``)."""
    return mails.select(F.concat_ws(FIELD_DELIM, *[F.col(c) for c in MAIL_FIELDS]).alias("value"))


def write_mails(mails: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Records re-joined with the two delimiters."""
    (mail_records(mails)
     .write.mode(mode).option("lineSep", RECORD_DELIM).text(path))


def _has_delim(c):
    return c.contains(FIELD_DELIM) | c.contains(RECORD_DELIM)


def parse_mbox_mails(chunks: DataFrame, prefix: str) -> DataFrame:
    """Mail texts (one per row, column ``value``, starting at the ``From <prefix>``
    line) → mail records; mails with a missing field or a delimiter inside a
    field are dropped."""
    start = f"From {prefix}"
    text = F.regexp_replace("value", r"\n+$", "")          # trailing blank lines do not count
    lines = F.split(text, "\n")
    blank = F.array_position(F.transform(lines, lambda l: F.trim(l) == ""), True)
    m = chunks.select(lines.alias("lines"), blank.alias("b")).filter(F.col("b") > 0)
    b = F.greatest(F.col("b"), F.lit(1))      # guards the slice bounds; b > 0 is filtered
    header = F.slice("lines", 1, b - 1)
    body_lines = F.slice("lines", b, F.size("lines") - b + 1)

    def header_values(tag):
        n = len(tag)
        return F.transform(F.filter(header, lambda l: F.lower(l).startswith(tag)),
                           lambda l: F.substring(l, n + 1, 1 << 30))

    def last(arr):
        return F.try_element_at(arr, F.lit(-1))

    firsts = F.filter(header, lambda l: l.startswith(start))
    m = m.select(
        header.alias("h"), firsts.alias("firsts"),
        header_values("subject: ").alias("subjects"), header_values("from: ").alias("froms"),
        header_values("message-id: ").alias("ids"), header_values("in-reply-to: ").alias("replies"),
        F.array_join(F.transform(body_lines, lambda l: F.when(
            l.endswith("="), F.substring(l, 1, F.length(l) - 1)).otherwise(F.concat(l, F.lit("\n")))),
            "").alias("body"))
    bad = (F.exists("firsts", lambda l: F.length(l) < 24)
           | F.exists(F.concat("subjects", "froms", "ids", "replies"), _has_delim)
           | _has_delim(F.col("body")))
    out = m.filter(~bad).select(
        last("ids").alias("messageId"),
        parse_mbox_date(F.substring(last("firsts"), -24, 24)).alias("time"),
        last("froms").alias("sender"), last("subjects").alias("subject"), "body",
        F.coalesce(last("replies"), F.lit("null")).alias("replyTo"))
    return out.filter(F.col("messageId").isNotNull() & F.col("time").isNotNull()
                      & F.col("sender").isNotNull() & F.col("subject").isNotNull())


def ingest_mbox(spark: SparkSession, path: str, list_prefix: str = "dev-return") -> DataFrame:
    """Mbox archive(s) → distinct mail records (one per messageId)."""
    start = f"From {list_prefix}"
    raw = spark.read.option("lineSep", start).option("wholetext", "false").text(path)
    chunks = raw.filter(F.length(F.trim("value")) > 0).select(
        F.concat(F.lit(start), F.col("value")).alias("value"))
    return distinct_mails(parse_mbox_mails(chunks, list_prefix))
