"""URL filters: a range join of pages with host-and-path rules by a sorted sweep.

A host's labels in reverse order, each ended by ``\\x01``, form its key, so a
rule for a host and all its subdomains is the interval of keys that start with
the host's key; the intervals of two rules are nested or disjoint. The distinct
hosts of the pages and the ends of the intervals are sorted together by range
partitions. An interval's opening event carries the stack of rules active from
there on (its own and those of the hosts it is nested in), its closing event the
stack without its own; a host's active rules are the stack of the last event
before it, found by a window inside each range and a carry from the ranges
before. The longest active rule whose path starts the URL's path decides.

Hosts are made distinct before the sweep, so a host with a third of all pages is
one row there; the join back to the pages is a plain equi-join on the host.
Only column functions are used. Rule length is the characters of host and path;
of equally long rules the one with the longer host wins, then block.

URLs that are null or have no ``://`` have an empty host and path. Rules with a
null host, path or verdict are ignored; repeated rules count once; an empty rule
table gives every URL the default verdict. Input columns named like an output
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, write_table

#: Sorts after every character that can follow a host's key.
AFTER = "\U0010FFFF"

OUTPUTS = ("host", "path", "rule", "verdict")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host between the first ``://`` and the next ``/``, ``?`` or
    ``#``, lower-cased A-Z; path from there to the next ``?`` or ``#``."""
    has = url.contains("://")
    rest = F.when(has, F.substr(url, F.instr(url, "://") + F.lit(3)))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return (F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit("")))


def host_key(host: Column) -> Column:
    """Labels in reverse order, each followed by ``\\x01``; empty host: empty."""
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, "\1"), F.lit("\1")))


def _ancestors(host: Column) -> Column:
    """The host and its parent domains, and the empty host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    own = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.array_distinct(F.concat(own, F.array(F.lit(""))))


def rule_events(rules: DataFrame) -> DataFrame:
    """(key, kind, stack) for the two ends of each rule host's interval."""
    rules = (rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict")
             .dropna().distinct())
    entry = F.struct(
        (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
        (F.col("verdict") == "block").cast("int").alias("block"),
        F.concat("host", "path").alias("rule"), F.col("path").alias("path"),
        F.col("verdict").alias("verdict"))
    by_host = rules.groupBy("host").agg(F.collect_list(entry).alias("own"))
    nested = (by_host.select(F.col("host").alias("inner"), F.explode(_ancestors(F.col("host"))).alias("host"))
              .join(by_host, "host")
              .groupBy("inner").agg(F.collect_list(F.struct("host", "own")).alias("stack")))
    flat = lambda c: F.flatten(F.transform(c, lambda x: x["own"]))
    start = host_key(F.col("inner"))
    opened = nested.select(start.alias("key"), F.lit(0).alias("kind"), flat(F.col("stack")).alias("stack"))
    closed = nested.select(
        F.concat(start, F.lit(AFTER)).alias("key"), F.lit(0).alias("kind"),
        flat(F.filter("stack", lambda x: x["host"] != F.col("inner"))).alias("stack"))
    return opened.unionByName(closed)


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, stack): each distinct host with the rules whose interval holds it."""
    events = rule_events(rules)
    points = hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"),
                          F.lit(None).cast(events.schema["stack"].dataType).alias("stack"), "host")
    n = int(hosts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = (events.withColumn("host", F.lit(None).cast("string")).unionByName(points)
            .repartitionByRange(n, "key", "kind")
            .withColumn("bucket", F.spark_partition_id()))
    line = write_table(line, "url-sweep")
    # the last event of each range, carried to the ranges after it (a row per range)
    ends = (line.where("kind = 0").groupBy("bucket")
            .agg(F.max_by("stack", "key").alias("stack")))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = (line.select("bucket").distinct().join(ends, "bucket", "left")
             .select("bucket", F.last("stack", ignorenulls=True).over(before).alias("carry")))
    sweep = (Window.partitionBy("bucket").orderBy("key", "kind")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (line.withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
            .where("kind = 1").join(carry, "bucket", "left")
            .select("host", F.coalesce("active", "carry").alias("stack"))
            .where(F.size("stack") > 0))


def url_rules(pages: DataFrame, rules: DataFrame, url_col: str = "url",
              default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the deciding
    rule, else null) and ``verdict`` (the rule's, else ``default``).

    ``rules``: columns host, path, verdict ('allow' or 'block')."""
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in OUTPUTS]
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(*kept, host.alias("host"), path.alias("path"))
    active = active_rules(parsed.select("host").distinct(), rules)
    active = active.withColumnRenamed("host", "__u_host").withColumnRenamed("stack", "__u_stack")
    joined = parsed.join(active, F.col("host") == F.col("__u_host"), "left")
    fits = F.filter("__u_stack", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(fits)
    return joined.select(
        *kept, "host", "path", best["rule"].alias("rule"),
        F.coalesce(best["verdict"], F.lit(default)).alias("verdict"))
