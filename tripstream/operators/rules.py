"""Two-step rule matching over keyed items (B5), batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import keyed_scan


def rule_rows(items: DataFrame, rules: DataFrame) -> DataFrame:
    """Items (seq, shape, color) with each rule (rule, first, second) that names their shape."""
    named = rules.withColumn("shape", F.explode(F.array_distinct(F.array("first", "second"))))
    return items.select("seq", "shape", "color").join(named, "shape").select("seq", "shape", "color", "rule", "first", "second")


def scan_rules(rows: DataFrame, order: list[str], bucket=None) -> DataFrame:
    """``rule_rows`` with ``_next``, the seq of the next item of the rule's second shape."""
    return keyed_scan(rows, ["rule", "color"], order, bucket,
                      {"_next": ("last", F.when(F.col("shape") == F.col("second"), F.col("seq")))},
                      inclusive=False, reverse=True)


def match_rules(items: DataFrame, rules, seq_bucket: int | None = None) -> DataFrame:
    """Per color, an item of the rule's first shape waits for the next item of
    its second shape, which matches all waiting items (rules named Rule_n).

    items: (seq, shape, color); rules: list of (first, second) shapes or a table
    (rule, first, second), of any length. An item meets only the rules that name
    its shape (an equi-join on the shape), and all rules run in one scan keyed by
    (rule, color). Output (rule, color, firstSeq,
    secondSeq). The next matching item comes from a reverse keyed scan over seq
    buckets, so a single color does not become a single task.
    """
    if not isinstance(rules, DataFrame):
        rules = items.sparkSession.createDataFrame(
            [(f"Rule_{n}", a, b) for n, (a, b) in enumerate(rules)], "rule string, first string, second string")
    nxt = scan_rules(rule_rows(items, rules), ["seq"],
                     F.floor(F.col("seq") / F.lit(seq_bucket)) if seq_bucket is not None else None)
    return (nxt.filter((F.col("shape") == F.col("first")) & F.col("_next").isNotNull())
            .select("rule", "color", F.col("seq").alias("firstSeq"), F.col("_next").alias("secondSeq")))
