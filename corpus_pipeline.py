"""Corpus pipeline: five text operators over ``documents``, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept and returns a DataFrame; ``run`` writes each result as Parquet into the
shared folder and reads it back as the next stage's documents.

1. ``toxicity``: documents scored toxic (0.7 or more) go; the model learns from
   the labelled rows of ``labels`` that the stage's documents still hold.
2. ``near_duplicates``: one document of each near-duplicate group stays.
3. ``substring_dedup``: sentences of repeated spans are cut from the texts;
   documents stay, with ``n_chars`` of the new text.
4. ``decontamination``: documents that hold a benchmark passage go.
5. ``sentencepiece``: token ids and digests of the remaining texts.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstream.llm import order_minhash, sentence_span_dedup, sentencepiece_agenda, toxicity_mil, wu_manber
from tripstream.llm.common import crc_mod, write_table


def _apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its other columns under names no operator uses, and the way
    back to the columns of ``docs``."""
    names = {c: c if c in ("doc_id", "text") else f"__doc_{k}" for k, c in enumerate(docs.columns)}
    apart = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return apart, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apart, back = _apart(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity_mil.train(apart, labels, crc_mod(F.col("doc_id"), 3) != 1)
    return back(toxicity_mil.score_documents(apart, model).where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apart, back = _apart(docs)
    return back(order_minhash.keep_one(apart))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apart, back = _apart(docs)
    cut = back(sentence_span_dedup.remove_repeated_spans(apart))
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType))
    return cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apart, back = _apart(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return back(wu_manber.decontaminate(apart, benchmark).where("NOT contaminated"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_agenda.encode_documents(docs, model, with_text=False, keep=["doc_id"])


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: The stages are not SQL; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
