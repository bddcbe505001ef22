"""Registered queries of the text operators, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.util import spread
from . import conversation_trie as trie
from . import html_consensus as html
from . import kneser_ney as lm
from . import order_minhash as near
from . import periodic_runs as periodic
from . import quality_kernel as kernel
from . import quality_rules as quality
from . import sentence_span_dedup as spans
from . import sentencepiece_agenda as pieces
from . import token_counts as tokens
from . import toxicity_mil as toxicity
from . import url_rules as urls
from . import wu_manber as leaks
from .common import crc_mod, write_table

#: (host, path, verdict) of the registered URL rules.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.remove_repeated_spans(docs)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.quality_rules(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "n_stop_words", "base_failed", "kept")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urls.url_rules(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 7) == 2, F.lit(False))
    model = lm.train_model(docs, ~held_out)
    scored = lm.score_documents(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score_documents(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted",
                         F.size("offending").cast("long").alias("n_offending"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_documents(spread(docs), public_tokenizers.path("piece_bpe_32k.model"),
                                   with_ids=False, with_text=False, keep=["doc_id"])


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_pages(pages, keep=["page_id", "url"])


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near.near_duplicates(docs)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.decontaminate(docs, _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _periodic_tail(docs: DataFrame) -> DataFrame:
    """``docs`` with the words from a on of every tenth text (by crc32 of its id)
    replaced by repeats of the p words there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.select("doc_id", "text", g.alias("_g"), words.alias("_w")).withColumn("_n", F.size("_w"))
    docs = docs.withColumn("_a", F.when(F.col("_n") > 0, (F.col("_g") % F.col("_n")).cast("int")))
    left = F.col("_n") - F.col("_a")
    docs = docs.withColumn("_p", (1 + F.floor(left / (3 + F.col("_g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("_w", F.col("_a") + 1, F.col("_p")), F.ceil(left / F.col("_p")).cast("int")))
    again = F.concat(F.slice("_w", F.lit(1), F.col("_a")), F.slice(tail, F.lit(1), left))
    return docs.select("doc_id", F.when(F.col("_n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.periodic_runs(_periodic_tail(spread(docs)), keep=["doc_id"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    better = lambda a, b: F.coalesce(b["length"] * a["period"] > a["length"] * b["period"], F.lit(True))
    best = F.reduce("runs", none, lambda a, b: F.when(better(a, b), b).otherwise(a))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def _rebuilt(talks: DataFrame) -> DataFrame:
    """Every conversation with its first h turns from the conversation whose
    number is the next lower multiple of 20."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    talks = talks.withColumn("_from", F.col("conv_id") - F.col("conv_id") % 20)
    base = talks.where("conv_id = _from").select("_from", F.slice("turns", 1, 3).alias("_base"))
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.slice(F.coalesce("_base", none), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))))
    return talks.join(base, "_from", "left").select("conv_id", turns.alias("turns"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    nodes = trie.prefix_trie(_rebuilt(trie.conversation_turns(rows)))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    described = write_table(kernel.document_statistics(spread(docs), keep=["doc_id"]), "quality-described")   # texts are read once
    model = kernel.train_statistics(described, _table(spark, sf_dir, "labels"), ~held_out)
    scored = kernel.score_statistics(described, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_toxicity": op2_toxicity,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_quality_rules": op5_quality_rules,
        "op6_url_filters": op6_url_filters,
        "op7_html_extraction": op7_html_extraction,
        "op8_token_counts": op8_token_counts,
        "op9_minhash_dedup": op9_minhash_dedup,
        "op10_decontamination": op10_decontamination,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_quality_classifier": op13_quality_classifier,
    }


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


OP5_SQL = r"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT doc_id, i AS p, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win)
  WHERE n >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n
  FROM twice CROSS JOIN (VALUES (0), (1), (2)) AS t(k) GROUP BY doc_id),
counts AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: lower(x) IN (STOP_LIST)))::BIGINT AS n_stop_words
  FROM words LEFT JOIN covered USING (doc_id)),
flags AS (
  SELECT *, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, base_failed,
  NOT (base_failed
    OR word_chars::DOUBLE / n_words < 2.5 OR word_chars::DOUBLE / n_words > 12
    OR n_symbols::DOUBLE / n_words > 0.1
    OR (len(ls) > 0 AND n_dup_lines::DOUBLE / len(ls) > 0.35)
    OR n_stop_words::DOUBLE / n_words < 0.06) AS kept
FROM flags
"""

OP10_SQL = r"""
WITH item AS (
  SELECT DISTINCT item_id::VARCHAR AS item_id, w FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL)),
pattern AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
place AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc)
  JOIN (SELECT DISTINCT size FROM pattern) ON i + size - 1 <= len(w)),
found AS (SELECT doc_id, i, size, item_id FROM place JOIN pattern USING (size, words)),
hit AS (
  SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM found, LATERAL (SELECT unnest(range(0, size)) AS k)
  GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*)::BIGINT AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
  coalesce(listed.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP6_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(r, '') AS r FROM rest)),
rules(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, rh || rp AS rule, rv,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rh) + length(rp) DESC, length(rh) DESC) AS k
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT parts.page_id, host, path, fits.rule AS rule, coalesce(rv, 'allow') AS verdict
FROM parts LEFT JOIN fits ON parts.page_id = fits.page_id AND k = 1
"""


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text)) AS p FROM t),
c AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda r, i: xor(r >> 1, (r & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN o USING (conv_id) WHERE p > h),
prefix AS (
  SELECT conv_id, row_number() OVER w AS depth, list(struct_pack(role := role, text := text)) OVER w AS path,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
member AS (
  SELECT sha256(to_json(path)::VARCHAR) AS node, CASE WHEN depth > 1 THEN sha256(to_json(path[:-2])::VARCHAR) ELSE '' END AS parent,
    conv_id, depth, words, path FROM prefix
  UNION ALL SELECT '', NULL, conv_id, 0, 0, NULL FROM c),
node AS (
  SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
    (count(*) - 1) * any_value(words) AS own FROM member GROUP BY node),
child AS (SELECT parent AS node, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent),
sized AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (node)),
above AS (
  SELECT DISTINCT a.node AS top, m.node FROM member m JOIN member a ON a.conv_id = m.conv_id AND a.depth <= m.depth),
below AS (
  SELECT top AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM above JOIN sized USING (node) GROUP BY top),
longest AS (SELECT conv_id, max(depth) AS depth FROM member GROUP BY conv_id),
ends AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM member JOIN longest USING (conv_id, depth) GROUP BY node)
SELECT s.conv_id, s.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, s.n_convs::BIGINT AS n_convs,
  s.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM sized s JOIN below b USING (node) LEFT JOIN sized p ON p.node = s.parent LEFT JOIN ends e ON e.node = s.node
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_quality_rules": OP5_SQL.replace("STOP_LIST", _sql_list(quality.STOP_WORDS)),
        "op6_url_filters": OP6_SQL,
        "op10_decontamination": OP10_SQL,
        "op12_conversation_trie": OP12_SQL,
    }
