"""Every stage of the corpus pipeline against its operator or brute force."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from test_decontamination import brute as brute_leaks
from test_dedup import brute_groups, brute_spans
from tripstream.llm import queries
from tripstream.llm import sentence_span_dedup as spans
from tripstream.llm import sentencepiece_agenda as pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before the first stage and after each one."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_order_and_columns(steps):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "decontamination",
                                               "sentencepiece"]
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_toxic_documents_go(spark, steps):
    score = {r["doc_id"]: r["predicted"] for r in queries.op2_toxicity(spark, SF).collect()}
    assert texts(steps[1]) == [x for x in texts(steps[0]) if score[x[0]] == 0]


def test_one_of_each_group_stays(steps):
    docs = texts(steps[1])
    root = brute_groups(docs)
    assert texts(steps[2]) == [x for x in docs if root[x[0]] == x[0]]


def test_repeated_spans_are_cut(steps):
    docs = texts(steps[2])
    parts, removed = brute_spans(docs, spans.MIN_WORDS, spans.LONE_WORDS)
    want = [(i, "".join(s for k, s in enumerate(own) if k not in gone).strip() if gone else t)
            for (i, t), own, gone in zip(docs, parts, removed)]
    assert texts(steps[3]) == want
    assert steps[3].where("n_chars <> length(text)").count() == 0


def test_contaminated_documents_go(spark, steps):
    docs = texts(steps[3])
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = brute_leaks([t for _, t in docs], items, 10)
    assert texts(steps[4]) == [x for x, (_, places, _) in zip(docs, hit) if not places]


def test_token_ids(steps):
    library = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model")).library
    got = {r["doc_id"]: r for r in steps[5].collect()}
    docs = texts(steps[4])
    assert sorted(got) == [i for i, _ in docs]
    for i, text in docs:
        ids = library.encode(text)
        assert got[i]["ids"] == ids
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, steps):
    rows = lambda df: sorted((r["doc_id"], r["ids_sha256"]) for r in df.collect())
    assert rows(pipeline.run(spark, SF)) == rows(steps[5])


def test_odd_documents(spark):
    """Nulls in every column, empty and repeated rows, clashing names, no rows."""
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(3)
    odd = spark.createDataFrame([(None, None, None, None, None), (900, "", "en", "s", 0), (900, "", "en", "s", 0), (901, "x", None, None, 1)],
                                base.schema)
    docs = base.unionByName(odd).unionByName(odd)
    for name in ("score", "predicted", "offending", "spans", "items", "n_words", "copy", "run"):
        docs = docs.withColumn(name, F.lit("own"))
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.dtypes == docs.dtypes and out.where("score <> 'own'").count() == 0
        assert out.where("doc_id = 901").count() >= 1
        assert stage(spark, docs.where("false"), SF).count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
