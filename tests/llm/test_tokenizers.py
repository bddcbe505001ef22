"""Token counts and piece encoding against the libraries."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest

from llm_docs import docs_of  # noqa: F401
from tripstream.llm import queries
from tripstream.llm import sentencepiece_agenda as pieces
from tripstream.llm import token_counts as tokens

SF = "/root/testdata/sf0.001"
EDGE = ["", None, "a", " ", "  a", "a  ", "it's o'clock 'sx ''s 'rest we'll x'll", "can't'd'm 're", "aaaaaaa" * 50,
        "<|endoftext|>y<|endoftext|>  <|endoftext|> z", "<|endof text|>", "　　x  y\n\n z\n", "a\0b", "▁", "a▁ b", "<s> <unk>",
        "日本語\U0001F600x", "\r\n\t", "x" * 50_000, "ab " * 20_000, "1²3 ٣", "é'll\u00a0's"]


def noise(alphabet, n, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_counts_match_library(library):
    table = tokens.merge_table(public_tokenizers.path("byte_bpe_50k.json"))
    texts = EDGE + noise(list("ab'slredmtv  \n\t1²٣éß日\u00a0\u3000.!") + ["<|endoftext|>"], 3000)
    n_bytes, n_tokens = tokens.count_batch(table, pa.array(texts, pa.string()))
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert n_tokens.tolist() == want
    assert n_bytes.tolist() == [len((t or "").encode()) for t in texts]


def test_classes_of_all_characters(library):
    table = tokens.merge_table(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"a{chr(c)}b1{chr(c)} {chr(c)}" for c in range(1, 0x3100)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert tokens.count_batch(table, pa.array(texts))[1].tolist() == want


def test_count_query(spark, library, docs_of):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r[0]: len(e.ids) for r, e in zip(rows, library.encode_batch([r[1] for r in rows], add_special_tokens=False))}
    got = queries.op8_token_counts(spark, SF).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    odd = tokens.token_counts(docs_of([(None, None), (1, "a b"), (1, "a b")]),
                              public_tokenizers.path("byte_bpe_50k.json"), limit=1)
    assert sorted((r["n_tokens"], r["over_limit"]) for r in odd.collect()) == [(0, False), (2, True), (2, True)]
    assert odd.where("false").count() == 0


def test_pieces_match_library():
    vocab = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    texts = EDGE + noise(list("ab's\0e<s>▁  \n\t1²éß日\u00a0.!x") + ["▁▁", "the", "<unk>", "\U0001F600"], 2000)
    ids, number, first = pieces.encode_batch(vocab, pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        own = [i for w in number[first[k]:first[k + 1]] for i in ids[w]]
        want = vocab.library.encode(text or "")
        assert own == want == vocab.encode(text or "")
        assert vocab.decode(own) == vocab.library.decode(want)
    for odd in ([3, 4, 200, 201, 259], [0, 1, 2, 230, 260], [1, 259], []):
        assert vocab.decode(odd) == vocab.library.decode(odd)


def test_piece_query_and_outputs(spark, docs_of):
    vocab = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.op3_sentencepiece(spark, SF).collect():
        ids = vocab.library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(vocab.library.decode(ids))
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode_documents(docs_of([(1, "hello  world"), (2, None), (2, ""), (None, "x")]), path).collect()
    for r in rows:
        text = {1: "hello  world", 2: "", None: "x"}[r["doc_id"]]
        assert r["ids"] == vocab.library.encode(text) and r["decoded"] == text
    assert pieces.encode_documents(docs_of([(1, "a")]).where("false"), path).count() == 0


def test_check_stops_on_a_difference(monkeypatch):
    vocab = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(vocab, "encode_symbols", lambda text: [5])
    with pytest.raises(ValueError, match="differ"):
        pieces.encode_batch(vocab, pa.array(["some words"]))
