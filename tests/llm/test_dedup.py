"""Repeated spans and near-duplicate groups against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from llm_docs import docs_of  # noqa: F401
from tripstream.llm import order_minhash as near
from tripstream.llm import queries
from tripstream.llm import sentence_span_dedup as spans

SF = "/root/testdata/sf0.001"


def sentences(text):
    """Pieces of the text, each with a word (white space goes with the one before)."""
    cuts = [0] + [m.end(1) for m in re.finditer(r"([.!?](?=[ \t\n\v\f\r])|\n)", text, re.A) if m.end(1) < len(text)] + [len(text)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        piece = text[a:b]
        if out and not re.search(r"[^ \t\n\v\f\r]", piece):
            out[-1] += piece
        elif piece:
            out.append(piece)
    return out


def brute_spans(docs, min_words, lone_words):
    """Removed sentences of each document, by comparing all runs."""
    split = lambda s: re.findall(r"[^ \t\n\v\f\r]+", s)
    norm = lambda s: " ".join(split(re.sub("[A-Z]", lambda m: m[0].lower(), s)))
    runs = {}
    parts = [sentences(t or "") for _, t in docs]
    for k, own in enumerate(parts):
        count = [len(split(s)) for s in own]
        found = set()
        for i in range(len(own)):
            if count[i] >= lone_words:
                found.add((i, i + 1))
                continue
            j = i + 2
            while j <= len(own) and sum(count[i:j]) < min_words:
                j += 1
            if j <= len(own):
                found.add((i, j))
            j = i - 1
            while j >= 0 and sum(count[j:i + 1]) < min_words:
                j -= 1
            if j >= 0:
                found.add((j, i + 1))
        for a, b in found:
            runs.setdefault(tuple(norm(s) for s in own[a:b]), []).append((docs[k][0], a, k, b))
    removed = [set() for _ in docs]
    for places in runs.values():
        for _, a, k, b in sorted(places)[1:]:
            removed[k].update(range(a, b))
    return parts, removed


def test_spans_match_brute_force(spark, docs_of):
    rnd = random.Random(2)
    pool = [" ".join(rnd.choice("aA b cé d e f".split()) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(1, 12)))
            for _ in range(40)]
    docs = []
    for k in range(60):
        at = rnd.randint(0, 30)
        body = [rnd.choice(pool) for _ in range(rnd.randint(0, 5))] + pool[at:at + rnd.randint(0, 6)]
        docs.append((k, "".join(s + rnd.choice([". ", "! ", ".\n", "?  ", "\n\n"]) for s in body)))
    docs += [(200, None), (201, ""), (202, " \n "), (203, docs[3][1]), (204, "x " * 60 + ". tail"), (205, "Y. " + "X  " * 60 + ".")]
    got = {r["doc_id"]: r for r in spans.remove_repeated_spans(docs_of(docs), min_words=10, lone_words=25).collect()}
    parts, removed = brute_spans(docs, 10, 25)
    assert len(got) == len(docs) and any(removed)
    for (i, text), own, gone in zip(docs, parts, removed):
        r = got[i]
        assert r["n_removed"] == sum(1 for k in gone if own[k].strip(" \t\n\v\f\r")), i
        kept = "".join(s for k, s in enumerate(own) if k not in gone)
        assert r["text"] == (kept.strip() if gone else text)


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    text = "one two three four five six. seven eight nine ten eleven twelve thirteen. fourteen fifteen sixteen seventeen."
    rows = [(1, text), (1, text), (None, "Intro words here. " + text), (2, text + " More."), (3, None)]
    df = docs_of(rows)
    got = spans.remove_repeated_spans(df, min_words=8).collect()
    # null ids come first, so that row keeps the passage
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (1, 3), (1, 3), (2, 3), (3, 0)]
    assert {r["text"] for r in got if r["doc_id"] == 2} == {"More."}
    assert spans.remove_repeated_spans(df.where("false")).count() == 0


def test_span_query_on_whole_table(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    parts, removed = brute_spans(sorted(docs), spans.MIN_WORDS, spans.LONE_WORDS)
    got = {r["doc_id"]: r for r in queries.op4_substring_dedup(spark, SF).collect()}
    for (i, text), own, gone in zip(sorted(docs), parts, removed):
        assert got[i]["n_removed"] == len(gone)
        assert got[i]["text"] == ("".join(s for k, s in enumerate(own) if k not in gone).strip() if gone else text)


def shingles(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    seen, out = {}, []
    for k in range(len(w) - 4):
        s = tuple(w[k:k + 5])
        seen[s] = seen.get(s, 0) + 1
        out.append((s, seen[s]))
    return tuple(w), out


def aligned(a, b):
    """Longest common subsequence by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def brute_groups(docs, threshold=0.8):
    own = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for i in range(len(docs)):
        for j in range(i):
            (wa, a), (wb, b) = own[i], own[j]
            if wa and wa == wb:
                same = True
            elif a and b and min(len(a), len(b)) >= 0.6 * max(len(a), len(b)) and len(set(a) & set(b)) > 0.5 * len(b):
                n = aligned(a, b)
                same = n / (len(a) + len(b) - n) >= threshold
            else:
                same = False
            if same:
                root[find(i)] = find(j)
    smallest = {}
    for k, (i, _) in enumerate(docs):
        smallest[find(k)] = min(smallest.get(find(k), i), i)
    return {i: smallest[find(k)] for k, (i, _) in enumerate(docs)}


def test_alignment_matches_the_plain_table():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = rng.permutation(60)[:rng.integers(1, 50)]
        b = np.array([x for x in a if rng.random() > 0.1] + list(range(100, 100 + rng.integers(0, 4))))
        if rng.random() < 0.3:
            b = np.roll(b, rng.integers(0, 5))
        if not len(b):
            continue
        n = aligned(a.tolist(), b.tolist())
        want = n / (len(a) + len(b) - n)
        got = near.alignment(a.astype(np.int32), b.astype(np.int32), 0.8)
        assert (got >= 0.8) == (want >= 0.8 - 1e-12)
        if want >= 0.8:
            assert got == pytest.approx(want)


def family_rows():
    rnd = random.Random(9)
    word = lambda: "w" + str(rnd.randint(0, 5000))
    docs, k = [], 0
    for size in (1, 1, 1, 2, 5, 40):
        base = [word() for _ in range(120)]
        for _ in range(size):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                own[rnd.randrange(120)] = word()
            docs.append((k, " ".join(own)))
            k += 1
    half = docs[0][1].split()
    docs += [(k, " ".join(half[60:] + half[:60])), (k + 1, None), (k + 2, ""), (k + 3, "..."), (k + 4, "Short text"),
             (k + 5, "short, TEXT!"), (k + 6, "short text more"), (k + 7, docs[0][1].upper())]
    return docs


def test_groups_match_brute_force(spark, docs_of, monkeypatch):
    docs = family_rows()
    want = brute_groups(docs)
    got = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(docs_of(docs)).collect()}
    assert got == want
    monkeypatch.setattr(near, "SMALL", 3)
    monkeypatch.setattr(near, "SMALL_FINER", 2)
    monkeypatch.setattr(near, "DEALT", 4)
    assert {r["doc_id"]: r["class_id"] for r in near.near_duplicates(docs_of(docs)).collect()} == want


def test_links_that_miss_the_hub(docs_of):
    """Texts linked to one member of a crowded family each, and not to its hub."""
    rng = np.random.default_rng(5)
    docs = []
    for family in range(2):
        base = rng.integers(0, 50000, 240)
        for _ in range(60):
            core = base.copy()
            core[rng.choice(np.arange(0, 240, 6), 3, replace=False)] = rng.integers(0, 50000, 3)
            second = core.copy()
            second[rng.choice(np.arange(3, 240, 6), 4, replace=False)] = rng.integers(0, 50000, 4)
            docs += [(len(docs) + k, " ".join(f"w{w}" for w in own)) for k, own in enumerate((core, second))]
    k = near.Kmers(pa.array([t for _, t in docs]))
    own, keys = [k.labelled[a:b] for a, b in zip(k.ends, k.ends[1:])], k.sketches(near.SKETCHES, near.MINIMA)
    root = list(range(len(docs)))
    for i in range(len(docs)):          # the pairs that share a bucket, all of them
        for j in np.flatnonzero((keys[:i] == keys[i]).any(axis=1)).tolist():
            if near.alignment(own[i], own[j], 0.8) >= 0.8 - 1e-12:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    got = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(docs_of(docs)).collect()}
    assert got == dict(enumerate(root))


def test_keep_one_repeated_rows_null_ids_and_empty_table(docs_of):
    text = " ".join(f"w{k}" for k in range(60))
    near_copy = text.replace("w30", "other")
    rows = [(5, text), (5, text), (None, text), (3, near_copy), (None, "x y z a b c"), (None, "x y z a b c"), (9, None), (9, None),
            (8, ""), (7, "different words are in this text here")]
    df = docs_of(rows)
    kept = near.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect() if r["text"]) == sorted(
        [("3", near_copy), ("None", "x y z a b c"), ("7", rows[-1][1])])
    groups = near.near_duplicates(df).collect()
    assert len(groups) == len(rows)
    assert {(r["doc_id"], r["class_id"]) for r in groups} == {(5, 3), (None, 3), (3, 3), (None, None), (9, 9), (8, 8), (7, 7)}
    assert near.keep_one(df.where("false")).count() == 0 and near.near_duplicates(df.where("false")).count() == 0


def test_near_query_on_whole_table(spark):
    docs = sorted((r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r["class_id"] for r in queries.op9_minhash_dedup(spark, SF).collect()}
    assert got == brute_groups(docs)


def test_sketches_depend_on_order():
    a = [f"w{k}" for k in range(200)]
    texts = pa.array([" ".join(a), " ".join(a), " ".join(a[100:] + a[:100])])
    keys = near.Kmers(texts).sketches(near.SKETCHES, near.MINIMA)
    assert (keys[0] == keys[1]).all() and (keys[0] == keys[2]).sum() < near.SKETCHES / 2
