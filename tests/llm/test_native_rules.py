"""Quality rules and URL rules against plain Python, and their plans."""

import collections
import re

import pytest

from llm_docs import docs_of  # noqa: F401
from tripstream.llm import quality_rules as quality
from tripstream.llm import queries
from tripstream.llm import url_rules as urls

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, " \t\n\x0b\x0c\r", "one", "a b", "a b c", "a b c a b c", "a a a a a a", "x # y $ <| z & % *",
         "line\nline\n \nline\nother", "the of and " * 30, "é" * 5 + " ß\u00a0x", "w " * 5000, "a,b\tc\r\nd",
         "It is the best of the times and it was the worst of the times . " * 2]


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            sum(x.lower() in quality.STOP_WORDS for x in w))


def verdict(c, n_lines):
    n, chars, symbols, dup, repeat, stop = c
    base = n < 50 or 100 * repeat > 50 * n
    bad = base or not 2.5 <= chars / n <= 12 or symbols / n > 0.1 or stop / n < 0.06 \
        or (n_lines and dup / n_lines > 0.35)
    return base, not bad


def test_quality_counts_and_verdicts(docs_of):
    rows = {r["doc_id"]: r for r in quality.quality_rules(docs_of(list(enumerate(TEXTS)))).collect()}
    assert len(rows) == len(TEXTS)
    for k, text in enumerate(TEXTS):
        r, want = rows[k], counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["n_stop_words"]) == want
        assert (r["base_failed"], r["kept"]) == verdict(want, r["n_lines"])
        assert bool(r["failed_rules"]) != r["kept"]


def test_quality_agrees_with_labels(spark):
    kept = queries.op5_quality_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = kept.join(labels, "doc_id").where("NOT base_failed").select("kept", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.5 * len(junk)


def test_quality_is_native_and_handles_empty_tables(spark, docs_of):
    df = quality.quality_rules(docs_of([(1, "a")]).where("false"))
    assert df.count() == 0
    plan = quality.quality_rules(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Exchange", plan)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"), ("a.example.net", "/en/x", "block"), ("example.net", "/en/", "allow"),
         ("", "/any/", "block"), (None, "/", "block"), ("EXAMPLE.com", "/de/ok/", "allow"), ("com", "/d", "allow")]
URLS = [None, "", "no scheme", "http://", "http://net/", "https://EXAMPLE.net/en/a?b#c", "http://a.b.example.net/en/x",
        "http://a.example.net/en/xy", "x://example.com/de/ok/1", "x://example.com/de", "ftp://my-net/", "http://net",
        "http://notexample.net/en/", "http://u.org/fr/?q=://net/", "http://q.org?x=/fr/", "http://é.org/fr/",
        "http://example.net:80/en/", "http://x.y/any/1", "http://..net/", "http://example.com/d", "a://b://net/"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for h, p, v in RULES:
        h = h.lower() if h is not None else None
        if h is not None and path.startswith(p) and (h == "" or host == h or host.endswith("." + h)):
            fits.append((len(h) + len(p), len(h), v == "block", h + p, v))
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("repeat", [1, 40])
def test_urls_match_plain_rules(spark, repeat):
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(URLS * repeat)],
                                  "page_id long, url string, host string, stack string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = urls.url_rules(pages, rules).collect()
    assert len(rows) == len(URLS) * repeat
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(URLS[r["page_id"] % len(URLS)])
    assert "Python" not in urls.url_rules(pages, rules)._jdf.queryExecution().toString()


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    r = urls.url_rules(pages, none).first()
    assert (r["host"], r["rule"], r["verdict"]) == ("a.net", None, "allow")
    assert urls.url_rules(pages.where("false"), rules).count() == 0
