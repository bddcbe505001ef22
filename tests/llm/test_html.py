"""HTML extraction: single pages, host consensus, odd inputs."""

import html
import re

import pytest

from tripstream.llm import html_consensus as ex
from tripstream.llm import queries

SF = "/root/testdata/sf0.001"
LONG = "Some long running text that makes this block the heavy one, with commas, and more words. "


@pytest.mark.parametrize("source, want", [
    ("<html><body><nav>m</nav><div class='ad'>Buy</div><article><h1>T &amp; x</h1><p><b>Hi there.<br><p>Second   one\n x</b>"
     "<aside>no</aside><form>f</form><div class=comments><p>c</p></div></article><footer>f</footer>",
     "T & x\nHi there.\nSecond one x"),
    ("plain &lt;b>", "plain <b>"), ("", ""), ("<p>a<p>b", "a\nb"), ("<body><p>text &am", "text &am"),
    ("<title>t</title><style>p{}</style><script>var a='</p><p>x'</script><!-- <p>c</p> --><p>x", "x"),
    ("<div id='sidebar'><p>" + LONG + "</p></div><div class='content-12'><p>a b c</p><ul><li>x<li>y</ul></div>", "a b c\nx\ny"),
    ("<main><p>a<a href='x'>link</a> end</p><div hidden>h</div><div style='display: none'>n</div></main>", "alink end"),
    ("<article><p>1 &lt; 2 <!-- no --> &copy;&#233;&nbsp;x</p><p></p><p> </p></article><p>cut <a hre", "1 < 2 ©é x"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<ARTICLE><P CLASS=x>up</P></ARTICLE>", "up"),
    # wrappers with a listed word in their names
    ("<body><div class='elementor-widget-container'><h1>T</h1><p>" + LONG + "</p></div></body>", "T\n" + LONG.strip()),
    ("<div class='content-with-sidebar'><div class='sidebar'><p>side</p></div><article><p>" + LONG + "</p></article></div>", LONG.strip()),
    ("<div id='layout-right-sidebar'><article><p>" + LONG + "</p></article><div class='ad'>Buy</div></div>", LONG.strip()),
    ("<article><div class='promotion-history'><p>" + LONG + "</p></div><div class='ad'>x</div></article>", LONG.strip()),
    ("<div class='widget'><main><p>" + LONG + "</p></main></div>", LONG.strip()),
    # comments go, however long; so does a named sidebar
    ("<article><p>a b c</p></article><div class='user-comments'><p>" + LONG * 3 + "</p></div>", "a b c"),
    # a teaser is not the article
    ("<div class='text'><p>" + LONG * 4 + "</p></div><div><article><p>teaser</p></article></div>", (LONG * 4).strip()),
    ("<div>" * 2000 + "deep" + "</div>" * 5, "deep"), ("<a b='>'>x</a> < y", "x < y"),
])
def test_single_pages(source, want):
    assert ex.page_text(source, ex.page_vote(source) if source else None) == want


def test_consensus_decides_for_pages_with_little_text(spark):
    body = "<html><body><div class='promo-7x'><p>{}</p></div><div class='post post-{}'><p>{}</p></div></body></html>"
    pages = [(k, f"http://h.example/{k}", body.format("x", k, LONG * 3)) for k in range(5)]
    # a page whose own heaviest container is not the article
    odd = "<html><body><div class='box'><p>" + LONG * 5 + "</p></div><div class='post post-99'><p>short</p></div></body></html>"
    pages += [(9, "http://h.example/9", odd), (10, "http://other.example/", odd), (11, None, odd), (12, "http://h.example/", None),
              (13, "http://h.example/", ""), (9, "http://h.example/9", odd)]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, text string, path string")
    rows = ex.extract_pages(df, hot=2).collect()
    assert len(rows) == len(pages)
    got = {(r["page_id"], r["url"]): r["text"] for r in rows}
    assert got[9, "http://h.example/9"] == "short"
    assert got[10, "http://other.example/"] == (LONG * 5).strip() and got[11, None] == (LONG * 5).strip()
    assert got[12, "http://h.example/"] == got[13, "http://h.example/"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert ex.extract_pages(df.where("false")).count() == 0


def test_whole_table_against_the_article_element(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op7_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article))
        assert r["text"] == "\n".join(b for b in blocks if b)
