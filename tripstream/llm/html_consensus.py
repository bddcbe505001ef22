"""Main-text extraction from HTML by consensus container paths per host.

Each page is parsed once into elements and text blocks. Going down from the body
into the child that holds most of the running text (links do not count) gives
the page's own container; an ``article`` or ``main`` with a quarter of the
running text (so no teaser) ends the descent. Its generalised path (tags with their classes, digits replaced) is the page's vote.
Spark counts the votes per host, and every page is extracted again from the
elements on its host's winning path, or from its own container where it has no
such element.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out inside the container too, by tag, role, hidden
state and the words of class and id. A wrapper stays, though a word of its name
is one of those (``content-with-sidebar``): an element that holds the article, or
whose name only contains the word and that holds half of the running text.
Comments go in any case. Character references are decoded, white
space inside a block becomes one space, blocks are joined by one newline.

Votes are pre-aggregated before the shuffle. Hosts with many pages (more than one
in a thousand; so there are at most a thousand of them) meet their winner through
salted keys, so one host may hold most pages. Null or empty pages give
an empty text; a null URL counts as the empty host. Repeated pages are extracted
one by one; input columns named like an output are replaced; an empty table gives an
empty one. A very long page is one row's work, in time and space in proportion to
it (some ten times its bytes).
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, write_table
from .url_rules import url_parts

#: A host with more than one in so many pages is dealt out for the join.
HOT = 1000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)

RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("html body div article section main td center table tbody tr".split())
CLOSES_P = BLOCKS - {"br", "html", "head", "body", "option", "optgroup", "legend", "caption"}
# An opening tag ends open elements of these kinds, up to the given bounds.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "td", "th"), ("table",)), "option": (("option",), ("select",)),
}
DROP_TAGS = frozenset("head nav header footer aside form dialog menu select button search fieldset".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                       "toolbar form".split())
DROP_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer comment comments commentlist disqus respond cookie cookies "
    "consent gdpr notice notices banner popup modal overlay newsletter subscribe subscription signup share sharing "
    "social related recommended masthead copyright pagination pager toolbar login widget".split())
DROP_NAMES = frozenset("header site-header page-header main-header top-header top topbar".split())
#: Why an element is left out: not at all, a word in a longer name, a name, for sure.
KEEP, WORD, NAMED, SURE = range(4)
#: The share of the page's running text with which an article is its container.
FAIR = 0.25
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[a-z]+")
_STATE = re.compile(r"^(?:has|with|without|no|is)[-_]")


class Page:
    """Elements (parent, label, dropped, text weight) and blocks of one page."""

    def __init__(self, source: str):
        self.parent, self.tag, self.label, self.drop = [-1], ["#root"], [""], [KEEP]
        self.weight = [0]
        self.blocks: list[tuple[int, str]] = []
        self._parse(source)
        self._decide()
        for k in range(len(self.parent) - 1, 0, -1):
            if not self.dropped[k]:
                self.weight[self.parent[k]] += self.weight[k]

    def _sums(self, least: int) -> list[int]:
        """Running text of each element without what is dropped for ``least`` or more."""
        out = self.weight[:]
        for k in range(len(out) - 1, 0, -1):
            if self.drop[k] < least:
                out[self.parent[k]] += out[k]
        return out

    def _decide(self) -> None:
        """``dropped``: an element named like a part to leave out stays if it is a
        wrapper: it holds the article (with half of the running text), or, where
        only a part of the name says so, half of the running text itself."""
        if WORD in self.drop or NAMED in self.drop:
            whole = self._sums(SURE)
            for k in range(1, len(self.parent)):
                if self.tag[k] in ("article", "main") and self.drop[k] == KEEP and 2 * whole[k] > whole[0]:
                    at = self.parent[k]
                    while at > 0:
                        if self.drop[at] in (WORD, NAMED):
                            self.drop[at] = KEEP
                        at = self.parent[at]
        if WORD in self.drop:
            whole = self._sums(NAMED)
            for k, why in enumerate(self.drop):
                if why == WORD and 2 * whole[k] > whole[0]:
                    self.drop[k] = KEEP
        self.dropped = [False] * len(self.parent)
        for k in range(1, len(self.parent)):
            self.dropped[k] = self.drop[k] > KEEP or self.dropped[self.parent[k]]

    def _open(self, tag: str, attrs: str, at: int) -> int:
        found = {}
        if "=" in attrs:
            for name, a, b, c in _ATTR.findall(attrs):
                found.setdefault(name.lower(), a or b or c)
        names = (found.get("class") or "").lower().split()
        label = ".".join([tag, *sorted(_DIGITS.sub("N", n) for n in names)])
        sure = tag in DROP_TAGS or (found.get("role") or "").lower() in DROP_ROLES \
            or found.get("aria-hidden", "").lower() == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attrs) is not None \
            or "display:none" in found.get("style", "").replace(" ", "").lower()
        drop = SURE if sure else KEEP
        if not sure and tag not in ("html", "body", "main"):
            for name in names + (found.get("id") or "").lower().split():
                if name in DROP_NAMES:
                    why = NAMED
                elif _STATE.match(name) or DROP_WORDS.isdisjoint(_WORDS.findall(name)):
                    continue
                else:
                    why = SURE if "comment" in name else NAMED if name in DROP_WORDS else WORD
                if tag != "article" or why == SURE:
                    drop = max(drop, why)
        self.parent.append(at)
        self.tag.append(tag)
        self.label.append(label)
        self.drop.append(drop)
        self.weight.append(0)
        return len(self.parent) - 1

    def _parse(self, source: str) -> None:
        stack, buffer, plain = [0], [], 0
        tags, links, pos = self.tag, 0, 0

        def flush():
            nonlocal plain
            if buffer:
                text = " ".join("".join(buffer).split())
                if text:
                    own = next(k for k in reversed(stack) if tags[k] in BLOCKS or k == 0)
                    self.blocks.append((own, text))
                    self.weight[own] += plain
                buffer.clear()
            plain = 0

        def close(depth):
            nonlocal links
            while len(stack) > depth:
                if tags[stack.pop()] == "a":
                    links -= 1

        def add(piece):
            nonlocal plain
            if piece:
                text = _html.unescape(piece) if "&" in piece else piece
                buffer.append(text)
                if not links:
                    plain += len(text.strip())

        while True:
            m = _TAG.search(source, pos)
            if m is None:
                add(source[pos:])
                break
            add(source[pos:m.start()])
            pos = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                if name == "br":
                    flush()
                    continue
                depth = next((d for d in range(len(stack) - 1, 0, -1) if tags[stack[d]] == name), 0)
                if name in BLOCKS:
                    flush()
                if depth and name not in ("html", "body"):
                    close(depth)
                continue
            if name in RAW:
                if not (m.group(3) or "").endswith("/") or name not in ("svg", "math"):
                    end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, pos)
                    pos = len(source) if end is None else end.start()
                continue
            if name in BLOCKS:
                flush()
                if name in CLOSES_P:
                    self._end(stack, ("p",), ("article", "section", "div", "table", "td", "body"), close)
                if name in IMPLIED:
                    self._end(stack, *IMPLIED[name], close)
                if name == "body":   # the head ends, whether closed or not
                    self._end(stack, ("head",), (), close)
            elif name == "a" and links:
                self._end(stack, ("a",), ("div", "td", "li", "p"), close)
            if name in VOID:
                continue
            at = self._open(name, m.group(3) or "", stack[-1])
            stack.append(at)
            if name == "a":
                links += 1
        flush()

    def _end(self, stack, names, bounds, close) -> None:
        """Close the outermost open element of ``names`` that is above ``bounds``."""
        depth = 0
        for d in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[d]]
            if tag in names:
                depth = d
            elif tag in bounds:
                break
        if depth:
            close(depth)

    def container(self) -> int:
        """The element that the page's own text shares point to."""
        children: dict[int, list[int]] = {}
        headed = set()
        for k in range(1, len(self.parent)):
            if self.weight[k] > 0 and not self.dropped[k]:
                children.setdefault(self.parent[k], []).append(k)
                if self.tag[k] in ("h1", "h2"):
                    headed.add(self.parent[k])
        for tag in ("article", "main"):
            found = [k for k in range(1, len(self.tag)) if self.tag[k] == tag and not self.dropped[k]]
            best = max(found, key=lambda k: self.weight[k], default=None)
            if best is not None and self.weight[best] > 0 and self.weight[best] >= FAIR * self.weight[0]:
                return best
        at = 0
        while True:
            below = max(children.get(at, ()), key=lambda k: self.weight[k], default=None)
            if below is None or self.tag[below] not in CONTAINERS or at in headed \
                    or self.weight[below] < 0.6 * self.weight[at]:
                return at
            at = below

    def path(self, at: int) -> str:
        labels = []
        while at > 0:
            labels.append(self.label[at])
            at = self.parent[at]
        return "/".join(reversed(labels))

    def on_path(self, path: str) -> list[int]:
        """Outermost elements with this path that are not left out."""
        last = path.rsplit("/", 1)[-1]
        return [k for k in range(1, len(self.tag))
                if self.label[k] == last and not self.dropped[k] and self.path(k) == path]

    def text(self, roots: list[int]) -> str:
        inside = [False] * len(self.parent)
        for k in roots:
            inside[k] = True
        for k in range(1, len(inside)):
            inside[k] = inside[k] or inside[self.parent[k]]
        return "\n".join(t for k, t in self.blocks if inside[k] and not self.dropped[k])


def page_vote(source: str) -> str | None:
    """The path of the page's own container; null if it has no text."""
    page = Page(source)
    at = page.container()
    return page.path(at) if page.weight[at] > 0 else None


def page_text(source: str, path: str | None) -> str:
    """Text of the elements on ``path``, or of the page's own container."""
    page = Page(source)
    roots = page.on_path(path) if path else []
    if path == "":
        roots = [0]
    text = page.text(roots) if roots else ""
    return text or page.text([page.container()])


def extract_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                  hot: int = HOT, keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points) of the main text."""
    kept = [c for c in (pages.columns if keep is None else keep) if c.lower() not in ("text", "n_chars")]
    source = pages.select(*[F.col(f"`{c}`") for c in kept], url_parts(F.col(url_col))[0].alias("__h_host"),
                          F.col(f"`{html_col}`").alias("__h_html"))

    def votes():
        return lambda texts: [pa.array([page_vote(t) if t else None for t in texts.to_pylist()], pa.string())]

    # a vote is one page; equally many votes: the path first in order wins
    counted = write_table(map_texts(source, "__h_html", "__h_path string", votes, ["__h_host"])
                          .where(F.col("__h_path").isNotNull())
                          .groupBy("__h_host", "__h_path").agg(F.count(F.lit(1)).alias("n")), "html-votes")
    total = counted.agg(F.sum("n")).first()[0] or 0
    best = F.min(F.struct((-F.col("n")).alias("n"), "__h_path"))
    hosts = counted.groupBy(F.col("__h_host").alias("__h_key")).agg(
        best["__h_path"].alias("__h_best"),
        F.floor(F.sum("n") * F.lit(hot) / F.lit(max(total, 1))).cast("int").alias("__h_deals"))
    # at most `hot` hosts have one in `hot` pages each: a bounded broadcast
    busy = hosts.where("__h_deals > 0").select(F.col("__h_key").alias("__h_busy"), "__h_deals")
    dealt = (source.join(F.broadcast(busy), F.col("__h_host") == F.col("__h_busy"), "left")
             .withColumn("__h_salt", F.pmod(F.xxhash64("__h_html"),
                                            F.coalesce("__h_deals", F.lit(0)) + 1).cast("int"))
             .drop("__h_busy", "__h_deals"))
    winners = hosts.select("__h_key", "__h_best", F.explode(F.sequence(F.lit(0), "__h_deals")).alias("__h_part"))
    joined = dealt.join(winners, (F.col("__h_host") == F.col("__h_key")) & (F.col("__h_salt") == F.col("__h_part")),
                        "left")
    # the page and its host's path go to the extractor as one text
    packed = joined.select(*[F.col(f"`{c}`") for c in kept],
                           F.concat(F.coalesce("__h_best", F.lit("\x01")), F.lit("\0"),
                                    F.coalesce("__h_html", F.lit(""))).alias("__h_packed"))

    def extract():
        def work(texts):
            out = []
            for packed in texts.to_pylist():
                path, _, page = packed.partition("\0")
                out.append(page_text(page, None if path == "\x01" else path) if page else "")
            return [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]
        return work

    return map_texts(packed, "__h_packed", "text string, n_chars long", extract, kept)
