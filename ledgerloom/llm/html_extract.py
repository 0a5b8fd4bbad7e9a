"""Main text of web pages by a decision tree over flat text blocks.

A page becomes a flat list of text blocks in page order.  Every block carries
its number of words and its link density (share of words inside links), those
of the block before and after it, and what the markup around it says: whether
it lies inside an article, whether the page has one, whether it is a heading,
and whether an enclosing element is marked as page furniture (menu, header,
footer, sidebar, notice, advert, form, comments).  A decision tree, trained on
the blocks of the small labelled pages below, keeps a block or drops it.
Scripts, styles, markup comments and other unseen content never become text.

Kept blocks are joined in page order by an empty line; nothing else is dropped
or cut.  Null and empty pages, and pages without a kept block, give an empty
text.  Pages are independent: repeated rows give equal texts, an empty table
an empty result, and extra columns are not read.  Markup that no parser would
accept is read as far as it makes sense and never fails.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import map_frames

#: HTML elements that end a block; that hold no text; that have no end tag.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul""".split())
UNSEEN = frozenset("script style noscript template iframe object svg math canvas audio video head textarea select datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(("article", "main"))
#: Elements that are page furniture by themselves.
FURNITURE = frozenset("nav header footer aside form menu button fieldset dialog".split())
#: Words of class, id or role that mark an element as page furniture.
FURNITURE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment
    comments complementary consent contentinfo cookie cookies copyright disclaimer discussion disqus footer form gdpr header
    legal login masthead menu modal nav navbar navigation newsletter notice notification pager pagination paywall popup promo
    promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor
    sponsored subscribe subscription tags toolbar topbar widget""".split())
#: Of these, those that an article may hold as a part of itself.
ARTICLE_PARTS = frozenset(("header", "banner"))
#: Elements that the start of such an element ends, if they are open.
CLOSED_BY = {"li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
             "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
             "option": frozenset(("option",))}
#: Elements that may stand in the head of a page; the start of any other ends it, as its author may leave out the end tag.
HEAD_PARTS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: What ends a markup comment, also wrongly written.
COMMENT_END = re.compile(r"--(?:\s*|!)>")
#: Elements beyond which such an end is not looked for.
SCOPE = frozenset(("table", "ul", "ol", "dl", "article", "section", "div", "body", "main", "nav", "aside", "form"))

FEATURES = ("furniture", "in_article", "has_article", "heading", "words", "density", "words_before", "density_before",
            "words_after", "density_after")

#: The labelled table: small pages whose blocks to keep are marked k.
LABELLED = (
    """<body><nav><ul><li><a href=1>Home</a></li><li><a href=2>World news</a></li></ul></nav>
    <div class="ad">Buy two of these and pay for only one of them until the end of the week, free delivery included.</div>
    <article><h1 k>Bridge reopened</h1><p k>The old bridge over the river was opened to traffic again on Monday after two
    years of repair work that had cost the town more than planned.</p><p k>Few came.</p><p k>More trains are to follow in
    spring, as <a href=3>the council</a> had said before.</p></article>
    <footer>&copy; 2020 The Daily Paper &middot; <a href=4>Imprint</a></footer></body>""",
    """<body><header><div>The Daily Paper</div><p>Independent news from the valley since nineteen hundred and four.</p></header>
    <main><h1 k>Rain</h1><p k>It rained.</p><p k>Streets were under water for most of the day, and the fire brigade was out
    more than a hundred times until the evening.</p><h2 k>What comes next</h2><p k>More rain.</p>
    <aside>Read also what our readers wrote about the flood of last year and how they dealt with it.</aside>
    <p k>Schools stay closed.</p></main><div id="comments"><p>I was there and it was much worse than you write, the whole
    cellar was full of water and nobody came to help us for hours.</p><p>Same here.</p></div></body>""",
    """<body><div class="cookie-notice">We use cookies to make this site better for you. By going on you agree to that.</div>
    <div class="sidebar"><p>About me: I write about gardens, bread and long walks, mostly in this order, since 2009.</p></div>
    <div class="post"><h2 k>Bread</h2><p k>Take a pound of flour, a spoon of salt and some water, and leave the dough alone for
    a night in a cool place.</p><p k>Then bake it for an hour at the highest heat that your oven has, with a bowl of water
    below.</p></div><form><label>Your mail address</label><p>Write to me and I shall answer as soon as I find the time.</p></form>
    </body>""",
    """<body><div><a href=1>Home</a> <a href=2>Shop</a> <a href=3>Contact</a></div><div k>Our workshop has repaired clocks of all
    kinds for three generations, from the church tower to the wrist watch, and still does so by hand.</div><div k>Bring yours
    along; we look at it while you wait and tell you what the repair would cost before we begin with it.</div>
    <div><a href=4>Terms of use</a> <a href=5>Privacy</a></div><div>Clock House Ltd</div></body>""",
    """<body><ul class="menu"><li>File</li><li>Edit</li></ul><table><tr><td><a href=1>one link</a></td><td><a href=2>another
    one</a></td></tr></table><p k>The harbour was built when the town had no more than forty houses and a chapel, and for long
    it was the only safe place on that coast for ships in a storm.</p><p k>Today yachts lie where the fishing boats once were,
    and the fish market has become a restaurant with a view of them.</p><p>Share this</p><p><a href=9>Next page</a></p></body>""",
    """<body><article><h1 k>Notes</h1><p k>One.</p><p k>Two of them.</p><ul><li k>flour</li><li k>salt</li></ul><blockquote k>They
    said so.</blockquote><div class="share"><a href=1>Mail</a></div><div class="related"><a href=5>More notes</a><p>Ten things
    about bread that nobody has told you so far, and why you should know them.</p></div><p k><a href=7>The whole report</a></p>
    <section class="comments"><p>First! And a long comment about what I think of this and of the people who wrote it.</p>
    </section></article><p>All rights reserved by the publisher, no part of this may be copied without a written permit.</p>
    <div>Popular today and in the last week among all of our readers in this region and beyond it</div></body>""",
    """<body><div class="topbar">Sign in</div><div class="content"><h1 k>Ants</h1><p k>Ants live in colonies that can hold from a
    few dozen to several million animals, most of them workers without wings.</p><p k>They are found on every continent but
    one.</p><p k>Their paths are marked by scent, which the next ant follows and renews if it too has found food there.</p></div>
    <div class="newsletter">Get the best of nature in your mail box every Sunday morning, for free and without any adverts.</div>
    <footer><p>This site is run by volunteers and lives from your gifts, thank you for them.</p></footer></body>""",
    """<body><div>Today in the paper: what the council decided, who won the cup, and why the mill is for sale again.</div><div>
    <p>Our shop sells the photographs of the week as prints on good paper, framed or unframed, in three sizes.</p></div><article>
    <h1 k>The mill</h1><p k>Sold.</p><p k>The mill was sold to a baker who wants to grind his own flour there from next year.</p>
    <p k><a href=1>Map of the place</a></p><p k>He knows the mill well.</p></article></body>""",
    """<body><h1 k>How to sharpen a knife</h1><p k>Wet the stone and lay the knife on it at a low angle, the edge away from you.</p>
    <p k>Push it along the stone with even pressure, ten times on each side, and wipe it.</p><p k>Test it on paper, never on your
    thumb, and begin again if it does not cut the sheet at once.</p></body>""",
)


class Block(NamedTuple):
    text: str
    words: int
    density: float
    furniture: bool
    in_article: bool
    heading: bool
    label: bool


class _Blocks(HTMLParser):
    """Flat text blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, bool]] = []       # element, furniture, marked as to keep
        self.unseen = self.furniture = self.articles = self.links = self.headings = self.marked = 0
        self.parts: list[str] = []
        self.words = self.linked = 0
        self.has_article = False

    def parse_comment(self, i: int, report: bool = True) -> int:
        """The end of the comment at ``i``: pages are fed whole, so one that has no end hides the rest."""
        for empty in (">", "->"):
            if self.rawdata.startswith(empty, i + 4):
                return i + 4 + len(empty)
        end = COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:         # a declaration that the parser gives up on
            return self.parse_bogus_comment(i)

    def _end_head(self) -> None:
        while any(x[0] == "head" for x in self.open):
            self._pop()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            density = min(1.0, self.linked / max(1, self.words))
            self.blocks.append(Block(text, self.words, density, self.furniture > 0, self.articles > 0, self.headings > 0,
                                     self.marked > 0))
        self.parts, self.words, self.linked = [], 0, 0

    def _count(self, tag: str, furniture: bool, marked: bool, by: int) -> None:
        self.unseen += by * (tag in UNSEEN)
        self.furniture += by * furniture
        self.articles += by * (tag in ARTICLE)
        self.links += by * (tag == "a")
        self.headings += by * (tag in HEADING)
        self.marked += by * marked

    def _pop(self) -> None:
        self._count(*self.open.pop(), -1)

    def _close(self, names: frozenset[str], scope: frozenset[str]) -> None:
        """Ends the innermost open element of ``names`` and all inside it, unless one of ``scope`` lies between."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in names:
                while len(self.open) > k:
                    self._pop()
                return
            if self.open[k][0] in scope:
                return

    def _is_furniture(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in ("html", "body", "main", "article"):
            return False
        if "hidden" in attrs or "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return True
        if (attrs.get("aria-hidden") or "").lower() == "true":
            return True
        names = " ".join(attrs.get(k) or "" for k in ("class", "id", "role"))
        found = {*re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower())} & FURNITURE_WORDS
        if tag in FURNITURE:
            found = found | {tag}
        return bool(found - ARTICLE_PARTS if self.articles else found)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("body", "article", "main") or tag not in HEAD_PARTS and self.open and self.open[-1][0] == "head":
            self._end_head()
        if tag == "br":
            self.parts.append(" ")
        if tag in BLOCK:
            self.flush()
            self._close(frozenset(("p", *HEADING)) if tag != "hr" else frozenset(("p",)), SCOPE | {"button"})
            if tag in CLOSED_BY:
                self._close(CLOSED_BY[tag], SCOPE)
        if tag == "a":
            self._close(frozenset(("a",)), SCOPE | {"p", "li", "td"})
        if tag in VOID:
            return
        own = dict(attrs)
        entry = (tag, self._is_furniture(tag, own), "k" in own)
        self.open.append(entry)
        self._count(*entry, 1)
        self.has_article |= tag in ARTICLE

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)      # as browsers do: the slash says nothing

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if any(x[0] == tag for x in self.open):
            self._close(frozenset((tag,)), frozenset())

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and not data.isspace():
            self._end_head()
        if self.unseen:
            return
        self.parts.append(data)
        n = len(data.split())
        self.words += n
        self.linked += n if self.links else 0


def blocks_of(html: str) -> tuple[list[Block], bool]:
    """The blocks of a page, and whether it marks an article."""
    for source in (html, re.sub(r"<(?=!(?!--)|\?)", "&lt;", html)):
        parser = _Blocks()
        try:
            parser.feed(source)
            parser.close()
        except AssertionError:         # a declaration that the parser gives up on
            continue
        parser.flush()
        return parser.blocks, parser.has_article
    return [], False


def features(blocks: list[Block], has_article: bool) -> np.ndarray:
    """[blocks, FEATURES]; a page begins and ends with a block without words."""
    words = np.array([0, *(min(b.words, 1000) for b in blocks), 0], float)
    density = np.array([0, *(b.density for b in blocks), 0], float)
    marks = np.array([(b.furniture, b.in_article, has_article, b.heading) for b in blocks], float).reshape(-1, 4)
    n = len(blocks)
    near = [x[k:k + n] for k in (1, 0, 2) for x in (words, density)]
    return np.column_stack([marks, *near])


class Node(NamedTuple):
    """A test ``feature <= limit``, or a leaf (feature -1) whose ``keep`` is the answer."""

    feature: int
    limit: float
    below: int
    above: int
    keep: bool


def train(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 20) -> list[Node]:
    """A binary decision tree by Gini impurity; of equal splits the first feature and limit win."""
    nodes: list[Node] = []

    def grow(rows: np.ndarray, level: int) -> int:
        at = len(nodes)
        kept = y[rows].mean()
        nodes.append(Node(-1, 0.0, 0, 0, bool(kept >= 0.5)))
        if level == 0 or kept in (0, 1) or len(rows) < 2 * least:
            return at
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            for limit in (values[:-1] + values[1:]) / 2:
                below = x[rows, f] <= limit
                n, k = below.sum(), y[rows][below].sum()
                m, j = len(rows) - n, y[rows][~below].sum()
                if min(n, m) >= least:
                    impurity = n * (k / n) * (1 - k / n) + m * (j / m) * (1 - j / m)
                    if best is None or impurity < best[0] - 1e-12:
                        best = (impurity, f, limit, below)
        if best is None or best[0] >= len(rows) * kept * (1 - kept) - 1e-12:
            return at
        _, f, limit, below = best
        nodes[at] = Node(f, float(limit), grow(rows[below], level - 1), grow(rows[~below], level - 1), False)
        return at

    grow(np.arange(len(y)), depth)
    return nodes


def decide(tree: list[Node], x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), int)
    test = np.array([(n.feature, n.limit, n.below, n.above, n.keep) for n in tree], float)
    while True:
        own = test[at]
        inner = own[:, 0] >= 0
        if not inner.any():
            return own[:, 4] > 0
        value = x[np.arange(len(x)), np.maximum(own[:, 0], 0).astype(int)]
        at = np.where(inner, np.where(value <= own[:, 1], own[:, 2], own[:, 3]), at).astype(int)


def labelled_rows(copies: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages.

    Every page enters ``copies`` times, each time with some blocks left out and
    the others' numbers of words varied, widely where the page marks its article
    and a little elsewhere: what a marked article's lengths and neighbours
    happen to be teaches nothing.
    """
    rng = np.random.default_rng(7)
    x, y = [], []
    for page in LABELLED:
        blocks, has_article = blocks_of(page)
        for _ in range(copies):
            scale = np.exp(rng.normal(0, 1.5 if has_article else 0.15, len(blocks)))
            stay = rng.random(len(blocks)) < np.where([b.label for b in blocks], 0.9, 0.6)
            varied = [b._replace(words=max(1, round(b.words * s)))
                      for b, s, there in zip(blocks, scale, stay, strict=True) if there]
            x.append(features(varied, has_article))
            y += [b.label for b in varied]
    return np.concatenate(x), np.array(y, float)


@functools.lru_cache(maxsize=1)
def trained() -> list[Node]:
    """The tree of the labelled pages."""
    return train(*labelled_rows())


def main_text(html: str | None, tree: list[Node]) -> str:
    blocks, has_article = blocks_of(html or "")
    if not blocks:
        return ""
    keep = decide(tree, features(blocks, has_article))
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of ``pages``."""
    schema = T.StructType([T.StructField("page_id", pages.schema["page_id"].dataType),
                           T.StructField("url", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    tree = trained()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at:at + 500]
                texts = [main_text(h if isinstance(h, str) else None, tree) for h in part["html"]]
                yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"],
                                    "text": pd.Series(texts, part.index, object), "n_chars": [len(t) for t in texts]})

    return map_frames(pages.select("page_id", "url", "html"), run, schema)
