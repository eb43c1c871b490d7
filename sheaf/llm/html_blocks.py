"""Operator 4, main-text extraction: flat text blocks and a decision tree.

A page is cut into flat blocks at block-level tags. A block's features are its words and link
density, those of the blocks before and after it, and marks of where it stands: inside an
article, inside navigation or other page furniture (by tag, role, or words in class and id), a heading, a
list item. A CART decision tree, fitted when the query starts on the small labelled pages below, keeps
or drops each block; what it keeps is joined in page order.

Pages are independent, so extraction is one pass without a shuffle, a page at a time.

Defined results: a null or empty page, or one without a kept block, has empty text; unclosed tags,
truncated pages and stray end tags are read as browsers do, without error; rows that repeat are
each extracted; null page_id and url are passed on; other columns are not looked at.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import ship

#: HTML elements by role.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary
table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("""applet audio button canvas datalist head iframe map math noframes noscript object option
script select style svg template textarea title video""".split())
RAW = frozenset("script style textarea title iframe noframes noscript xmp template svg".split())
FURNITURE = frozenset("nav footer aside form menu dialog header".split())
ARTICLE = frozenset("article main".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alert menu menubar
alertdialog toolbar status""".split())
#: Words in class and id that mark furniture, and those that mark the article.
FURNITURE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs
bottombar byline captcha comment commentlist comments consent cookie cookies copyright credits cta dialog discussion
disqus disclaimer dropdown feedback footer form gdpr header infobar legal login masthead menu menubar meta modal nav
navbar navigation navlinks newsletter notice notification notifications outbrain overlay pager pagination paywall popup
promo promoted promotion recommended recommendations related reply replies respond responses rss share sharing
shoutbox sidebar signup sitemap skip social sponsor sponsored sponsors subscribe subscription taboola tags teaser
toolbar toolbox topbar topnav trending user-comments warning widget widgets""".split())
COMMENT_WORDS = frozenset("""comment comments commentlist discussion disqus reply replies respond responses
reviews user-comments""".split())
ARTICLE_WORDS = frozenset("""article articlebody body-text content entry entry-content main maincontent main-content
post postbody post-content story storybody text""".split())

#: A comment, a declaration or a tag, as browsers end them: an empty comment ends at once, a quote counts only
#: right after an equals sign, an unquoted value runs to white space or the tag's end.
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s\"'>][^\s>]*|(?=>)|\Z))*)"
                    r"(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)*")
_SPACE = re.compile(r"\s+")
#: Elements that an opening tag of the same group closes.
_CLOSES = {"li": ("li",), "p": ("p",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
PLAIN, IN_ARTICLE, IN_FURNITURE, IN_COMMENTS = 0, 1, 2, 3


def _standing(tag: str, attrs: str, above: int) -> int:
    """Where the inside of an element stands, from its tag and attributes and where it is itself."""
    if above == IN_COMMENTS:
        return above
    seen = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTR.findall(attrs)} if attrs.strip() else {}
    names, parts = set(), set()
    for key in ("class", "id"):
        for name in seen.get(key, "").replace("_", "-").split():
            name = re.sub(r"\d+", "", name).strip("-")
            names.add(name)
            if not name.startswith(("has-", "no-", "with-")):
                parts.update(name.split("-"))
    if "hidden" in seen or seen.get("aria-hidden") == "true" or "display:none" in seen.get("style", "").replace(" ", ""):
        return IN_FURNITURE
    if (names | parts) & COMMENT_WORDS:
        return IN_COMMENTS
    if tag in ARTICLE or seen.get("role") in ("main", "article"):
        return IN_ARTICLE
    if tag in ("body", "html"):
        return above
    if tag == "header" and above == IN_ARTICLE:
        return above  # an article's own heading
    if tag in FURNITURE or seen.get("role") in ROLES or names & FURNITURE_WORDS:
        return IN_FURNITURE
    article = IN_ARTICLE if above == PLAIN else above
    if names & ARTICLE_WORDS:
        return article
    if parts & FURNITURE_WORDS and not (parts & ARTICLE_WORDS and parts & FURNITURE_WORDS == {"header"}):
        return IN_FURNITURE
    return article if parts & ARTICLE_WORDS else above


class Block:
    __slots__ = ("text", "words", "linked", "place", "heading", "item")

    def __init__(self, text: str, linked: int, place: int, heading: bool, item: bool):
        self.text, self.words, self.linked = text, len(text.split()), linked
        self.place, self.heading, self.item = place, heading, item


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, outside elements that show no text."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # tag, place above it, hidden elements above it
    place, hidden, links, pos = PLAIN, 0, 0, 0
    text: list[str] = []
    linked: list[str] = []
    opened: Counter[str] = Counter()

    def flush() -> None:
        if text:
            joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if joined:
                out.append(Block(joined, len(" ".join(linked).split()), place, any(opened[t] for t in HEADING),
                                 opened["li"] > 0))
            text.clear()
            linked.clear()

    def add(piece: str) -> None:
        if piece and not hidden:
            text.append(piece)
            if links:
                linked.append(piece)

    def close(at: int) -> None:
        nonlocal place, hidden, links
        while len(stack) > at:
            tag, place, hidden = stack.pop()
            opened[tag] -= 1
            if tag == "a":
                links -= 1

    n = len(page)
    while pos < n:
        m = _TOKEN.search(page, pos)
        if m is None:
            add(page[pos:])
            break
        add(page[pos:m.start()])
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            flush()
        if m[1]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    close(at)
                    break
            continue
        if tag == "br":
            add(" ")
        if tag in VOID:
            continue
        group = _CLOSES.get(tag)
        if group:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in group:
                    close(at)
                    break
                if stack[at][0] in BLOCK and stack[at][0] != "p":
                    break
        elif tag in BLOCK and opened["p"]:
            close(max(i for i, s in enumerate(stack) if s[0] == "p"))
        elif tag == "a" and links:
            close(max(i for i, s in enumerate(stack) if s[0] == "a"))
        if tag in ("body", "article", "main") and hidden and opened["head"]:
            close(min(i for i, s in enumerate(stack) if s[0] == "head"))
        if tag == "svg" and m[3].rstrip().endswith("/"):  # foreign content: an empty element
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        if m[3].rstrip().endswith("/") and tag not in BLOCK:
            continue
        stack.append((tag, place, hidden))
        opened[tag] += 1
        hidden += tag in HIDDEN
        links += tag == "a"
        if tag in BLOCK or tag in ("span", "ins"):
            place = _standing(tag, m[3], place)
    flush()
    return out


FEATURES = ("article", "furniture", "heading", "item", "words", "links", "words_before", "links_before",
            "words_after", "links_after", "page_has_article")


def features(page: list[Block]) -> np.ndarray:
    """One row per block (see ``FEATURES``)."""
    n = len(page)
    words = np.array([b.words for b in page], float)
    links = np.array([b.linked / max(1, b.words) for b in page], float)
    pad = lambda x: np.concatenate([[0.0], x, [0.0]])
    w, k = pad(words), pad(links)
    own = np.array([b.place == IN_ARTICLE for b in page], float)
    return np.column_stack([
        own, np.array([b.place in (IN_FURNITURE, IN_COMMENTS) for b in page], float),
        np.array([b.heading for b in page], float), np.array([b.item for b in page], float),
        words, links, w[:n], k[:n], w[2:], k[2:], np.full(n, own.max(initial=0))])


class Tree:
    """A CART classifier with Gini splits, over a small table."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1):
        self.nodes: list[tuple[int, float, int, int, bool]] = []
        self._grow(x, y, depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, 0.0, -1, -1, bool(y.mean() >= 0.5)))
        if depth == 0 or y.all() or not y.any():
            return at
        best = (1e-9, -1, 0.0)
        gini = lambda v: len(v) * 2 * v.mean() * (1 - v.mean()) if len(v) else 0.0
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                if least <= left.sum() <= len(y) - least:
                    gain = gini(y) - gini(y[left]) - gini(y[~left])
                    if gain > best[0] + 1e-12:
                        best = (gain, f, float(cut))
        if best[1] >= 0:
            _, f, cut = best
            left = x[:, f] <= cut
            a = self._grow(x[left], y[left], depth - 1, least)
            b = self._grow(x[~left], y[~left], depth - 1, least)
            self.nodes[at] = (f, cut, a, b, False)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            f, cut, a, b, keep = self.nodes[node]
            if f < 0:
                out[rows] = keep
            else:
                left = x[rows, f] <= cut
                todo += [(a, rows[left]), (b, rows[~left])]
        return out


_LONG = ("The council met on Tuesday to discuss the new bridge over the river and heard from engineers, "
         "residents and two members of the planning board before it voted to go ahead with the work.")
_ITEM = "Ten things to know about the new bridge over the river"
_MID = "Work on the foundations will start in the spring and take about a year."
#: The labelled table: small pages; a block whose text starts with * is main text (the star is
#: stripped, and is not part of any feature).
LABELLED = (
    f"<nav><ul><li><a>Home</a><li><a>News</a><li><a>About us</a></ul></nav><div class=ad>{_LONG}</div><article><h1>*A new "
    f"bridge</h1><p>*{_LONG}<p>*{_MID}<p>*Yes.<p>*{_LONG}</article><footer>Copyright by the paper. {_MID}</footer>",
    f"<header><a>Logo</a><p>{_MID}</header><main><h2>*Bridge</h2><p>*{_MID}<p>*No.<ul><li>*One pillar<li>*Two arches</ul>"
    f"<p>*{_LONG}<p>*<a>See the full plan of the bridge</a></main><aside><h3>Related</h3><p>{_LONG}</aside><div class=comments>"
    f"<p>{_LONG}<p>Great!</div><form><p>Your name</form>",
    f"<div class=cookie-notice><p>{_MID} {_MID}</div><div class=content><h1>*Bridge</h1><p>*{_LONG}<p>*Of.<p>*{_MID}</div>"
    f"<div class=sidebar><h2>Latest</h2><p>{_LONG}<ul><li><a>First story of the day</a><li><a>Second story</a></ul></div>"
    f"<div id=footer><p>{_LONG}</div>",
    f"<p><a>Home</a> <a>News</a> <a>Sport</a><p><a>Log in</a> or <a>sign up</a><h1>*A new bridge for the town</h1><p>*{_LONG}"
    f"<p>*{_MID} {_MID}<p>*{_LONG} <a>plan</a><p>*{_LONG}<p><a>More news</a> <a>Contact us</a> <a>Imprint</a><p>All rights reserved",
    f"<ul><li><a>Home</a><li><a>World</a><li><a>Business and markets</a></ul><div><p>*{_LONG}<p>*{_LONG}<p>*{_MID}<p>*{_LONG}</div>"
    f"<p><a>Privacy</a> <a>Terms</a><p>Contact",
    f"<article><p>*{_MID}<p>*{_MID}<p>*Thanks.<div class=share><a>Share</a> this page</div><p>*{_MID}<div class=promo><p>{_LONG}</div>"
    f"<p>*{_LONG}</article><section class=comments><h3>Comments</h3><p>{_LONG}</section>",
    "<article><p>*Of.<p>*She is.</article><footer>Imprint</footer>",
    "<nav><a>Home</a></nav><article><h1>*<a>Linked heading</a></h1><p>*<a>One link only</a></article>",
    f"<div><h1>*Short note</h1><p>*{_MID}</div><div class=footer>{_MID}</div>",
    "<article><h1>*<a>Linked heading</a></h1><p>*Of.<p>*She is.<p>*<a>A list of links</a><p>*Yes.<p>*<a>Two</a><p>*No, thanks.</article>",
    "<main><p>*<a>Chapter one</a><p>*Short text.<ul><li>*<a>Part two</a><li>*Short item</ul><p>*The end.</main><p><a>Top</a><p>End of page",
    # plain pages: what a block's neighbours hold decides
    f"<div><p>*{_LONG}<p>*He said no.<p>*{_LONG}<p>*{_MID}</div><ul><li><a>{_ITEM}</a><li><a>{_ITEM}</a></ul><p>Imprint",
    f"<div><h2>*Plan</h2><p>*{_LONG}<ul><li>*First point<li>*Second point of it</ul><p>*{_LONG}</div><p><a>Home</a><p>Contact us",
    f"<p>Sections<p><a>World</a><p>*{_LONG}<p>*They agreed.<p>*{_MID}<ul><li><a>{_ITEM}</a><li><a>More of this</a></ul><p>Share this",
    f"<ul><li><a>{_ITEM}</a><li><a>{_ITEM}</a><li><a>{_ITEM}</a></ul><p>*{_LONG}<p>*{_LONG}<p><a>{_ITEM}</a> today",
    f"<p>*{_LONG}", f"<div>*{_LONG} {_LONG}</div>", f"<table><tr><td><a>Menu</a><td>*{_LONG}<td><a>News</a></table>",
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of ``LABELLED``."""
    xs, ys = [], []
    for page in LABELLED:
        found = blocks(page)
        ys += [b.text.startswith("*") for b in found]
        xs.append(features(found))
    return np.vstack(xs), np.array(ys)


def extract(page: str | None, tree: Tree) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, tree.predict(features(found))) if keep)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points)."""
    ship(pages.sparkSession)
    tree = Tree(*labelled_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [extract(x.as_py(), tree) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
