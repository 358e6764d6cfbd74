"""Main text of web pages by tree scoring.

Every paragraph-like block scores points for its length and its commas and passes
them to its container, half of them to the next ancestor and less to those above,
discounted by the share of its characters inside links. The container with the most
points, discounted again by its own link density, is the article; siblings that score
well or read like prose are kept with it. Parts that are no article by their element,
role or class (menus, footers, forms, adverts, comments and so on) never score and
never show.

The pass is narrow, one slice of pages in memory. A page is read whole, as a flat list
of elements in page order, so deep nesting costs no recursion.

Cases: a null or empty html, or a page without text, gives an empty text. Text
without any markup is its own article. Unclosed elements end where HTML ends them
(a paragraph at the next block, a script at the end of the page). Repeated rows give a
row each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.arrow import map_slices, texts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(
    r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""
)

# Elements of HTML by their role.
VOID = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = set("script style noscript template textarea title iframe noembed xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Elements that are no part of an article.
NOT_TEXT = set(
    "nav footer aside form button select datalist dialog menu object svg canvas audio "
    "video map head".split()
)
NOT_TEXT_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog form "
    "menu menubar toolbar".split()
)
#: Words of a class or id that name something else than the article.
NOT_TEXT_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb "
    "breadcrumbs comment comments consent cookie cookies copyright disclaimer "
    "discussion disqus footer form gdpr header hidden legal login masthead menu modal "
    "nav navbar navigation newsletter notice notices overlay pager pagination popup "
    "promo promotion recommendations recommended related replies respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar widget".split()
)
GOOD_WORDS = set(
    "article body content entry main page post story text blog hentry".split()
)
HAS_WORDS = set("has have no not with without".split())
TAG_POINTS = (
    {"article": 25, "main": 25, "div": 5, "section": 3, "pre": 3, "td": 3}
    | {"blockquote": 3, "address": -3}
)
#: A start tag ends open elements of these kinds, up to the nearest boundary.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
    "a": (("a",), ()),
}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PROSE = {"p", "pre", "blockquote"} | HEADINGS
#: Text in these passes to what holds the list or table.
PARTS = set("ul ol dl li dt dd table caption thead tbody tfoot tr td th".split())
COMMAS = re.compile(r"[,،、﹐︐，]")
SENTENCE_END = re.compile(r"[.!?。！？][\"'”’)\]]*$")

SHORT = 25
LEVELS = 5
LINKED_LIST = 0.5


class Page:
    """Elements and blocks of a page, in page order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.drop, self.good = ["#page"], [-1], [False], [0]
        #: owner, text, characters in links
        self.blocks: list[tuple[int, str, int]] = []
        self._open = [0]
        # For each open element the nearest one that owns text, and per tag the depths at
        # which it is open; nothing has to be looked for among the open elements.
        self._owner = [0]
        self._depths: defaultdict[str, list[int]] = defaultdict(list)
        self._block_depths = [0]
        self._runs: list[str] = []
        self._linked = 0
        self._read(html)

    def _flush(self) -> None:
        if self._runs:
            text = " ".join("".join(self._runs).split())
            if text:
                self.blocks.append((self._owner[-1], text, min(self._linked, len(text))))
            self._runs, self._linked = [], 0

    def _close(self, depth: int) -> None:
        """End the open elements from ``depth`` on."""
        if self._block_depths[-1] >= depth:
            self._flush()
        for i in self._open[depth:]:
            self._depths[self.tag[i]].pop()
        del self._open[depth:], self._owner[depth:]
        while self._block_depths[-1] >= depth:
            self._block_depths.pop()

    def _deepest(self, kinds) -> int:
        """The depth of the innermost open element of these kinds, 0 if there is none."""
        return max((self._depths[k][-1] for k in kinds if self._depths[k]), default=0)

    def _end_within(self, kinds, bounds) -> None:
        depth = self._deepest(kinds)
        if depth and depth >= self._deepest(bounds):
            self._close(depth)

    def _start(self, tag: str, attrs: str) -> None:
        if tag not in INLINE:
            self._flush()
            self._end_within(("p",), ("td", "th", "table", "button", "object"))
            if tag in HEADINGS:
                top = self.tag[self._open[-1]]
                if top in HEADINGS:
                    self._close(len(self._open) - 1)
        if tag in ENDS:
            self._end_within(*ENDS[tag])
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        drop, good = self._kind(tag, attrs)
        self.drop.append(drop)
        self.good.append(good)
        depth, here = len(self._open), len(self.tag) - 1
        self._open.append(here)
        self._owner.append(self._owner[-1] if tag in INLINE else here)
        self._depths[tag].append(depth)
        if tag not in INLINE:
            self._block_depths.append(depth)

    def _kind(self, tag: str, attrs: str) -> tuple[bool, int]:
        """Whether an element is no part of an article, and points for its class."""
        if tag in NOT_TEXT:
            return True, 0
        in_article = bool(self._depths["article"] or self._depths["main"])
        if tag == "header" and not in_article:
            return True, 0
        if not attrs or tag in ("html", "body"):
            return False, 0
        got = {
            m[1].lower(): (m[2] or m[3] or m[4] or "").lower()
            for m in ATTRIBUTE.finditer(attrs)
        }
        if "hidden" in got or got.get("aria-hidden") == "true":
            return True, 0
        if re.search(r"display\s*:\s*none", got.get("style", "")):
            return True, 0
        if got.get("role") in NOT_TEXT_ROLES:
            return True, 0
        good, bad = 0, False
        for name in f"{got.get('class', '')} {got.get('id', '')}".split():
            words = re.findall(r"[a-z]+", name)
            if words and words[0] in HAS_WORDS:
                continue
            named = NOT_TEXT_WORDS.intersection(words)
            if in_article:  # the header of an article belongs to it
                named.discard("header")
            bad = bad or bool(named)
            good += bool(GOOD_WORDS.intersection(words))
        if tag in ("article", "main"):
            bad = bad and "comment" in attrs.lower()
        return bad, 25 * bool(good)

    def _end(self, tag: str) -> None:
        depth = self._deepest((tag,))
        if not depth:
            return
        inside = ("td", "th", "table") if tag not in ("tr", "table", "tbody") else ()
        barrier = self._deepest(inside)
        if tag in INLINE:
            barrier = max(barrier, self._block_depths[-1])
        if depth >= barrier:
            self._close(depth)

    def _text(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self._runs.append(text)
            if self._depths["a"]:
                self._linked += len(" ".join(text.split()))

    def _read(self, html: str) -> None:
        at = 0
        while m := TOKEN.search(html, at):
            self._text(html[at : m.start()])
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                continue
            if name == "br":
                self._runs.append(" ")
            elif m["end"] or m["end2"]:
                if name not in INLINE:
                    self._flush()
                self._end(name)
            elif name in RAW:
                stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = stop.end() if stop else len(html)
            elif name in VOID:
                if name == "hr":
                    self._flush()
            elif name in ("html", "body"):
                self._close(1)
                self._start(name, "")
            else:
                self._start(name, m["attrs"] or m["attrs2"] or "")
        self._text(html[at:])
        self._close(1)
        self._flush()


def main_text(html: str) -> str:
    """The article's blocks joined by a space."""
    page = Page(html)
    n, parent, tag = len(page.tag), page.parent, page.tag

    # A part that holds an article, or the page's main heading, is no boilerplate.
    holds = [t in ("article", "main") for t in tag]
    for i in range(n - 1, 0, -1):
        holds[parent[i]] = holds[parent[i]] or holds[i]
    out = [False] * n
    for i in range(1, n):
        own = page.drop[i] and (tag[i] in NOT_TEXT or tag[i] == "article" or not holds[i])
        out[i] = out[parent[i]] or own

    size, linked = [0] * n, [0] * n
    for owner, text, link in page.blocks:
        if not out[owner]:
            size[owner] += len(text)
            linked[owner] += link
    for i in range(n - 1, 0, -1):
        size[parent[i]] += size[i]
        linked[parent[i]] += linked[i]
    for i in range(1, n):  # lists of links are menus
        menu = tag[i] in ("ul", "ol", "dl") and linked[i] > LINKED_LIST * size[i]
        out[i] = out[parent[i]] or out[i] or menu
    blocks = [b for b in page.blocks if not out[b[0]]]

    # The nearest element that scores, itself included: of a block, and further up.
    first, further = [-1] * n, [-1] * n
    for i in range(n):
        above = parent[i]
        part = tag[i] in PARTS
        first[i] = (first[above] if above >= 0 else -1) if part else i
        skip = part and tag[i] != "td"
        further[i] = (further[above] if above >= 0 else -1) if skip else i

    points: dict[int, float] = {}
    for owner, text, link in blocks:
        got = len(text) / SHORT
        if len(text) >= SHORT:
            got = 1 + len(COMMAS.findall(text)) + min(len(text) / 100, 3)
        got *= 1 - link / len(text)
        at = parent[owner] if tag[owner] in PROSE else owner
        at, level = first[at] if at >= 0 else -1, 0
        while at >= 0 and level < LEVELS:
            share = 1 if level == 0 else 2 if level == 1 else 3 * level
            if at not in points:
                points[at] = TAG_POINTS.get(tag[at], 0) + page.good[at]
            points[at] += got / share
            at = further[parent[at]] if parent[at] >= 0 else -1
            level += 1
    if not points:
        return ""
    score = {i: p * (1 - linked[i] / max(size[i], 1)) for i, p in points.items()}
    best = max(sorted(score), key=score.__getitem__)

    kept = {best}
    least = max(10.0, 0.2 * score[best])
    text_of = {o: t for o, t, _ in blocks}
    for i in range(1, n):
        if parent[i] == parent[best] and i != best and not out[i] and size[i]:
            density = linked[i] / size[i]
            prose = tag[i] in PROSE and (
                density < 0.25
                if size[i] > 80
                else not density and bool(SENTENCE_END.search(text_of.get(i, "")))
            )
            heading = tag[i] in ("h1", "h2") and not density
            if prose or heading or score.get(i, 0) >= least:
                kept.add(i)
    inside = [False] * n
    for i in range(n):
        inside[i] = i in kept or (i > 0 and inside[parent[i]])
    return " ".join(t for o, t, _ in blocks if inside[o])


def main_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and its ``n_chars`` of every page."""
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("text", pa.string()),
            ("n_chars", pa.int64()),
        ]
    )

    def make():
        def apply(part):
            found = [main_text(t) for t in texts(part, "html")]
            return pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                schema=schema,
            )

        return apply

    source = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.col(html).alias("html"),
    )
    return map_slices(
        source, make, "page_id long, url string, text string, n_chars long", "html"
    )
