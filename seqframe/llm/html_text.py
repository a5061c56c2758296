"""Main text of web pages by a tree-structured graphical model over the DOM.

Nodes are block elements and runs of text; each is content or not. A node's potential is
a linear function of its features (kind of element, words of class and id, whether an
ancestor is marked as boilerplate, length, share of links, sentence marks) and every parent-child edge has a 2 x 2 potential. Messages go
from the leaves to the root and back (sum-product), which gives each node's marginal;
text runs with a marginal of at least 0.5 are the text, in page order.

The model is trained by maximum likelihood on pages that mark their main text with <article> or
<main>: what is inside the marks is content. Pages with something inside the marks that is named as boilerplate are left out.
Three views of the pages are learnt from: with all names and marks, with the marks hidden, and with marks and all names
that tell boilerplate or content (elements, classes, ids) hidden, so that lengths, links, sentences
and places get weights of their own. In some pages blocks from outside the marks are put between paragraphs of the
main text, as pages in the wild have them. Pages with and without (visible) marks have weights of their own. A weak prior covers features that the pages don't show. The sample is
bounded by ``max_pages``.

Null and empty pages, and pages without content, have the empty text. Character
references are decoded, white space inside a block becomes one space, blocks are joined by
one newline. Broken and cut-off markup is read as far as it goes. Input columns with the
name of an output column are replaced.
"""

from __future__ import annotations

import html
import re
from math import exp, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import add_columns, field, quoted

_NAMED = re.compile(r"\b(?:class|id|role|aria-label|itemprop|name|data-[\w-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body div p article main section nav header footer aside h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th"
    " blockquote pre figure figcaption form fieldset legend address details summary dialog menu hgroup center button select option optgroup"
    " textarea label noscript head hr search x-graft".split()
)
BOILER_TAGS = frozenset("nav header footer aside form fieldset legend dialog menu button select option optgroup textarea label noscript head search".split())
CONTENT_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol li dl dt dd".split())
# Words of class and id names.
BOILER_WORDS = frozenset(
    "nav navbar navigation menu menubar submenu header masthead topbar toolbar footer foot sidebar side aside rail widget widgets ad ads adv advert adverts"
    " advertisement advertising adsense adslot sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices alert alerts"
    " notification popup popover modal overlay dialog newsletter subscribe subscription signup signin login register search form comment comments commentlist"
    " reply replies respond responses discussion disqus reader feedback share sharing social follow related recommend recommended recommendations more popular"
    " trending latest tags tagcloud breadcrumb breadcrumbs pagination pager copyright legal disclaimer skip toc outbrain taboola paywall rating".split()
)
CONTENT_WORDS = frozenset("article content main post entry story body text prose copy hentry page".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "option": {"select"}}

#: What ends an element that isn't closed and doesn't show what it holds: the next tag of a block or of running text.
_ENDS = r"</?(?:" + "|".join(sorted(BLOCK | set("span em strong b i u s small code sub sup img br".split()))) + r")(?=[\s/>])"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|xmp|noembed|noframes)\b.*?(?:</\1\s*>|\Z)"
    r"|<(svg|template|iframe|title)(?=[\s/>])(?:[^<>]*/>|(?:(?!<\2(?=[\s/>])).)*?</\2\s*>|(?:(?!" + _ENDS + r").)*)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][a-z0-9:-]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)

FEATURES = (
    "element", "boiler_tag", "content_tag", "paragraph", "heading", "list", "boiler_word", "content_word", "hidden", "links_some", "links_most", "long", "longer",
    "run", "run_links_some", "run_links_most", "run_short", "run_long", "run_longer", "run_sentence", "run_notice", "run_in_paragraph", "run_in_heading", "in_boiler",
    "run_after_heading", "run_in_list",
)
AT = {name: k for k, name in enumerate(FEATURES)}
#: Features that come from names of elements, classes and ids.
NAMED = [AT[name] for name in ("boiler_tag", "content_tag", "boiler_word", "content_word", "hidden", "in_boiler")]
NAMED_BOILER = [AT[name] for name in ("boiler_tag", "boiler_word", "hidden")]
#: Log potentials before training: weak, but for hidden elements.
PRIOR = {"boiler_tag": -2.0, "boiler_word": -2.0, "in_boiler": -2.0, "content_tag": 2.0, "content_word": 0.5, "hidden": -6.0, "links_most": -1.0, "run_links_most": -1.0, "run_long": 0.5, "run_notice": -1.0}
#: Parent-child log potentials before training (parent not content -> child content, content -> not, content -> content); the fourth is 0.
EDGES = (-1.0, -1.0, 0.5)
_NOTICE = re.compile(r"\s*(?:©|\(c\)|copyright\b)", re.IGNORECASE)

_names: dict[str, tuple[bool, bool, bool]] = {}


def _named(attributes: str) -> tuple[bool, bool, bool]:
    """Whether class, id and the like have words of boilerplate, of content, and whether the element is hidden."""
    if not attributes or attributes.isspace():
        return False, False, False
    known = _names.get(attributes)
    if known is None:
        words = {w.lower() for v in _NAMED.findall(attributes) for w in _WORD.findall(v)}
        known = (bool(words & BOILER_WORDS), bool(words & CONTENT_WORDS), bool(_HIDDEN.search(attributes)))
        if len(_names) > 50_000:
            _names.clear()
        _names[attributes] = known
    return known


class Page:
    """Block elements and text runs of one page, in page order; parents come before children."""

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["html"]
        self.look: list[tuple[bool, bool, bool]] = [(False, False, False)]
        self.text: list[str | None] = [None]
        self.size: list[int] = [0]
        self.linked: list[int] = [0]
        self._stack = [0]
        self._parts: list[str] = []
        self._links = 0
        self._in_link = False
        at = 0
        for match in _TAG.finditer(source):
            if match.start() > at:
                self._data(source[at : match.start()])
            at = match.end()
            name = match[4] or match[7]
            if name:
                name = name.lower()
                if match[3] or match[6]:
                    self._close(name)
                else:
                    self._open(name, match[5] or match[8] or "")
        if at < len(source):
            self._data(source[at:])
        self._flush()
        for k in range(len(self.parent) - 1, 0, -1):
            self.size[self.parent[k]] += self.size[k]
            self.linked[self.parent[k]] += self.linked[k]

    def _data(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self._parts.append(text)
        if self._in_link:
            self._links += len(text.strip())

    def _node(self, tag: str, look: tuple[bool, bool, bool], text: str | None, size: int, linked: int) -> None:
        self.parent.append(self._stack[-1])
        self.tag.append(tag)
        self.look.append(look)
        self.text.append(text)
        self.size.append(size)
        self.linked.append(linked)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self._node("#text", (False, False, False), text, len(text), min(self._links, len(text)))
            self._parts, self._links = [], 0

    def _open(self, name: str, attributes: str) -> None:
        if name == "br":
            self._parts.append(" ")
            return
        if name == "a":
            self._in_link = True
            return
        if name not in BLOCK:
            return
        self._flush()
        self._in_link = False
        stack, tags = self._stack, self.tag
        if name in ("html", "body"):
            if name == "body":
                del stack[1:]
                self._node(name, _named(attributes), None, 0, 0)
                stack.append(len(tags) - 1)
            return
        if name in _CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]] in _SCOPES[name]:
                    break
                if tags[stack[k]] in _CLOSES[name]:
                    del stack[k:]
                    break
        elif tags[stack[-1]] == "p":
            stack.pop()
        if name == "hr":
            return
        self._node(name, _named(attributes), None, 0, 0)
        stack.append(len(tags) - 1)

    def _close(self, name: str) -> None:
        if name == "a":
            self._in_link = False
            return
        if name not in BLOCK or name in ("html", "body"):
            return
        self._flush()
        self._in_link = False
        for k in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[k]] == name:
                del self._stack[k:]
                break
            if self.tag[self._stack[k]] in ("article", "main", "body", "td", "table") and name in ("p", "li", "span"):
                break

    def features(self, hide: str = "") -> np.ndarray:
        """Features of all nodes; hide "marks" or all "names"."""
        out = np.zeros((len(self.tag), len(FEATURES)))
        boilers = [False] * len(self.tag)
        headed = False
        for k, tag in enumerate(self.tag):
            headed = headed or tag in HEADINGS
            row, n, links = out[k], self.size[k], self.linked[k]
            row[23] = k > 0 and boilers[self.parent[k]]
            boilers[k] = row[23] > 0 or tag in BOILER_TAGS or self.look[k][0] or self.look[k][2]
            if tag == "#text":
                text = self.text[k]
                row[13] = 1
                row[14], row[15] = 0 < links < 0.5 * n, links >= 0.5 * n
                row[16], row[17], row[18] = n < 25, n >= 80, n >= 250
                row[19] = text[-1] in ".!?…。\"'”»" and n >= 15
                row[20] = bool(_NOTICE.match(text))
                above = self.tag[self.parent[k]]
                row[21], row[22] = above in ("p", "blockquote", "pre"), above in HEADINGS
                row[24], row[25] = headed, above in LISTS
            else:
                boiler, content, hidden = self.look[k]
                row[0] = 1
                row[1], row[2] = tag in BOILER_TAGS, tag in CONTENT_TAGS
                row[3], row[4], row[5] = tag == "p", tag in HEADINGS, tag in LISTS
                row[6], row[7], row[8] = boiler, content and not boiler and tag != "body", hidden
                row[9], row[10] = 0 < links < 0.5 * n, n > 0 and links >= 0.5 * n
                row[11], row[12] = n >= 250, n >= 1000
        if hide:
            out[:, NAMED if hide == "names" else [AT["content_tag"]]] = 0
        return out

    def labels(self) -> np.ndarray:
        """1 for nodes in an <article> or <main> element that have text, but for grafts."""
        inside = np.zeros(len(self.tag), bool)
        for k in range(1, len(self.tag)):
            inside[k] = (inside[self.parent[k]] or self.tag[k] in CONTENT_TAGS) and self.tag[k] != "x-graft"
        out = np.zeros(len(self.tag))
        for k in range(len(self.tag) - 1, 0, -1):
            if self.text[k] is not None:
                out[k] = inside[k]
            if out[k] and inside[self.parent[k]]:
                out[self.parent[k]] = 1
        return out


_MARKED = re.compile(r"<(article|main)\b[^>]*>.*</\1\s*>", re.IGNORECASE | re.DOTALL)
_BODY = re.compile(r"<body\b[^>]*>|</body\b.*|</html\b.*", re.IGNORECASE | re.DOTALL)


def grafted(source: str, after: int) -> str:
    """The page with what stands before and after its main text put into that too, after the given paragraph."""
    main = _MARKED.search(source)
    if main is None:
        return source
    before = re.split(r"<body\b[^>]*>", source[: main.start()], flags=re.IGNORECASE)[-1]
    outer = before + _BODY.sub("", source[main.end() :])
    places = [m.end() for m in re.finditer(r"</p\s*>", main[0], re.IGNORECASE)]
    if not places:
        return source
    at = main.start() + places[min(after, len(places) - 1)]
    return f"{source[:at]}<x-graft>{outer}</x-graft>{source[at:]}"


def _or(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + log1p(exp(b - a)) if a >= b else b + log1p(exp(a - b))


def marginals(parent: list[int], unary: list[float], edges: tuple[float, float, float]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
    """Probability of content of each node, and of the four states of the edge to its parent.

    One pass from the leaves to the root, one back.
    """
    e01, e10, e11 = edges
    n = len(parent)
    off, on = [0.0] * n, list(unary)
    to_off, to_on = [0.0] * n, [0.0] * n
    for k in range(n - 1, 0, -1):
        to_off[k], to_on[k] = _or(off[k], e01 + on[k]), _or(e10 + off[k], e11 + on[k])
        off[parent[k]] += to_off[k]
        on[parent[k]] += to_on[k]
    out, pairs = [0.0] * n, [(0.0, 0.0, 0.0, 0.0)] * n
    whole = _or(off[0], on[0])
    out[0] = exp(on[0] - whole)
    for k in range(1, n):
        p = parent[k]
        # the parent's belief without what this child told it
        down_off, down_on = off[p] - to_off[k], on[p] - to_on[k]
        four = (down_off + off[k], down_off + e01 + on[k], down_on + e10 + off[k], down_on + e11 + on[k])
        top = max(four)
        four = [exp(x - top) for x in four]
        total = sum(four)
        pairs[k] = tuple(x / total for x in four)
        out[k] = pairs[k][1] + pairs[k][3]
        # from here on this node's belief holds the message from above
        up_off, up_on = _or(down_off, down_on + e10), _or(down_off + e01, down_on + e11)
        off[k] += up_off
        on[k] += up_on
    return out, pairs


def train(pages: list[str], steps: int = 60, rate: float = 0.25, ridge: float = 0.002) -> np.ndarray:
    """(2, features + 3): weights and edge potentials for pages without and with marks; the prior where no page teaches."""
    cases: list[list] = [[], []]
    for k, source in enumerate(pages):
        page = Page(source)
        y = page.labels()
        if not y.any() or (y * page.features()[:, NAMED_BOILER].any(axis=1)).any():
            continue  # no marks, or something inside them that may be none of the main text
        if k % 2:
            page = Page(grafted(source, k % 5))
            y = page.labels()
        if y.any():
            x, parent = page.features(("", "marks", "names")[k % 3]), np.array(page.parent)
            above = y[parent[1:]]
            seen = np.array([((1 - above) * y[1:]).sum(), (above * (1 - y[1:])).sum(), (above * y[1:]).sum()])
            cases[marked(x)].append((x, page.parent, x.T @ y, seen))
    return np.array([_most_likely(c, steps, rate, ridge) for c in cases])


def marked(x: np.ndarray) -> int:
    """1 if the features show a content mark."""
    return int(x[:, AT["content_tag"]].any())


def _most_likely(cases: list, steps: int, rate: float, ridge: float) -> np.ndarray:
    """Weights of greatest likelihood, by Adam on exact expectations."""
    start = np.zeros(len(FEATURES) + 3)
    for name, value in PRIOR.items():
        start[AT[name]] = value
    start[-3:] = EDGES
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, steps + 1 if cases else 1):
        slope = -ridge * len(cases) * (w - start)
        for x, parent, seen_x, seen_e in cases:
            p, pairs = marginals(parent, (x @ w[:-3]).tolist(), tuple(w[-3:]))
            slope[:-3] += seen_x - x.T @ np.array(p)
            slope[-3:] += seen_e - np.array(pairs)[1:, 1:].sum(axis=0)
        slope /= len(cases)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def sample(pages: DataFrame, page_id: str = "page_id", source: str = "html", max_pages: int = 240, max_bytes: int = 1 << 20, seed: int = 3) -> DataFrame:
    """(id, html): the max_pages pages of least seeded hash among those of up to max_bytes that mark their main text, all if there are fewer."""
    html = F.col(quoted(source))
    marked = pages.select(F.col(quoted(page_id)).cast("string").alias("id"), html.alias("html")).filter(html.rlike("(?i)<(article|main)[\\s>]") & (F.octet_length(html) <= max_bytes))
    return marked.orderBy(F.xxhash64(F.lit(seed), "id"), F.xxhash64("html"), "html").limit(max_pages)


def fit(pages: DataFrame, page_id: str = "page_id", source: str = "html", max_pages: int = 240, max_bytes: int = 1 << 20, seed: int = 3) -> np.ndarray:
    """Train on the ``sample`` of pages, at most max_pages * max_bytes bytes whatever the size of the table."""
    few = sample(pages, page_id, source, max_pages, max_bytes, seed)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"w": [train(pdf.sort_values(["id", "html"])["html"].tolist()).reshape(-1).tolist()]})

    found = few.groupBy(F.lit(0).alias("g")).applyInPandas(one, "w array<double>").collect()
    return np.array(found[0]["w"]).reshape(2, -1) if found else train([])


def main_text(source: str, w: np.ndarray, hide: str = "") -> str:
    if not source:
        return ""
    page = Page(source)
    x = page.features(hide)
    own = w[marked(x)]
    p, _ = marginals(page.parent, (x @ own[:-3]).tolist(), tuple(own[-3:].tolist()))
    return "\n".join(t for t, x in zip(page.text, p, strict=True) if t is not None and x >= 0.5)


def extract(pages: DataFrame, weights: np.ndarray, source: str = "html", name: str = "text", drop_source: bool = False) -> DataFrame:
    """pages with the main text of each."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def make():
        w = shared.value
        return lambda sources: [pa.array([main_text(s, w) for s in sources.to_pylist()], pa.string())]

    return add_columns(pages, source, [field(name, "string")], make, drop_source)
