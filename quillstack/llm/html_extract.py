"""HTML extraction: the main text of a page from parser events.

The standard library's parser streams events; block elements cut the page into
lines. Each line has a text-to-tag ratio; ratios are smoothed with a Gaussian,
and their logarithms are split into two clusters by a threshold, content and the
rest. Elements whose class or id has a word of boilerplate are judged by it: they
stay if their mean ratio is of the content cluster, for a tenth of their ratio
where the word leaves little doubt. The content region is the article or main
elements with lines of the content cluster, if these hold most of its text, else
the deepest element that holds all such lines. All lines of the region are the
article, but for elements that are by tag or role not part of it, and those that
were judged to be boilerplate. Reader comments go whatever their ratio: those in
a list or section of comments, those with a sibling of their kind, and those
that are signed. A doubtful word says nothing of a paragraph within an article,
and more of an element whose own text speaks of cookies and the like.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - {"html", "body", "title", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend", "summary"}
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form frame frameset head iframe input label map menu nav noembed noframes"
    " noscript object option optgroup picture progress script search select style svg template textarea title video".split()
)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
#: Words of class and id attributes that name boilerplate: those that leave little doubt, and others.
SURE = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored cookie cookies consent gdpr paywall sidebar menu navbar nav navigation breadcrumb"
    " breadcrumbs pagination pager footer masthead topbar comments commentlist respond disqus newsletter subscribe signup popup modal".split()
)
DOUBTFUL = frozenset(
    "banner promo promotion promoted notice notices disclaimer comment replies discussion share sharing social related recommended overlay skip widget login search tags toc toolbar".split()
)
#: Words that even a paragraph of an article isn't named by, those that sign a comment, and those of a notice's text.
FOREIGN = frozenset("ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored cookie cookies consent gdpr paywall newsletter subscribe signup".split())
SIGNED = frozenset("author byline avatar username user reply date time timestamp posted".split())
NOTICE = re.compile(r"\b(?:cookies?|gdpr|newsletter|advertisement|advertorial|sponsored|adblock(?:er)?|subscribe|privacy policy)\b", re.I)
#: Parts of a name that make `comment` a list or section of comments, parts that end a name written as one word, and states of a page.
LISTS = "list|section|area|thread|box|block|wrap|wrapper|container|feed|holder|panel|widget|template"
ENDS = "bar|left|right|top|bottom|notice|banner|overlay|form|" + LISTS
COMMENTS = re.compile(rf"[a-z]*comments(?:{LISTS})?|comment(?:{LISTS})")
GLUED = re.compile("|".join(rf"[a-z]*{w}|{w}(?:{ENDS})" for w in sorted(SURE) if len(w) >= 6 and w != "comments"))
STATES = frozenset("open closed on off enabled disabled count link number".split())
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
NAME = re.compile(r"(?:(has|with|no)[-_])?([a-z]+)", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Elements below which a region doesn't begin.
LEAVES = HEADINGS | {"p", "pre", "li", "td", "th", "dd", "dt", "blockquote"}
#: What counts of the ratio of reader comments, of elements named as boilerplate, and of those that may be.
COMMENT, NAMED, DOUBT = 1e-9, 0.1, 1.0


class _Node:
    __slots__ = ("tag", "parent", "number", "skip", "article", "doubt", "judged", "comment", "signed", "comments", "titled")

    def __init__(self, tag: str, parent: _Node | None, number: int, skip: bool, article: bool, doubt: float):
        self.tag, self.parent, self.number, self.skip, self.article = tag, parent, number, skip, article
        self.doubt = doubt  # 0, or the share of its ratio that counts
        self.judged: _Node | None = self if doubt else parent.judged if parent else None  # the nearest element to be judged
        self.comment = self.signed = self.titled = False  # named as one comment; holds a signature; holds the page's heading
        self.comments = 0  # children that are named as comments


class _Line:
    __slots__ = ("parts", "node", "tags", "linked", "text")

    def __init__(self, node: _Node):
        self.parts, self.node, self.tags, self.linked = [], node, 0, 0


def named(value: str, leaf: bool = False) -> tuple[float, bool, bool]:
    """How much of its ratio counts for an element with such a class or id (0 if the name says nothing), whether it is one comment, and a signature.

    leaf: a paragraph of an article or something in one.
    """
    doubt, comment, signs = 0.0, False, False
    for token in HUMP.sub("-", value).split():
        words = {m[2].lower() for m in NAME.finditer(token) if not m[1]}
        signs |= not words.isdisjoint(SIGNED)
        said = any(COMMENTS.fullmatch(w) for w in words) or ("comment" in words and not words.isdisjoint(LISTS.split("|")))
        if leaf:
            own = NAMED if words & FOREIGN else 0.0
        elif said and not words & STATES:
            return COMMENT, False, signs
        elif "comment" in words and not words & STATES:
            comment, own = True, DOUBT
        elif words & (SURE - {"comments"}) or any(GLUED.fullmatch(w) for w in words):
            own = NAMED
        else:
            own = DOUBT if words & (DOUBTFUL - {"comment"}) else 0.0
        doubt = min(doubt or own, own or doubt)
    return doubt, comment, signs


class LineParser(HTMLParser):
    """Collects lines (text between block boundaries) with their tags and element.

    Depths of open elements are kept by tag, so an end tag finds its element, or that it has none, without a search.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [_Node("", None, 0, False, False, 0.0)]  # parents before their children
        self.stack = self.nodes[:]
        self.open: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.lines: list[_Line] = []
        self.line: _Line | None = None

    def _skips(self, tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
        """Whether the element's tag, role or state says that it isn't part of an article."""
        if tag in DROPPED or (tag == "header" and not inside):  # an article's own header holds its heading
            return True
        for k, v in attrs:
            v = v or ""
            if k == "hidden" or tag not in ("html", "body", "main", "article") and (
                (k == "aria-hidden" and v == "true") or (k == "role" and v.lower() in ROLES) or (k == "style" and HIDDEN.search(v))
            ):
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag in ("br", "wbr") and self.line is not None:
                self.line.tags += 1
                self.line.parts.append("\n" if tag == "br" else "")
            elif tag == "hr":
                self.line = None
            return
        closed = CLOSED_BY.get(tag)
        if closed is None and tag in CLOSES_P:
            closed = CLOSED_BY["p"]
        if closed:  # by the rules of HTML it ends an open element, if that is the innermost block
            while self.blocks and self.stack[self.blocks[-1]].tag in closed:
                self._pop(self.blocks[-1])
                if tag != "tr":
                    break
        if tag in BLOCK:
            self.line = None
        elif self.line is not None:
            self.line.tags += 1
        above = self.stack[-1]
        skip = above.skip or self._skips(tag, attrs, above.article)
        doubt, comment, signs = 0.0, False, tag == "time"
        if not skip and tag not in HEADINGS and (tag not in ("html", "body", "main", "article") or above.article):
            names = " ".join(v for k, v in attrs if k in ("class", "id") and v)
            if names:
                doubt, comment, signed = named(names, above.article and (tag in LEAVES or tag not in BLOCK))
                signs |= signed
                if not doubt and not above.article and "header" in names.lower().replace("-", " ").replace("_", " ").split():
                    doubt = DOUBT
        node = _Node(tag, above, len(self.nodes), skip, above.article or tag in ("article", "main"), doubt)
        self.nodes.append(node)
        if comment:
            node.comment = True
            above.comments += 1
        if signs and above.judged is not None:
            above.judged.signed = True
        if tag == "h1" and above.judged is not None:
            above.judged.titled = True
        self.open.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def _pop(self, depth: int) -> None:
        """Ends the open element at that depth, and those in it."""
        while len(self.stack) > depth:
            tag = self.stack.pop().tag
            self.open[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
                self.line = None

    def handle_endtag(self, tag: str) -> None:
        found = self.open.get(tag)
        if not found:
            if tag in BLOCK:
                self.line = None
        elif tag in BLOCK or not self.blocks or found[-1] > self.blocks[-1]:  # a stray inline end doesn't close blocks
            self._pop(found[-1])
            if tag not in BLOCK and self.line is not None:
                self.line.tags += 1

    def handle_data(self, data: str) -> None:
        node = self.stack[-1]
        if node.skip or (self.line is None and not data.strip()):
            return
        if self.line is None:
            self.line = _Line(node)
            self.lines.append(self.line)
        self.line.parts.append(data)
        if self.open.get("a"):
            self.line.linked += len(data)


def lines_of(html: str) -> tuple[list[_Line], list[_Node]]:
    """(lines with text, elements)"""
    parser = LineParser()
    parser.feed(html)
    parser.close()
    for line in parser.lines:
        line.text = " ".join("".join(line.parts).split())
    return [x for x in parser.lines if x.text], parser.nodes


def smooth(values: list[float], sigma: float) -> list[float]:
    """Gaussian smoothing; the weights of a window are scaled to one at the ends."""
    reach = max(1, math.ceil(2 * sigma))
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        w = weights[low - i + reach : high - i + reach]
        out.append(sum(a * b for a, b in zip(w, values[low:high], strict=True)) / sum(w))
    return out


def two_means(values: list[float], apart: float = 1.0) -> float:
    """The threshold between two clusters of values; if their means aren't so far apart they are one, and it lies below its mean."""
    low, high = min(values), max(values)
    for _ in range(50):
        cut = (low + high) / 2
        a, b = [v for v in values if v < cut], [v for v in values if v >= cut]
        new = (sum(a) / len(a) if a else low, sum(b) / len(b) if b else high)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high - low >= apart else sum(values) / len(values) - apart


def boilerplate(lines: list[_Line], ratios: list[float], cut: float, linked: float) -> set[_Node]:
    """The elements to be judged that are boilerplate: of a lower mean ratio than the cut, or mostly links, or in such a one."""
    sums: dict[_Node, list[float]] = {}
    notices: set[_Node] = set()
    for x, r in zip(lines, ratios, strict=True):
        if x.node.judged is not None:
            s = sums.setdefault(x.node.judged, [0.0, 0, 0])
            s[0] += r * len(x.text)
            s[1] += len(x.text)
            s[2] += x.linked
            if x.node.judged.doubt == DOUBT and NOTICE.search(x.text):
                notices.add(x.node.judged)
    # sums of inner elements go to the outer ones, children before their parents
    todo = sorted(sums, key=lambda n: n.number)
    for node in list(todo):
        outer = node.parent.judged
        while outer is not None and outer not in sums:
            sums[outer] = [0.0, 0, 0]
            todo.append(outer)
            outer = outer.parent.judged
    todo.sort(key=lambda n: n.number)
    for node in reversed(todo):
        outer = node.parent.judged
        if outer is not None:
            sums[outer] = [a + b for a, b in zip(sums[outer], sums[node], strict=True)]
    out: set[_Node] = set()
    for node in todo:
        weighted, size, links = sums[node]
        counts = node.doubt
        if node.comment and (node.parent.comments > 1 or node.signed):
            counts = COMMENT
        elif node in notices:
            counts = NAMED
        if counts == COMMENT and node.titled:  # the page's heading is no comment: the name is that of the whole page
            counts = DOUBT
        if node.parent.judged in out or math.log1p(counts * weighted / size) < cut or links >= linked * size:
            out.add(node)
    return out


def region(nodes: list[_Node], seeds: list[_Line]) -> _Node:
    """The deepest element that holds all seeds; article, main, paragraphs, headings and the like aren't entered."""
    held = [0] * len(nodes)
    for x in seeds:
        held[x.node.number] += 1
    for node in reversed(nodes[1:]):
        held[node.parent.number] += held[node.number]
    root = chain = nodes[0]
    for node in nodes[1:]:  # those that hold all are a chain, from the outermost on
        if node.parent is chain and held[node.number] == len(seeds):
            if node.tag in LEAVES:
                break
            chain = node
            if node.tag in BLOCK:
                root = node
            if node.tag in ("article", "main"):
                break
    return root


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.7, linked: float = 0.6) -> str:
    """The article's text, blocks joined by a newline; empty for null, empty or boilerplate-only pages."""
    if not html:
        return ""
    lines, nodes = lines_of(html)
    if not lines:
        return ""
    own = [len(x.text) / (1 + x.tags) for x in lines]
    ratios = smooth(own, sigma)
    cut = two_means([math.log1p(r) for r in ratios])
    out = boilerplate(lines, own, cut, linked)
    left = [(x, r) for x, r in zip(lines, ratios, strict=True) if x.node.judged not in out]
    seeds = [x for x, r in left if math.log1p(r) >= cut and x.linked < linked * len(x.text)] or [x for x, _ in left]
    if not seeds:
        return ""
    marked = [x for x in seeds if x.node.article]
    whole = sum(len(x.text) for x in marked) >= share * sum(len(x.text) for x in seeds)  # the page marks its articles
    roots = set()
    if whole:
        for x in marked:  # the outermost of each line
            node = x.node
            while node.parent.article:
                node = node.parent
            roots.add(node)
    else:
        roots.add(region(nodes, seeds))
    inside = [node in roots for node in nodes]
    for node in nodes[1:]:
        inside[node.number] |= inside[node.parent.number]
    # outside articles no element marks lists of links
    kept = [x for x, r in left if inside[x.node.number] and (x.node.article or math.log1p(r) >= cut or x.linked < linked * len(x.text))]
    return "\n".join(x.text for x in kept)


@F.pandas_udf(StringType())
def main_text_udf(html: pd.Series) -> pd.Series:
    return html.map(main_text)


def extract(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with `text`, the page's main text, and `n_chars`.

    A row per row of pages: null or empty html gives an empty text, repeated
    rows give repeated results; other columns, null or not, are left out. It is
    a narrow map over the scan; memory is bounded by an Arrow batch.
    """
    return pages.select("page_id", "url", main_text_udf("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
