"""HTML main text by tree scoring (operator 6)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?=>|\Z)|[^>]*)(?:>|\Z)",
                  re.S)
_ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp svg math object".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var wbr".split())
# Fixed lists: elements, roles and class or id words that mark what is not main text.
DROP_TAGS = set("head nav footer aside form button select dialog menu".split()) | RAW
DROP_ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
DROP_WORDS = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
                 "sidebar menu nav navbar navigation footer masthead breadcrumb breadcrumbs comment comments disqus "
                 "cookie cookies consent notice notices popup modal overlay newsletter subscribe signup share sharing "
                 "social related recommended widget pagination pager toolbar login search form disclaimer alert".split())
# Of these, words that content goes by as well: they don't take out an element that holds most of the page's text.
WEAK_WORDS = set("social related share sharing form search alert notice notices promotion promo banner menu signup login "
                 "toolbar disclaimer pager widget sponsor nav navigation".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}}
#: For these tags an open element of one of the tags ends the search for what they close.
NEAR = {tag: CLOSES[tag] | SCOPES.get(tag, set()) for tag in CLOSES}
PARAGRAPHS = set("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 div section article main body".split())
MAIN = {"article", "main"}
#: Shares of a paragraph's points under one in so many are not passed on.
FARTHEST = 1 << 40


class Node:
    __slots__ = ("tag", "attrs", "parent", "kids", "score", "size", "linked", "inside")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.kids: list[Node | str] = []
        self.score = 0.0
        self.size = self.linked = 0
        self.inside = parent is not None and (parent.inside or parent.tag in MAIN)  # of an article or main


class _Open:
    """The open elements: the innermost one, and by tag what an end tag or an implied end needs to know.

    Every question looks at one place, and an element is closed once, so pages
    of any depth and with any number of stray tags take linear time.
    """

    def __init__(self, root: Node):
        self.root = self.here = root
        self.tags: Counter = Counter()
        self.blocks = [root]
        self.inline = [Counter()]  # inline elements since each open block
        self.near: dict[str, list[Node]] = {tag: [] for tag in NEAR}

    def push(self, node: Node) -> None:
        self.here = node
        self.tags[node.tag] += 1
        if node.tag in INLINE:
            self.inline[-1][node.tag] += 1
        else:
            self.blocks.append(node)
            self.inline.append(Counter())
        for tag, among in NEAR.items():
            if node.tag in among:
                self.near[tag].append(node)

    def close(self, upto: Node) -> None:
        """Close ``upto`` and all inside it."""
        outer = upto.parent
        while self.here is not outer:
            node = self.here
            self.tags[node.tag] -= 1
            if node.tag in INLINE:
                self.inline[-1][node.tag] -= 1
            else:
                self.blocks.pop()
                self.inline.pop()
            for tag, among in NEAR.items():
                if node.tag in among:
                    self.near[tag].pop()
            self.here = node.parent

    def end(self, tag: str) -> None:
        """An end tag: nothing without such an element; an inline one does not reach out of a block."""
        if not (self.inline[-1] if tag in INLINE else self.tags)[tag]:
            return
        up = self.here
        while up.tag != tag:
            up = up.parent
        self.close(up)

    def before(self, tag: str) -> None:
        """Close what the start of ``tag`` ends: an open paragraph, the item, cell or row before."""
        if tag not in INLINE and tag not in VOID and self.blocks[-1].tag == "p":
            self.close(self.blocks[-1])
        if tag in CLOSES and self.near[tag] and self.near[tag][-1].tag in CLOSES[tag]:
            self.close(self.near[tag][-1])
            if tag == "tr" and self.here.tag == "tr":
                self.close(self.here)


def parse(html: str) -> Node:
    """The element tree; unclosed and stray tags are borne as browsers bear them, in the main."""
    root = Node("#root", "", None)
    at, tree = 0, _Open(root)
    while m := _TAG.search(html, at):
        if m.start() > at:
            tree.here.kids.append(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            tree.end(tag)
            continue
        tree.before(tag)
        node = Node(tag, m[3], tree.here)
        tree.here.kids.append(node)
        if tag in RAW:  # its content is no markup
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            if end is None:
                return root
            close = html.find(">", end.end())
            at = len(html) if close < 0 else close + 1
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            tree.push(node)
    tree.here.kids.append(html[at:])
    return root


def _unwanted(node: Node, whole: int) -> bool:
    """Whether the element is never main text; ``whole``: the page's characters of text, as ``size`` is the element's."""
    if node.tag in DROP_TAGS:
        return True
    if node.tag in MAIN or node.tag in ("body", "html"):
        return False
    if node.tag == "header":
        return not node.inside
    if not node.attrs.strip():
        return False
    for m in _ATTR.finditer(node.attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name in ("class", "id") and (found := DROP_WORDS & set(re.split(r"[^a-z]+", value))):
            if found - WEAK_WORDS or 2 * node.size <= whole:
                return True
        if (name == "role" and value in DROP_ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _prune(root: Node) -> list[Node]:
    """Take unwanted elements out; the remaining ones, parents first."""
    order = [root]
    for node in order:
        order += [k for k in node.kids if not isinstance(k, str) and k.tag not in DROP_TAGS]
    for node in reversed(order):
        node.size += sum(len(k.strip()) for k in node.kids if isinstance(k, str))
        if node.parent is not None:
            node.parent.size += node.size
    order = [root]
    for node in order:
        node.kids = [k for k in node.kids if isinstance(k, str) or not _unwanted(k, root.size)]
        order += [k for k in node.kids if not isinstance(k, str)]
    for node in order:
        node.size = 0
    return order


def _score(order: list[Node]) -> None:
    for node in reversed(order):  # children first
        own = 0
        commas = 0
        for k in node.kids:
            if isinstance(k, str):
                own += len(k.strip())
                commas += k.count(",")
            else:
                node.size += k.size
                node.linked += k.size if k.tag == "a" else k.linked
                if k.tag in INLINE:
                    own += k.size
                    commas += sum(x.count(",") for x in k.kids if isinstance(x, str))
        node.size += sum(len(k.strip()) for k in node.kids if isinstance(k, str))
        if node.tag in PARAGRAPHS and own >= 25:
            points = 1 + commas + min(own // 100, 3)
            points *= 1 - node.linked / max(node.size, 1)
            up, level = node.parent if node.tag not in ("div", "section", "article", "main", "body") else node, 1
            while up is not None and level <= FARTHEST:
                up.score += points / level
                up, level = up.parent, level + 1 if level == 1 else level * 2


def _text(node: Node, out: list[str]) -> None:
    """Text pieces in page order; block elements and breaks are set off by a blank."""
    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        block = x.tag not in INLINE
        if block:
            out.append(" ")
            stack.append(" ")
        stack.extend(reversed([unescape(k) if isinstance(k, str) else k for k in x.kids]))


def extract(html: str | None) -> str:
    """The main text of one page; empty for null, empty or textless pages."""
    if not html:
        return ""
    root = parse(html)
    order = _prune(root)
    _score(order)
    best = max(order, key=lambda n: n.score * (1 - n.linked / max(n.size, 1)))
    if best.score <= 0:
        named = [n for n in order if n.tag in MAIN] or [n for n in order if n.tag == "body"] or [root]
        best = max(named, key=lambda n: n.size)
    up = best
    while up is not None and up.tag not in MAIN:
        up = up.parent
    best = up or best
    kept = [best]
    if best.parent is not None and best.tag not in ("body", "html", "#root"):
        limit = max(10.0, 0.2 * best.score)
        kept = [k for k in best.parent.kids if not isinstance(k, str) and (
            k is best or k.score * (1 - k.linked / max(k.size, 1)) >= limit
            or k.tag == "p" and k.size >= 80 and k.linked <= 0.25 * k.size
            or k.tag in ("h1", "h2") and best.tag not in MAIN)]
    out: list[str] = []
    for k in kept:
        _text(k, out)
    return " ".join("".join(out).split())


def _pages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield pd.DataFrame({"page_id": f["page_id"].astype("Int64"), "url": f["url"],
                            "text": [extract(h) for h in f["html"]]})


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    Elements that are never main text (menus, footers, sidebars, notices,
    adverts, forms, scripts, comments, hidden parts) go by name, role, class or
    id. Each paragraph of 25 characters or more gives points for its length and
    commas, less its share of linked text, to its container and, halved again
    and again, to the containers around it. The best container (the ``article``
    or ``main`` around it, if any) is kept with the siblings that score a fifth
    of it or are long paragraphs. Nothing inside what is kept is dropped.
    Null or empty pages have empty text; repeated rows and null ids are passed
    through; an empty table gives an empty result; other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return (rows.mapInPandas(_pages, "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
