"""Main text of HTML pages by tree scoring.

Paragraphs earn points for length and commas and pass them up: all to the parent, half to the grandparent, a third of
that and so on above. A container's points are discounted by its link density. The best container and those siblings
that look like its text are kept; if other containers have a fifth of its points, what holds them all is looked through instead. Elements that are no article text by their kind, role or name never take part,
unless a name or form turns out to be around the article itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import prepared, text_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|iframe|noembed|noframes|xmp|textarea|title"
DROPPED = frozenset(
    "script style noscript template iframe noembed noframes object embed svg math canvas audio video nav aside footer "
    "button input select textarea option menu dialog head title datalist map".split())
FORMS = frozenset("form fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption li dd dt".split())
SAME = {  # a start tag ends an open element of these kinds, looked for up to the second set
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Words in a class or id that mark what is not the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner banners sponsor sponsored promo promos "
    "promotion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer foot header masthead "
    "topbar toolbar cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay "
    "newsletter subscribe subscription signup login comment comments commentlist disqus respond reply replies discussion "
    "share sharing social related recommended recommendations pagination pager widget widgets form search skip hidden".split())
# Those of them that also occur in names of what is around the article; the others are about what stands beside it.
AROUND = frozenset(
    "nav navbar navigation menu menus sidebar sidebars aside footer foot header masthead topbar toolbar banner banners "
    "notice notices alert modal overlay popup subscription login social share sharing related reply replies widget widgets form "
    "search skip hidden".split())
# A name that holds one of these says something about what is around it: has-sidebar, with-header, overflow-hidden, md:hidden.
MODIFIERS = frozenset("has have with without no not overflow backface clip under above below hide show toggle".split())
KEPT = frozenset("html body main article".split())
TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(" + RAW + r")\b(?:[^\"'>]|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*[^>]*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*(?:>|\Z)", re.I | re.S)
# One attribute after the other: its whole name and its value, so that nothing inside a value is taken for a name.
ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    __slots__ = ("tag", "parent", "children", "skip", "doubt", "points", "letters", "linked")

    def __init__(self, tag: str, parent: Element | None, doubt: int):
        self.tag, self.parent, self.skip, self.doubt = tag, parent, doubt > 0, doubt
        self.children: list[Element | str] = []
        self.points, self.letters, self.linked = 0.0, 0, 0


SURE, BESIDE, WRAPS = 3, 2, 1  # why an element is left out: by its kind, or by a name; the latter two may turn out wrong


def _doubt_by_name(value: str) -> int:
    doubt = 0
    for name in value.split():
        words = [w.lower() for w in WORDS.findall(name)]
        if ":" in name or not MODIFIERS.isdisjoint(words):
            continue
        marks = NAMES.intersection(words)
        if marks:
            doubt = max(doubt, WRAPS if marks <= AROUND else BESIDE)
    return doubt


def _unwanted(tag: str, attributes: str, in_article: bool) -> int:
    """0, or why the element is left out."""
    if tag in DROPPED:
        return SURE
    if tag == "header" and not in_article:  # an article's own heading is part of it
        return SURE
    if tag in KEPT:
        return 0
    doubt = WRAPS if tag in FORMS else 0
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            doubt = max(doubt, _doubt_by_name(value))
        elif name == "role":
            if value.lower() in ROLES:
                return SURE
        elif name == "style":
            if UNSEEN.search(value):
                return SURE
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return SURE
    return doubt


class _Open:
    """The elements that are open, from the root down, and at which depths each kind of them is.

    What an end tag or a start tag ends is one look, however many elements are open, and every element is closed once.
    """

    def __init__(self, root: Element):
        self.line = [root]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # depths of all open blocks, and of all but paragraphs
        self.walls: list[int] = []

    def push(self, node: Element) -> None:
        depth = len(self.line)
        self.line.append(node)
        self.depths.setdefault(node.tag, []).append(depth)
        if node.tag in BLOCKS:
            self.blocks.append(depth)
            if node.tag != "p":
                self.walls.append(depth)

    def deepest(self, tags: Iterable[str]) -> int:
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def close(self, depth: int) -> None:
        """Close the element at that depth and all in it."""
        while len(self.line) > depth:
            node = self.line.pop()
            self.depths[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()
                if node.tag != "p":
                    self.walls.pop()

    def end_tag(self, tag: str) -> None:
        depth = self.deepest((tag,))
        # An inline end tag doesn't close a block; one that matches nothing is ignored.
        if depth and (tag in BLOCKS or not self.blocks or depth > self.blocks[-1]):
            self.close(depth)

    def before(self, tag: str) -> None:
        """Supply the end tags that a start tag lets be left out."""
        if tag in CLOSES_P:
            depth = self.deepest(("p",))
            if depth and (not self.walls or depth > self.walls[-1]):
                self.close(depth)
        if tag in SAME:
            kinds, stop = SAME[tag]
            depth = self.deepest(kinds)
            if depth > self.deepest(stop):
                self.close(depth)


def parsed(page: str) -> Element:
    """The page as a tree; end tags that may be left out are supplied, those that match nothing are ignored."""
    root = Element("html", None, 0)
    open_, end = _Open(root), 0
    for m in TAG.finditer(page):
        at = open_.line[-1]
        if m.start() > end:
            at.children.append(unescape(page[end:m.start()]))
        end = m.end()
        tag = m[3]
        if tag is None:
            continue  # comment, raw text, declaration or a tag that never ends
        tag = tag.lower()
        if m[2]:
            if tag not in ("html", "body"):
                open_.end_tag(tag)
            continue
        open_.before(tag)
        if tag == "html":
            continue
        at = open_.line[-1]
        if tag == "br":
            at.children.append("\n")
            continue
        node = Element(tag, at, _unwanted(tag, m[4], open_.deepest(("article", "main")) > 0))
        at.children.append(node)
        if tag not in VOID and not (m[4].endswith("/") and tag not in BLOCKS):
            open_.push(node)
    if end < len(page):
        open_.line[-1].children.append(unescape(page[end:]))
    return root


def _measured(root: Element, doubtful: bool) -> tuple[list[Element], dict[int, float]]:
    """Elements that take part (if asked for with those left out in doubt), each before what is in it; paragraphs' points."""
    order: list[Element] = []
    stack = [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Element) and (not c.skip or doubtful and c.doubt < SURE)]
    own: dict[int, tuple[int, int]] = {}
    worth: dict[int, float] = {}
    for node in reversed(order):  # children first
        letters = commas = node.letters = node.linked = 0
        for c in node.children:
            if isinstance(c, str):
                letters += len(c.strip())
                commas += c.count(",") + c.count("，") + c.count("、")
            elif id(c) in own:
                node.letters += c.letters
                node.linked += c.linked
                if c.tag not in BLOCKS:
                    letters += own[id(c)][0]
                    commas += own[id(c)][1]
        own[id(node)] = letters, commas
        node.letters += sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            node.linked = node.letters
        if node.tag in BLOCKS and letters >= 20:
            share = 1 - node.linked / max(1, node.letters)
            worth[id(node)] = (1 + commas + min(letters / 100, 3.0)) * share
    return order, worth


def _take_back(root: Element) -> None:
    """Let those elements take part after all whose name or form turns out to be around the article.

    Such an element holds the page's largest article or main element, or more than half of the paragraphs' points and of the
    letters while no article or main element is outside; one named after what stands beside an article needs nearly all letters.
    """
    order, worth = _measured(root, True)
    if not any(n.doubt for n in order):
        return
    size, total, most, holds = {}, {}, {}, {}  # most: points of the largest article inside
    for node in reversed(order):
        inner = [c for c in node.children if isinstance(c, Element) and id(c) in total]
        i, limit = id(node), node.tag in ("article", "main")
        size[i] = 1 + sum(size[id(c)] for c in inner)
        total[i] = worth.get(i, 0.0) + sum(total[id(c)] for c in inner)
        holds[i] = limit or any(holds[id(c)] for c in inner)
        most[i] = total[i] if limit else max((most[id(c)] for c in inner), default=-1.0)
    n = len(order)
    before, after = [-1.0] * (n + 1), [-1.0] * (n + 1)  # largest article that ends before a place, that begins there or later
    for at, node in enumerate(order):
        if node.tag in ("article", "main"):
            end = at + size[id(node)]
            before[end] = max(before[end], total[id(node)])
            after[at] = total[id(node)]
    for at in range(1, n + 1):
        before[at] = max(before[at], before[at - 1])
        after[n - at] = max(after[n - at], after[n - at + 1])
    hidden: set[int] = set()
    article: dict[int, Element | None] = {}  # the outermost article or main element above
    for at, node in enumerate(order):
        i = id(node)
        over = node.parent
        article[i] = over and (article[id(over)] or (over if over.tag in ("article", "main") else None))
        if node.parent is not None and id(node.parent) in hidden:
            hidden.add(i)
            continue
        if not node.doubt:
            continue
        outside = max(before[at], after[at + size[i]])
        if article[i]:
            outside = max(outside, total[id(article[i])] - total[i])
        if holds[i] and most[i] >= outside:
            node.skip = False
        elif outside < 0 and 2 * total[i] > total[id(root)]:
            others = root.letters - node.letters
            node.skip = not (others < node.letters if node.doubt == WRAPS else 10 * others < node.letters)
        if node.skip:
            hidden.add(i)


def _score(root: Element) -> list[Element]:
    """Give points; the containers that got some."""
    containers: dict[int, Element] = {}
    order, worth = _measured(root, False)
    for node in reversed(order):
        points = worth.get(id(node))
        if points is not None:
            above, part = (node.parent or node), 1
            while above is not None and part <= 4:
                above.points += points / (1 if part == 1 else 2 if part == 2 else 3 * (part - 1))
                containers[id(above)] = above
                above, part = above.parent, part + 1
    return list(containers.values())


def _final(node: Element) -> float:
    return node.points * (1 - node.linked / max(1, node.letters))


def _line(node: Element | None) -> list[int]:
    """The element and all above it."""
    out = []
    while node is not None:
        out.append(id(node))
        node = node.parent
    return out


def _around(best: Element, others: list[Element]) -> Element:
    """The lowest element that holds the container and all the others."""
    place = {i: at for at, i in enumerate(_line(best))}
    top, seen = best, set()
    for node in others:
        while id(node) not in place and id(node) not in seen:
            seen.add(id(node))
            node = node.parent
        if id(node) in place and place[id(node)] > place[id(top)]:
            top = node
    return top


def _kept(root: Element) -> list[Element]:
    _take_back(root)
    containers = _score(root)
    if not containers:
        return [root]
    best = max(containers, key=_final)  # the first of equal ones
    node = best
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    high: set[int] = set()
    if node is not None:  # the article around it is its natural limit
        best = node
    elif best.parent is not None:
        # Parts of one article may lie deeper than its siblings: what holds them all is looked through instead.
        above = set(_line(best.parent))  # these have a share of its points
        parts = [c for c in containers if id(c) not in above and _final(c) >= 0.2 * _final(best)]
        top = _around(best, parts)
        if top is not best and top is not best.parent:
            for c in parts:
                while c is not None and id(c) not in high:
                    high.add(id(c))
                    c = c.parent
            return _parts(top, high, _final(best))
    if best.parent is None:
        return [best]
    return _parts(best.parent, {id(best)}, _final(best))


def _parts(parent: Element, high: set[int], points: float) -> list[Element]:
    """Children that are in `high` or look like text beside it."""
    least, kept = max(10.0, 0.2 * points), []
    for c in parent.children:
        if isinstance(c, str) or c.skip:
            continue
        density = c.linked / max(1, c.letters)
        if id(c) in high or _final(c) >= least or (c.tag == "p" and c.letters >= 80 and density < 0.25):
            kept.append(c)
    return kept


def main_text(page: str) -> str:
    """Blocks of the kept elements in page order, white space in a block as one space, blocks joined by one space."""
    if not page:
        return ""
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(text)
        parts.clear()

    for top in _kept(parsed(page)):
        stack: list[Element | str | None] = [top]
        while stack:
            node = stack.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                parts.append(node)
            elif not node.skip:
                if node.tag in BLOCKS:
                    flush()
                    stack.append(None)
                stack += reversed(node.children)
        flush()
    return " ".join(blocks)


def extracted(pages: DataFrame, html: str = "html", keep: tuple[str | Column, ...] = ("*",)) -> DataFrame:
    """Add text and n_chars (its characters) to the columns in `keep`; columns with these names are replaced.

    A NULL or empty page has an empty text; a page without any paragraph keeps what is not excluded.
    """
    prepared(pages.sparkSession)

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    return pages.select(*keep, run(text_of(html)).alias("__main")).withColumns(
        {"text": F.col("__main"), "n_chars": F.length("__main").cast("long")}).drop("__main")
