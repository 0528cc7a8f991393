"""Block trees of HTML pages and their alignment by simple tree matching."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SIBLINGS = {  # a start tag closes an open element of these, unless one of the containers is opened inside it
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")),
}
_CELLS = ("table", "td", "th", "caption", "template", "object")  # an end tag inside one closes nothing outside it

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Node:
    """An element that is a block or is marked, with its texts and children in page order."""

    __slots__ = ("tag", "attributes", "items", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.items, self.children = tag, attributes, [], []

    def text(self) -> str:
        """The element's own text, white space as single spaces."""
        return " ".join("".join(i if isinstance(i, str) else " " for i in self.items).split())

    def nodes(self) -> Iterator[Node]:
        """This node and all below it, in page order."""
        waiting = [self]
        while waiting:
            node = waiting.pop()
            yield node
            waiting.extend(reversed(node.children))


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def parse(html: str, marked=lambda tag, attributes: False) -> Node:
    """The tree of blocks of a page. Inline elements are part of their block's text, unless ``marked`` says otherwise.

    Follows what browsers do with missing and surplus end tags as far as blocks go; the content of scripts and
    other raw elements is left out, character references are decoded.
    """
    root = Node("#root", {})
    stack, at, end = [root], 0, len(html)
    opened: Counter[str] = Counter()  # open elements by name, so that no deep nest is searched in vain

    def close(depth: int) -> None:
        opened.subtract(node.tag for node in stack[depth:])
        del stack[depth:]

    def open_at(names, barriers=_CELLS) -> int | None:
        if not any(opened[name] for name in names):
            return None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                return k
            if stack[k].tag in barriers:
                return None
        return None

    def add_text(text: str) -> None:
        if text:
            stack[-1].items.append(unescape(text) if "&" in text else text)

    while at < end:
        start = html.find("<", at)
        if start < 0:
            add_text(html[at:])
            break
        found = _TOKEN.match(html, start)
        if not found:  # a sign of its own
            add_text(html[at : start + 1])
            at = start + 1
            continue
        add_text(html[at:start])
        at = found.end()
        closing, name, source = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            if name == "p" and open_at(("p",)) is None:
                stack[-1].items.append(" ")
            barriers = () if name in ("html", "body", "table") else _CELLS
            if name in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption"):
                barriers = ("table",)
            if name in HEADINGS:
                depth = open_at(HEADINGS, barriers)
            else:
                depth = open_at((name,), tuple(b for b in barriers if b != name))
            if depth is not None:
                close(depth)
            continue
        if name in VOID:
            stack[-1].items.append(" " if name in ("br", "hr") else "")
            continue
        if name in RAW:
            last = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = last.end() if last else end
            continue
        own = attributes(source) if source and not source.isspace() else {}
        if name in INLINE and not marked(name, own):
            continue
        if name in CLOSES_P and (depth := open_at(("p",), (*_CELLS, "button"))) is not None:
            close(depth)
        if name in HEADINGS and stack[-1].tag in HEADINGS:
            close(len(stack) - 1)
        if name in SIBLINGS and (depth := open_at(*SIBLINGS[name])) is not None:
            close(depth)
        if name in ("html", "body") and opened[name]:
            continue
        node = Node(name, own)
        stack[-1].items.append(node)
        stack[-1].children.append(node)
        stack.append(node)
        opened[name] += 1
    return root


# --- simple tree matching --------------------------------------------------------------------------------------


def _table(a: Node, b: Node, score) -> list[list[int]]:
    """Best numbers of matched nodes among the first children of both, order kept."""
    rows = [[0] * (len(b.children) + 1)]
    for x in a.children:
        above, row = rows[-1], [0]
        for j, y in enumerate(b.children):
            best = above[j + 1] if above[j + 1] >= row[j] else row[j]
            if x.tag == y.tag:
                with_both = above[j] + score(x, y)
                if with_both > best:
                    best = with_both
            row.append(best)
        rows.append(row)
    return rows


def _scores(a: Node, b: Node) -> Callable[[Node, Node], int]:
    """Nodes in a largest match of any two nodes that may meet in a match of both trees, however deep they are."""
    known: dict[tuple[int, int], int] = {}

    def score(x: Node, y: Node) -> int:
        return known[id(x), id(y)] if x.children and y.children else 1

    waiting = [(a, b, False)]
    while waiting:
        x, y, below_known = waiting.pop()
        if (id(x), id(y)) in known:
            continue
        if below_known:
            known[id(x), id(y)] = 1 + _table(x, y, score)[-1][-1]
            continue
        waiting.append((x, y, True))
        inner = [child for child in y.children if child.children]
        waiting += [(i, j, False) for i in x.children if i.children for j in inner if i.tag == j.tag]
    return score


def matches(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes in a largest order-keeping top-down match of both trees, whose roots count as alike."""
    score = _scores(a, b)
    out, waiting = [], [(a, b)]
    while waiting:
        x, y = waiting.pop()
        out.append((x, y))
        if not x.children or not y.children:
            continue
        rows = _table(x, y, score)
        i, j = len(x.children), len(y.children)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                waiting.append((x.children[i], y.children[j]))
    return out
