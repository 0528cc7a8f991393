"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineledger.llm.dom import HEADINGS, INLINE, Node, matches, parse
from lineledger.llm.shared import Staged, map_batches

SHAPE_PAGES = 3  # a shape with more different pages has a reference of its own
CONSTANT = 0.8  # share of the pages that align with a node, with the same text, from which it is template
NEAR_COPY = 0.5  # of a page's text: a page that shares more with the reference tells nothing about the template
LEAST_REFERENCE = 200  # bytes; shorter pages are errors and redirects more often than not
ARTICLE = ("article", "main")
CONTAINERS = r"<(/?(?:body|div|main|article|section|nav|header|footer|aside|form|table|ul|ol|dl))(?=[\s/>])"

# Elements, roles and words in class names that mark what is not the article.
ASIDE_TAGS = frozenset(
    "head nav footer aside form button select datalist dialog menu noscript template svg math object canvas audio "
    "video applet search".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notification popup modal overlay "
    "newsletter subscribe subscription paywall share sharing social related recommended pagination pager widget skip "
    "toolbar login signup".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist respond replies disqus discussion".split())
# Inside an article: elements of content whatever their class is, and tokens that name a list of comments by class or id.
PROSE = HEADINGS | INLINE | frozenset("p blockquote pre figure figcaption li dt dd td th caption".split())
DRAWN = frozenset("svg math".split())
COMMENT_LISTS = COMMENT_WORDS - {"discussion"}
AD_NAMES = frozenset(["adsbygoogle"])
# Words that say nothing of their own in a name: a name of these and words for what is not the article is such a one.
NEUTRAL = frozenset(
    "list lists area section thread threads user users reader readers box wrapper wrap container block slot unit item "
    "items feed form widget posts links articles buttons button icons bar row panel holder zone region count".split()
)
_WORD = re.compile(r"[a-z]+")


def _words(node_attributes: dict[str, str]) -> set[str]:
    named = f"{node_attributes.get('class', '')} {node_attributes.get('id', '')}"
    return set(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()))


def _by_state(own: dict[str, str]) -> bool:
    return own.get("role", "").lower() in ASIDE_ROLES or "hidden" in own or own.get("aria-hidden", "").lower() == "true"


def _names(names: str, words: frozenset[str]) -> bool:
    """Whether one of the names is made of ``words`` and neutral ones, as ``comments-area`` and ``adSlot`` are."""
    for name in names.split():
        parts = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
        if any(p in words for p in parts) and all(p in words or p in NEUTRAL for p in parts):
            return True
    return False


def _lists_comments(own: dict[str, str]) -> bool:
    return _names(f"{own.get('class', '')} {own.get('id', '')}", COMMENT_LISTS)


def _aside_inside(tag: str, own: dict[str, str]) -> bool:
    """As :func:`_marked_aside` for what is inside an article: one word among others in a name is no evidence there."""
    if not own or _by_state(own):
        return bool(own)
    named = own.get("class", "")
    if AD_NAMES & set(named.lower().split()):
        return True
    return tag not in PROSE and (_names(named, ASIDE_WORDS | COMMENT_WORDS) or _lists_comments(own))


def _marked_aside(tag: str, own: dict[str, str]) -> bool:
    """Whether an element's role, state or class names say that it is not part of the article."""
    if not own or tag in ("html", "body", "#root"):
        return False
    if _by_state(own):
        return True
    words = _words(own)
    return bool(words & COMMENT_WORDS) or (tag not in ARTICLE and bool(words & ASIDE_WORDS))


def _is_article(node: Node) -> bool:
    marked = node.tag in ARTICLE or node.attributes.get("role", "").lower() in ARTICLE
    return marked or node.attributes.get("itemprop", "").lower() == "articlebody"


def _asides(root: Node) -> set[int]:
    """Nodes that are left out with all below them; never one around the article, and no header inside it."""
    order, parent = [], {}
    for node in root.nodes():
        order.append(node)
        for child in node.children:
            parent[id(child)] = node
    inside: set[int] = set()  # an article or main part
    nested: set[int] = set()  # an article or a list of comments
    aside: set[int] = set()
    for node in order:
        above = parent.get(id(node))
        if above is not None:
            if id(above) in inside or _is_article(above):
                inside.add(id(node))
            main = above.tag == "main" or above.attributes.get("role", "").lower() == "main"
            if id(above) in nested or (_is_article(above) and not main) or _lists_comments(above.attributes):
                nested.add(id(node))
        if _is_article(node) and id(node) not in nested:
            if _by_state(node.attributes):
                aside.add(id(node))
        elif (_aside_inside if id(node) in inside else _marked_aside)(node.tag, node.attributes):
            aside.add(id(node))
    holds: set[int] = set()
    for node in order:
        if _is_article(node) and id(node) not in aside:
            while node is not None and id(node) not in holds:
                holds.add(id(node))
                node = parent.get(id(node))
    out = set()
    for node in order:
        tagged = node.tag in ASIDE_TAGS and not (node.tag in DRAWN and id(node) in inside)
        if tagged or (node.tag == "header" and id(node) not in inside) or id(node) in aside:
            if id(node) not in holds:
                out.add(id(node))
    return out


def _articles(root: Node, asides: set[int]) -> list[Node]:
    """The outermost articles of a page, else its main parts; none if nothing is marked."""
    for wanted in (lambda n: _is_article(n) and n.tag != "main" and n.attributes.get("role", "").lower() != "main", _is_article):
        found, waiting = [], [root]
        while waiting:
            node = waiting.pop()
            if id(node) in asides:
                continue
            if wanted(node):
                found.append(node)
            else:
                waiting.extend(reversed(node.children))
        if found:
            return found
    return []


def _text(nodes: list[Node], left_out: set[int], silent: set[int]) -> str:
    """Texts in page order; ``silent`` nodes lose their own text only."""
    out: list[str] = []
    waiting: list = list(reversed(nodes))
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            out.append(item)
        elif id(item) not in left_out:
            border = "" if item.tag in INLINE else " "
            waiting.append(border)
            waiting.extend(reversed([i for i in item.items if not isinstance(i, str)] if id(item) in silent else item.items))
            out.append(border)
    return " ".join("".join(out).split())


def tree(html: str) -> Node:
    return parse(html, _marked_aside)


def main_text(root: Node, template: set[int]) -> str:
    """The article of a page.

    Where the page marks its article, that slot holds the content, elsewhere the whole page does. The content is what
    is neither set aside nor ``template``: nodes whose text is constant over the host's pages. If that leaves
    nothing, the template stays, since then the pages are copies of each other.
    """
    asides = _asides(root)
    slot = _articles(root, asides) or [root]
    return _text(slot, asides, template) or _text(slot, asides, set())


class _References:
    """Trees of the reference pages that a batch meets, parsed once each."""

    def __init__(self):
        self.known: dict[str, tuple[Node, dict[int, int], list[str]]] = {}

    def __call__(self, html: str) -> tuple[Node, dict[int, int], list[str]]:
        if html not in self.known:
            root = tree(html)
            nodes = list(root.nodes())
            self.known[html] = root, {id(n): i for i, n in enumerate(nodes)}, [n.text() for n in nodes]
        return self.known[html]


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def shape_of(html: Column) -> Column:
    """A number for the order of a page's containers, whatever blocks of prose are in them."""
    return F.xxhash64(F.regexp_extract_all(F.lower(html), F.lit(CONTAINERS), F.lit(1)))


def shapes(rows: DataFrame, staged: Staged) -> DataFrame:
    """``(host, shape, used, least)`` of every shape of a host: the shape whose reference its pages are aligned with.

    That is the shape itself if more than a few different pages have it, else the host's most frequent one. ``least``
    is the size of its shortest page that is no stub. Only counts are grouped by host.
    """
    size = F.octet_length("html")
    counts = rows.groupBy("host", "shape").agg(
        F.count_distinct(F.xxhash64("html")).alias("n"),
        F.max(size >= LEAST_REFERENCE).alias("long"),
        F.min(F.when(size >= LEAST_REFERENCE, size)).alias("least"),
    )
    counts = staged(counts, "shapes")
    main = counts.groupBy("host").agg(F.max(F.struct("long", "n", -F.col("least"), "shape"))["shape"].alias("main"))
    used = F.when(F.col("n") > SHAPE_PAGES, F.col("shape")).otherwise(F.col("main")).alias("used")
    return staged(counts.join(main, "host").select("host", "shape", used, "least"), "chosen")


def assigned(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``rows`` with their shape replaced by the one whose reference they are aligned with."""
    found = rows.join(chosen.select("host", "shape", "used"), ["host", "shape"])
    return found.drop("shape").withColumnRenamed("used", "shape")


def wrappers(pages: DataFrame, staged: Staged, id_col: str, url_col: str, html_col: str) -> tuple[DataFrame, DataFrame]:
    """``(host, shape, reference, template)``: a page per host and shape, and which of its nodes have a constant text.

    Also gives the shapes. Every page is aligned with one reference, a short page of its own shape or of its host's
    main one, so the work per page does not depend on the host's size or the number of its layouts. A page that
    is nearly a copy of the reference tells its text and its template not apart and does not count; of other pages a
    single one is evidence. Counts are summed per batch, per task and in total; a host with a third of all pages is as many rows of pages as any
    others and a few numbers per batch.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    size = F.octet_length("html")
    rows = pages.select(host_of(F.col(url_col).cast("string")).alias("host"), html.alias("html"), F.col(id_col).cast("bigint").alias("id"))
    rows = rows.withColumn("shape", shape_of(F.col("html")))
    chosen = shapes(rows, staged)
    order = F.struct((size < LEAST_REFERENCE).alias("stub"), size.alias("size"), "id", "html")
    short = rows.join(chosen.where("shape = used"), ["host", "shape"]).where(F.col("least").isNull() | (size == F.col("least")))
    short = staged(short.groupBy("host", "shape").agg(F.min(order)["html"].alias("reference")), "references")

    def batch(hosts, shapes, texts, references):
        trees, counts = _References(), defaultdict(lambda: [0, 0])
        for host, shape, html, reference in zip(*(v.to_pylist() for v in (hosts, shapes)), texts, references.to_pylist(), strict=True):
            html = html.as_py()
            if html == reference:
                continue
            root, number, known = trees(reference)
            own_root = tree(html)
            pairs = [(number[id(other)], own.text()) for own, other in matches(own_root, root)]
            shared = sum(len(text) for at, text in pairs if text == known[at])
            if shared > NEAR_COPY * sum(len(node.text()) for node in own_root.nodes()):
                continue
            for at, text in pairs:
                if known[at]:
                    cell = counts[host, shape, at]
                    cell[0] += 1
                    cell[1] += text == known[at]
        keys = list(counts)
        yield {
            "host": [k[0] for k in keys],
            "shape": [k[1] for k in keys],
            "node": [k[2] for k in keys],
            "matched": [counts[k][0] for k in keys],
            "equal": [counts[k][1] for k in keys],
        }

    kinds = {"host": "string", "shape": "bigint", "html": "string", "reference": "string"}
    schema = "host string, shape bigint, node int, matched bigint, equal bigint"
    counted = map_batches(assigned(rows, chosen).join(short, ["host", "shape"]), kinds, batch, schema)
    totals = counted.groupBy("host", "shape", "node").agg(F.sum("matched").alias("matched"), F.sum("equal").alias("equal"))
    fixed = totals.where(F.col("equal") >= CONSTANT * F.col("matched"))
    fixed = fixed.groupBy("host", "shape").agg(F.collect_list("node").alias("template"))
    return staged(short.join(fixed, ["host", "shape"], "left"), "wrappers"), chosen


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of each page: its article, blocks in page order joined by single spaces.

    Null pages and pages without an article's text have an empty one. Pages without a host are a host together.
    Repeated rows are extracted each for itself.
    """
    staged = Staged(pages.sparkSession, "wrappers")
    known, chosen = wrappers(pages, staged, id_col, url_col, html_col)
    rows = pages.select(
        F.col(id_col).cast("bigint").alias(id_col),
        F.col(url_col).cast("string").alias(url_col),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("__html"),
        host_of(F.col(url_col).cast("string")).alias("host"),
    ).withColumn("shape", shape_of(F.col("__html")))
    rows = assigned(rows, chosen).join(known, ["host", "shape"], "left")

    def batch(ids, urls, texts, references, templates):
        trees, out = _References(), []
        for html, reference, template in zip(texts, references, templates, strict=True):
            root, constant = tree(html.as_py()), set()
            if template.is_valid:
                fixed = set(template.as_py())
                reference_root, number, known_texts = trees(reference.as_py())
                for own, other in matches(root, reference_root):
                    at = number[id(other)]
                    if at in fixed and own.text() == known_texts[at]:
                        constant.add(id(own))
            out.append(main_text(root, constant))
        yield {id_col: ids, url_col: urls, "text": out, "n_chars": np.array([len(t) for t in out], np.int64)}

    kinds = {id_col: "bigint", url_col: "string", "__html": "string", "reference": "string", "template": "array<int>"}
    return map_batches(rows, kinds, batch, f"{id_col} bigint, {url_col} string, text string, n_chars bigint")
