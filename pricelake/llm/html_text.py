"""Main text of pages by a site style tree.

Each page becomes a tree of elements. Pages of one host are merged: a node of the style tree is a path of
element styles (tag, class, id), a presentation is the sequence of child styles a page has there. A node that
varies little between pages in its presentation and its content carries site furniture. Importance is the entropy
of what pages show at a node, divided by the most it could be for that many pages, so 0 where all pages agree
and 1 where all differ; a page's branch of low importance is removed, inside its article too, and so are branches
whose style says what they are (navigation, footer, advert, form, comments and the like). Copies of a page count once:
pages are told apart by a fingerprint. ``<html>``, ``<body>`` and branches that hold all of a page's text stay, and a
page of which nothing else would be left keeps all its branches. Inside articles only whole blocks go: text inside
a line, headings, parts of tables and of definition lists, and line breaks go with the block around them.

A form around an article is a wrapper, and ``<main>`` is never furniture; a page of which such names would leave nothing
gives its articles, however they are named. Pages are read in one pass, in time proportional to their length.

Counting is a grouped aggregation over (host, node, presentation hash, content hash), first with the fingerprint: a hot
host is combined before the shuffle, and its nodes are spread over tasks. The low nodes of a host are
joined back to its pages, those of a hot host in parts.

What stays is cut into blocks at block elements; inside a block, character references are decoded and white space
is one space; blocks are joined by line feeds.

Defined cases: null html is empty and gives an empty text; pages without ``<article>`` or ``<main>`` use their body; repeated rows are
pages of their own; a null url has an empty host; a host with few pages relies on styles; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.arrow_text import byte_slices
from pricelake.llm.common import written
from pricelake.llm.url_rules import url_host

#: Below this importance a branch goes, if its host shows it on enough pages.
LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 5
#: A host with more than one in so many of all pages is hot: its pages go to several tasks, each with as many at most.
HOT_HOSTS = 1024

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
HIDDEN = frozenset("head script style noscript template iframe svg math canvas object audio video title textarea select datalist".split())
FURNITURE = frozenset("nav header footer aside form menu dialog button".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
CLOSES_P = BLOCKS - {"br", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
ARTICLE = frozenset(("article", "main"))
#: What entropy may remove inside an article.
REMOVABLE = BLOCKS - VOID - frozenset("body html h1 h2 h3 h4 h5 h6 hgroup caption tbody td tfoot th thead tr dt dd figcaption summary".split())
_NOISE = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|header|footer|side-?bar|widget|cookies?|consent|"
    r"notice|popup|modal|newsletter|subscribe|share|social|related|recommend\w*|comments?|reply|replies|respond|disqus|login|search|form)(?:$|[\s_-])"
)
#: A tag; quotes open a value after "=" only. Possessive repeats: what was read is not read again.
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_MARKUP = re.compile(r"<(?=[!?]|/?[A-Za-z])")
_ATTRIBUTE = re.compile(r"([^\s=\"'/<>]+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog"))


class Node:
    """An element: style, children (nodes and strings), whether it names itself furniture."""

    __slots__ = ("tag", "style", "children", "noise")

    def __init__(self, tag: str, style: str, noise: bool):
        self.tag, self.style, self.noise = tag, style, noise
        self.children: list = []


class _Open:
    """The open elements; where each tag is open tells what an end tag closes, without a walk through them."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.nodes))
        if node.tag in ARTICLE:
            for at in reversed(self.places.get("form", ())):  # a form around an article is a wrapper
                if not self.nodes[at].noise:
                    break
                self.nodes[at].noise = False
        self.nodes.append(node)

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            node = self.nodes.pop()
            self.places[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()

    def close(self, tag: str) -> None:
        at = self.last((tag,))
        # what is closed inside an article and was not opened there is ignored
        if at and (at >= self.last(ARTICLE) or tag in ("body", "html", "article", "main")):
            self.cut(at)

    def close_paragraph(self) -> None:
        at = self.last(("p",))
        if at and at == self.blocks[-1]:
            self.cut(at)

    def close_sibling(self, tag: str) -> None:
        at = self.last(_SAME.get(tag, (tag,)))
        if at and at > self.last(_AROUND.get(tag, ())) and at > self.last(ARTICLE):
            self.cut(at)


# Which open elements an element of the same kind ends, and up to where.
_SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
_AROUND = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}


def parse(html: str) -> Node:
    """A forgiving parse in one pass: unknown closings are ignored, block elements end an open paragraph.

    A tag that does not end by its quotes ends at the next ``>``, and so do all after it; one that does not end at all is
    the rest of the page.
    """
    root = Node("#", "#", False)
    opened = _Open(root)
    pattern = _TAG
    at, n = 0, len(html)
    while at < n:
        start = _MARKUP.search(html, at)
        stop = start.start() if start else n
        if stop > at:
            opened.nodes[-1].children.append(html[at:stop])
        if start is None:
            break
        if html[stop + 1] in "!?":
            comment = html.startswith("<!--", stop)
            end = html.find("-->", stop + 2) if comment else html.find(">", stop)
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        m = pattern.match(html, stop)
        if m is None and pattern is _TAG:
            pattern = _PLAIN_TAG
            m = pattern.match(html, stop)
        if m is None:
            break
        at = m.end()
        tag, attributes = m.group(2).lower(), m.group(3)
        if m.group(1):
            opened.close(tag)
            continue
        if tag in CLOSES_P:
            opened.close_paragraph()
        if tag in _AROUND or tag == "option":
            opened.close_sibling(tag)
        node = _element(tag, attributes)
        opened.nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?![\w])", re.I).search(html, at)
            if tag not in HIDDEN:
                node.children.append(html[at : end.start() if end else n])
            close = html.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else n
        elif tag not in VOID and not attributes.endswith("/"):
            opened.push(node)
    return root


def _element(tag: str, attributes: str) -> Node:
    kind, ident, role, hidden = "", "", "", False
    for k, a, b, c in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        key = k.lower()
        if key == "class":
            kind = a or b or c
        elif key == "id":
            ident = a or b or c
        elif key == "role":
            role = (a or b or c).lower()
        elif key == "hidden":
            hidden = True
    style = f"{tag}.{kind}#{re.sub(r'[0-9]+', '0', ident)}" if kind or ident else tag
    noise = tag in FURNITURE or role in _ROLES or hidden or bool(_NOISE.search(f"{kind} {ident}"))
    return Node(tag, style, noise and tag not in ("html", "body", "main"))


def text_blocks(node: Node, dropped: frozenset = frozenset()) -> list[str]:
    """Blocks of text below a node in page order, without furniture and dropped branches (by identity)."""
    blocks: list[str] = []
    open_block: list[str] = []

    def end() -> None:
        text = " ".join("".join(open_block).split())
        if text:
            blocks.append(text)
        open_block.clear()

    todo: list = [(node, False)]
    while todo:
        item, leaving = todo.pop()
        if isinstance(item, str):
            open_block.append(unescape(item))
        elif leaving:
            end()
        elif item.tag in HIDDEN or item.noise or id(item) in dropped:
            continue
        else:
            if item.tag in BLOCKS:
                end()
                todo.append((item, True))
            todo.extend((c, False) for c in reversed(item.children))
    end()
    return blocks


class Branch(NamedTuple):
    """An element outside articles that holds none, or a block inside one: where it is, how it is laid out, what it says (hashes)."""

    place: int
    node: Node
    shown: int
    content: int


def branches(root: Node) -> list[Branch]:
    """Branches of a page that are not furniture by name; hashes are built from the leaves up."""
    order: list[tuple[Node, int, int]] = [(root, -1, 0)]  # node, index of its parent, hash of its path
    inside = [False]
    at = 0
    while at < len(order):
        node, _, place = order[at]
        for child in node.children:
            if not isinstance(child, str) and child.tag not in HIDDEN and not child.noise:
                order.append((child, at, _hash(f"{place}/{child.style}")))
                inside.append(inside[at] or child.tag in ARTICLE)
        at += 1
    content = [0] * len(order)
    article = [any(not isinstance(c, str) and c.tag in ARTICLE for c in node.children) for node, _, _ in order]
    below: list[list[int]] = [[] for _ in order]
    out = []
    for i in range(len(order) - 1, 0, -1):
        node, parent, place = order[i]
        words = " ".join(" ".join(c.split()) for c in node.children if isinstance(c, str))
        content[i] = _hash(words + "|" + ",".join(map(str, reversed(below[i]))))
        below[parent].append(content[i])
        article[parent] = article[parent] or article[i]
        if node.tag in REMOVABLE if inside[i] else not article[i] and node.tag not in ("html", "body"):
            shown = ",".join(c.style for c in node.children if not isinstance(c, str))
            out.append(Branch(place, node, _hash(shown), content[i]))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chain.from_iterable(byte_slices(b, "html") for b in batches):
        rows: list[tuple] = []
        for host, html, fp in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "fp")), strict=True):
            rows.extend((host, b.place, b.shown, b.content, fp) for b in branches(parse(html or "")))
        cols = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["host", "node", "shown", "content", "fp"])


def style_tree(pages: DataFrame) -> DataFrame:
    """host, node, pages, importance: the larger of the entropies of presentation and of content, each over its most.

    Pages with the same fingerprint ``fp`` are one.
    """
    shown = pages.mapInArrow(_collect, "host string, node long, shown long, content long, fp long").distinct()
    seen = written(shown.groupBy("host", "node", "shown", "content").agg(F.count(F.lit(1)).alias("n")), "style-tree")
    share = F.col("n") * F.log2("n")

    def entropy(by: str) -> DataFrame:
        counts = seen.groupBy("host", "node", by).agg(F.sum("n").alias("n"))
        total = counts.groupBy("host", "node").agg(F.sum("n").alias("pages"), F.sum(share).alias("s"))
        bits = F.log2("pages") - F.col("s") / F.col("pages")
        return total.select("host", "node", "pages", F.when(F.col("pages") > 1, F.greatest(bits, F.lit(0.0)) / F.log2("pages")).otherwise(1.0).alias(by))

    both = entropy("shown").join(entropy("content").drop("pages"), ["host", "node"])
    return both.select("host", "node", "pages", F.greatest("shown", "content").alias("importance"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chain.from_iterable(byte_slices(b, "html") for b in batches):
        texts = []
        for html, low in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True):
            root, gone = parse(html or ""), frozenset(low or ())
            articles = _articles(root)
            parts = articles or [root]
            dropped = frozenset(id(b.node) for b in branches(root) if b.place in gone) if gone else frozenset()
            dropped = dropped - _holders(parts) if dropped else dropped
            text = "\n".join(chain.from_iterable(text_blocks(part, dropped) for part in parts))
            if dropped and not text:
                text = "\n".join(chain.from_iterable(text_blocks(part) for part in parts))
            if not text:  # names leave nothing: articles, whatever they or what is around them are called
                text = "\n".join(chain.from_iterable(_own_blocks(part) for part in _articles(root, named=True)))
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def _holders(parts: list[Node]) -> frozenset:
    """The nodes (by identity) that hold all of the text of the parts."""
    order: list[Node] = list(parts)
    for node in order:  # grows while it is read: parents before children
        order.extend(c for c in node.children if not isinstance(c, str) and c.tag not in HIDDEN and not c.noise)
    full: set[int] = set()
    for node in reversed(order):
        if any(unescape(c).strip() if isinstance(c, str) else id(c) in full for c in node.children):
            full.add(id(node))
    holders: list[int] = []
    level: list = list(parts)
    while True:
        held = [c for c in level if (unescape(c).strip() if isinstance(c, str) else id(c) in full)]
        if len(held) != 1 or isinstance(held[0], str):
            return frozenset(holders)
        holders.append(id(held[0]))
        level = held[0].children


def _articles(root: Node, named: bool = False) -> list[Node]:
    """The outermost article or main elements that are not inside furniture; ``named``: also those that are."""
    found: list[Node] = []
    todo = [root]
    while todo:
        at = todo.pop()
        if at.tag in HIDDEN or at.noise and not named:
            continue
        if at.tag in ARTICLE:
            found.append(at)
        else:
            todo.extend(c for c in reversed(at.children) if not isinstance(c, str))
    return found


def _own_blocks(article: Node) -> list[str]:
    """Blocks of an article whose own name is that of furniture."""
    inner = Node(article.tag, article.style, False)
    inner.children = article.children
    return text_blocks(inner)


def main_text(pages: DataFrame, least_importance: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text of every page."""
    rows = pages.select("page_id", "url", "html", F.xxhash64("html").alias("fp")).withColumn("host", url_host(F.col("url")))
    tree = style_tree(rows.select("host", "html", "fp"))
    low = tree.where((F.col("importance") < least_importance) & (F.col("pages") >= least_pages)).select("host", "node")
    # the low nodes of a host: bounded by the styles of its templates
    low = low.groupBy("host").agg(F.collect_set("node").alias("low"))
    # pages of a hot host go to several tasks, each with the host's low nodes
    per_host = written(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "hosts")
    total = per_host.agg(F.sum("n")).first()[0] or 0
    part = total // HOT_HOSTS + 1
    hot = per_host.where(F.col("n") > part).select("host", F.ceil(F.col("n") / part).alias("parts"))
    spread = F.broadcast(hot)  # fewer than HOT_HOSTS rows
    one = F.coalesce("parts", F.lit(1))
    rows = rows.join(spread, "host", "left").withColumn("part", F.pmod(F.xxhash64("fp", "page_id"), one))
    low = low.join(spread, "host", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), one - 1))).drop("parts")
    joined = rows.join(low, ["host", "part"], "left").select("page_id", "url", "html", "low")
    return joined.mapInArrow(_extract, pages.select("page_id", "url").withColumn("text", F.lit("")).schema)
