"""Operator 6: main text of web pages by composite text density.

The page becomes a tree of elements. Elements that are never article text by their
kind (navigation, forms, scripts, ...) or by a whole name in their class, id or role
(adverts, notices, comments, ...) are cut off. A name gives way where it would cut off
the only article or most of the page's text, or leave little. Every remaining node has the
characters and tags below it, and those inside links; its composite density is
characters per tag, adjusted by the share of link characters and tags. A node's
density sum is that of its children. The node with the largest sum is the main
subtree; the least density on its path to the body is the threshold, and further
nodes that reach it add the largest-sum subtree below them. A subtree inside an
``article`` or ``main`` element stands for the whole element.

Text: character references decoded, white space inside a block one space, trimmed,
blocks in page order joined by a line end. Null and empty pages, and pages without
text, give the empty text. Unclosed, stray and nested tags never fail. Repeated rows
give a row each; an empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import map_arrow, slices

# Fixed values of HTML: elements without content, with raw text, that are blocks, and that end an open p or their like.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
             "summary table tbody td tfoot th thead tr ul".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}

# Elements that hold no article text, and words in class, id or role that say so.
CUT_TAGS = RAW | set("head nav header footer aside form button select input label fieldset dialog object embed audio video canvas menu".split())
CUT_WORDS = set("ad ads adv advert advertisement adverts advertising alert banner breadcrumb breadcrumbs byline-social comment comments "
                "complementary consent contentinfo cookie cookies dialog disqus disclaimer footer form gdpr header login masthead menu menubar "
                "message modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup privacy "
                "promo promotion promoted recommend recommended related reply replies respond search share sharing sidebar sidebars signup "
                "skip social sponsor sponsored subscribe subscription tags toc toolbar topbar widget widgets".split())
#: Words of elements that have much text of their own: their names never give way to the amount of text.
OWN_WORDS = set("ad ads adv advert advertisement adverts advertising comment comments consent cookie cookies disqus gdpr reply replies "
                "respond sponsor sponsored".split())
#: Names of several words: cut words only, one of these and a word for a box, or one of the closed list.
BOXED_WORDS = OWN_WORDS | set("breadcrumb breadcrumbs footer menu menubar modal nav navbar navigation newsletter pager pagination paywall popup "
                              "promo share sharing sidebar signup social subscribe toolbar topbar".split())
BOX_WORDS = set("area bar block body box button buttons container form icons inner item items link links list panel section slot thread "
                "unit wrap wrapper".split())
COMPOUNDS = {f"{a}-{b}" for first, second in (
    ("site global primary secondary main", "header footer nav navbar navigation menu sidebar banner search breadcrumb breadcrumbs"),
    ("post article entry page", "comments footer nav navigation pagination share sharing social tags related sidebar"),
    ("related", "articles links news posts reading stories")) for a in first.split() for b in second.split()}
#: Characters outside links below which the cut leaves little.
LITTLE = 100

_OPEN = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[\"'>]")
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-zA-Z]+")


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "names", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: "Node | None", cut: bool, names: frozenset = frozenset()):
        self.tag, self.parent, self.cut, self.names = tag, parent, cut, names
        self.parts: list = []  # texts and nodes, in order
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0


def _cut_names(attributes: str) -> frozenset:
    """Words of the names in class, id and role that say the element is no article text."""
    out = set()
    for m in _NAMES.finditer(attributes):
        for name in html.unescape(m[2] or m[3] or m[4] or "").lower().split():
            words = _WORDS.findall(name)
            if name in CUT_WORDS or words and all(w in CUT_WORDS for w in words) or "-".join(words) in COMPOUNDS \
                    or len(words) == 2 and words[0] in BOXED_WORDS and words[1] in BOX_WORDS:
                out |= set(words)
    return frozenset(out)


class _Tags:
    """The tags of a page in order, in time that grows with its length."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}

    def end(self, at: int) -> int:
        """Place after the ``>`` of the tag that is open at ``at``; quotes that nothing closes are letters. 0 without one."""
        start = at
        while m := _STOP.search(self.page, at):
            if m[0] == ">":
                return m.end()
            at = self.page.find(m[0], m.end()) + 1 if m.start() < self.last[m[0]] else m.end()
            if at > self.last[">"]:  # a pair of quotes around all tag ends left
                break
        return self.page.find(">", start) + 1

    def next(self, at: int) -> tuple[int, int, str] | None:
        """Begin and end of the next tag, comment or declaration, and what it is; None without one."""
        while (m := _OPEN.search(self.page, at)) is not None:
            for begin, close in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if self.page.startswith(begin, m.start()):
                    found = self.page.find(close, m.start() + len(begin))
                    return m.start(), found + len(close) if found >= 0 else len(self.page), begin
            if m.start() > self.last[">"]:
                return None
            end = self.page.find(">", m.end()) + 1 if m[0][1] in "!?" else self.end(_NAME.search(self.page, m.start()).end())
            if end:
                return m.start(), end, m[0]
            at = m.end()
        return None


def parse(page: str) -> Node:
    """Tree of a page; unclosed elements end with their parent."""
    root = now = Node("#root", None, False)
    opened: Counter = Counter()  # open elements by tag
    tags, at = _Tags(page), 0

    def leave(node: Node, parent: Node) -> Node:
        while node is not parent:
            opened[node.tag] -= 1
            node = node.parent
        return parent

    while at < len(page):
        found = tags.next(at)
        if found is None:
            now.parts.append(page[at:])
            break
        start, end, kind = found
        if start > at:
            now.parts.append(page[at:start])
        at = end
        if kind[1] in "!?":
            if kind == "<![CDATA[":
                now.parts.append(html.escape(page[start + 9:end].removesuffix("]]>")))
            continue
        name = _NAME.search(page, start)
        tag, attributes = name[0].lower(), page[name.end():end - 1]
        if kind[1] == "/":
            if opened[tag]:
                node = now
                while node.tag != tag:
                    node = node.parent
                now = leave(now, node.parent)
            continue
        if tag in BLOCKS and tag != "body" and opened["p"]:
            now = leave(now, _end_open(now, {"p"}, {"#root", "body", "td", "th", "li", "div", "article", "section", "blockquote", "button"}))
        if tag in ENDS and any(opened[t] for t in ENDS[tag]):
            now = leave(now, _end_open(now, ENDS[tag], SCOPES[tag] | {"#root"}))
        names = _cut_names(attributes)
        cut = tag in CUT_TAGS or bool(names) and tag not in ("html", "body", "article", "main")
        if tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        node = Node(tag, now, cut, names)
        now.parts.append(node)
        if tag not in VOID and not (attributes.endswith("/") and tag not in BLOCKS):
            opened[tag] += 1
            now = node
    return root


def _end_open(now: Node, tags: set[str], scope: set[str]) -> Node:
    """The parent of the nearest open element of ``tags``, unless one of ``scope`` is nearer."""
    node = now
    while node is not None and node.tag not in scope:
        if node.tag in tags:
            return node.parent
        node = node.parent
    return now


def _restore(body: Node) -> None:
    """Take back cuts by name that hold the only article, most of the text, or nearly all that there is."""
    order, todo = [], [(body, False, False)]
    while todo:
        node, linked, below = todo.pop()
        below = below or node.cut
        order.append((node, linked or node.tag == "a", below))
        todo += [(p, order[-1][1], below) for p in node.parts if isinstance(p, Node) and p.tag not in CUT_TAGS]
    if not any(below for _, _, below in order):
        return
    own = {id(n): 0 if linked else sum(len(" ".join(p.split())) for p in n.parts if isinstance(p, str)) for n, linked, _ in order}
    plain = dict(own)
    for node, _, _ in reversed(order):
        if node is not body:
            plain[id(node.parent)] += plain[id(node)]
    articles = [(n, below) for n, _, below in order if n.tag in ("article", "main") and plain[id(n)]]
    if articles and all(below for _, below in articles):
        for up, _ in articles:
            up = None if up.names else up  # a comment or teaser may be an article element too
            while up is not None and up is not body:
                up.cut, up = False, up.parent
    for node, _, _ in order:
        if node.cut and not node.names & OWN_WORDS and 2 * plain[id(node)] > plain[id(body)]:
            node.cut = False
    left, article, heap, todo = 0, False, [], [body]
    while todo or heap and left < LITTLE and not article:
        # The uncut first; then the largest cut element, and what is uncut in it.
        node = todo.pop() if todo else heapq.heappop(heap)[-1]
        node.cut = False
        left += own[id(node)]
        article = article or node.tag in ("article", "main") and plain[id(node)] > 0
        for p in node.parts:
            if id(p) in own and not p.cut:
                todo.append(p)
            elif id(p) in own and not p.names & OWN_WORDS and plain[id(p)] > left:
                heapq.heappush(heap, (-plain[id(p)], id(p), p))


def _count(root: Node) -> list[Node]:
    """Fill characters and tags of the nodes that are not cut off; children before parents."""
    order, todo = [], [(root, False)]
    while todo:
        node, linked = todo.pop()
        order.append((node, linked))
        linked = linked or node.tag == "a"
        todo += [(p, linked) for p in node.parts if isinstance(p, Node) and not p.cut]
    for node, linked in reversed(order):
        own = sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str))
        node.chars += own
        if linked or node.tag == "a":
            node.link_chars += own
            node.link_tags += node.tag == "a"
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    return [node for node, _ in reversed(order)]


def densities(root: Node, body: Node) -> list[Node]:
    """Composite density of every node and the sum over its children; children come first."""
    nodes = _count(root)
    share = body.link_chars / body.chars if body.chars else 0.0
    for n in nodes:
        if n.chars:
            tags, link_chars, link_tags = max(n.tags, 1), max(n.link_chars, 1), max(n.link_tags, 1)
            plain = max(n.chars - n.link_chars, 1)
            base = math.log(n.chars / plain * n.link_chars + share * n.chars + math.e)
            n.density = n.chars / tags * max(math.log(n.chars / link_chars * tags / link_tags + 1e-9) / math.log(base + 1e-9), 0) if base > 1 \
                else n.chars / tags * max(math.log(n.chars / link_chars * tags / link_tags), 0)
        children = [p.density for p in n.parts if isinstance(p, Node) and not p.cut]
        n.sum = sum(children) if children else n.density
    return nodes


def _main(node: Node) -> Node:
    """The outermost article or main element around a node, or the node."""
    found, up = node, node.parent
    if node.tag in ("article", "main"):
        found = node
    while up is not None:
        if up.tag in ("article", "main"):
            found = up
        up = up.parent
    return found


def content(page: str) -> str:
    """Main text of a page."""
    root = parse(page)
    body = next((n for n in _walk(root) if n.tag == "body"), root)
    if body.cut:
        return ""
    _restore(body)
    densities(root, body)
    inner = [n for n in _walk(body) if n.chars]
    if not inner:
        return ""
    best = max(inner, key=lambda n: n.sum)
    threshold, up = best.density, best
    while up is not body and up is not None:
        up = up.parent
        if up is not None:
            threshold = min(threshold, up.density)
    chosen = [_main(best)]
    if chosen[0].tag not in ("article", "main"):
        for n in inner:
            if n.density >= threshold and n is not body and n.tag in BLOCKS:
                chosen.append(max((x for x in _walk(n) if x.chars), key=lambda x: x.sum))
    return text_of(body, {id(n) for n in chosen})


def _walk(node: Node) -> Iterator[Node]:
    """A node and all below it that is not cut off, in page order."""
    todo = [node]
    while todo:
        n = todo.pop()
        yield n
        todo += [p for p in reversed(n.parts) if isinstance(p, Node) and not p.cut]


def text_of(body: Node, chosen: set[int]) -> str:
    """Blocks of the chosen subtrees in page order."""
    blocks, now = [], []

    def end() -> None:
        text = " ".join("".join(now).split())
        if text:
            blocks.append(text)
        now.clear()

    todo: list = [(body, id(body) in chosen)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            if inside:
                now.append(html.unescape(item))
        elif item.tag == "br":
            now.append(" ")
        elif not item.cut:
            inside = inside or id(item) in chosen
            block = item.tag in BLOCKS
            if block:
                end()
                todo.append((None, False))
            todo += [(p, inside) for p in reversed(item.parts)]
    end()
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of each row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [content(h) if h else "" for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return map_arrow(rows, run, "page_id long, url string, text string")
