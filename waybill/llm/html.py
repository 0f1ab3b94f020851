"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks. Two costs of a block, of being kept and of being dropped, come from a linear classifier
over its DOM path, class names, links and text; they are the capacities of its edges to the terminals. Blocks that are
neighbours in the page or in the DOM tree are joined by smoothness edges. A maximum flow gives the cheapest cut, and the
blocks on the source's side are the main text, so a short paragraph is carried by its neighbours and an advert inside an
article is cut out.

Null html counts as empty; a page without blocks has empty text. Broken markup is read as far as it goes: unclosed
elements end with their parents, a tag that never closes ends the page. Whole pages are read and nothing is capped.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:.-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element names of HTML by role, and words of class and id names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template noscript iframe svg math object head title select textarea button datalist audio video canvas map".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BORDERS = frozenset("nav header footer aside form article main section dialog".split())
DROPPED_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|banner\w*|breadcrumbs?|comments?|commentlist|consent|cookies?|copyright|disclaimer|disqus|discussion|footer|"
    r"gdpr|header|legal|login|masthead|menu\w*|modal|nav\w*|newsletter|notices?|overlay|pager|pagination|paywall|popup|promo\w*|recommend\w*|related|"
    r"replies|reply|respond|search\w*|share|sharing|sidebar\w*|signup|skip|social|sponsor\w*|subscribe|subscription|tags?|toc|toolbar|widgets?)(?:[^a-z]|$)"
)
KEPT_WORDS = re.compile(r"(?:^|[^a-z])(?:article\w*|blog|body|content|entry|main|page|post|story|text)(?:[^a-z]|$)")

#: Weights of the classifier; positive speaks for main text.
WEIGHTS = {
    "boilerplate element": -14.0, "header": -9.0, "boilerplate name": -13.0, "hidden": -14.0, "article": 5.0, "main name": 2.5, "heading": 0.6,
    "long": 0.9, "bias": -0.2, "links": -4.5, "sentence": 0.8, "mark": -3.0,
}
#: Capacities of smoothness edges: neighbours in the page under one parent, under one grandparent, across a border.
SAME_PARENT, SAME_GRANDPARENT, ACROSS = 1.2, 0.6, 0.1


class Node:
    __slots__ = ("name", "parent", "value", "flags", "last")

    def __init__(self, name: str, parent: Node | None, value: float, flags: frozenset):
        self.name, self.parent, self.value, self.flags, self.last = name, parent, value, flags, -1


def opened(name: str, attributes: str, parent: Node) -> Node:
    """An element with the part of the classifier that its path decides."""
    found = set()
    if name in ("nav", "footer", "aside", "form", "dialog", "menu", "search", "fieldset"):
        found.add("boilerplate element")
    elif name == "header" and "article" not in parent.flags:
        found.add("header")
    elif name in ("article", "main"):
        found.add("article")
    if attributes:
        values = {k.lower(): (a or b or c or "").lower() for k, a, b, c in ATTRIBUTE.findall(attributes)}
        names = f"{values.get('class', '')} {values.get('id', '')} {values.get('role', '')} {values.get('itemprop', '')}"
        if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", ""):
            found.add("hidden")
        if names.strip():
            role = values.get("role", "")
            if role in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"):
                found.add("boilerplate element")
            if name not in ("html", "body", "article", "main") and not (name == "header" and "article" in parent.flags) and DROPPED_WORDS.search(names):
                found.add("boilerplate name")
            elif KEPT_WORDS.search(names):
                found.add("main name")
    new = found - parent.flags
    return Node(name, parent, parent.value + sum(WEIGHTS[f] for f in new), parent.flags | new if new else parent.flags)


class Block:
    __slots__ = ("node", "parts", "linked", "text", "heading")

    def __init__(self, node: Node):
        self.node, self.parts, self.linked, self.text, self.heading = node, [], 0, "", False


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, with their DOM nodes."""
    top = Node("", None, 0.0, frozenset())
    node, out, block, links, at = top, [], None, 0, 0

    def add(piece: str) -> None:
        nonlocal block
        if not piece:
            return
        if block is None:
            if not piece.strip():
                return
            container = node
            while container.name not in BLOCKS and container.parent is not None:
                container = container.parent
            block = Block(container)
            out.append(block)
        block.parts.append(piece)
        if links:
            block.linked += len(piece.strip())

    end = len(page)
    while at < end:
        low = page.find("<", at)
        if low < 0:
            add(page[at:])
            break
        add(page[at:low])
        tag = TAG.match(page, low)
        if not tag:
            following = page[low + 1 : low + 2]
            if following and (following.isascii() and following.isalpha() or following in "/!?"):
                # A tag without an end: one more try without quotes, else nothing of the rest is text.
                close = page.find(">", low)
                if close < 0:
                    break
                at = close + 1
                continue
            add("<")
            at = low + 1
            continue
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if not tag[1]:
            if name == "br":
                add(" ")
                continue
            if name in SKIPPED:
                if name != "head" and not tag[3].endswith("/"):
                    closing = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                    at = closing.end() if closing else (end if name in ("script", "style", "textarea") else at)
                continue
            if name in BLOCKS:
                block = None
            if name in VOID or tag[3].endswith("/"):
                continue
            if name in BLOCKS:
                # A new block ends an open paragraph, and a list item or cell its forerunner.
                ends = {"p"} | ({name} if name in ("li", "dt", "dd", "tr", "td", "th", "option") else set())
                scan = node
                while scan.parent is not None and (scan.name not in BLOCKS or scan.name in ends):
                    if scan.name in ends:
                        node = scan.parent
                        break
                    scan = scan.parent
            links += name == "a"
            node = opened(name, tag[3], node)
        else:
            scan = node
            while scan is not None and scan.name != name:
                scan = scan.parent
            if name in BLOCKS:
                block = None
            if name == "a":
                links = max(0, links - 1)
            if scan is not None and scan.parent is not None:
                node = scan.parent
                links = links if name == "a" else sum(1 for n in path(node) if n.name == "a") if links else 0
    kept = []
    for b in out:
        b.text = " ".join(unescape("".join(b.parts)).split())
        if b.text:
            b.heading = any(n.name in HEADINGS for n in path(b.node))
            kept.append(b)
    return kept


def path(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def value(block: Block) -> float:
    """The classifier: above 0 for main text."""
    words = block.text.count(" ") + 1
    density = min(1.0, block.linked / max(len(block.text), 1))
    out = block.node.value + WEIGHTS["bias"] + WEIGHTS["long"] * math.log1p(words) + WEIGHTS["links"] * density
    if block.heading:
        out += WEIGHTS["heading"]
    if block.text[-1] in ".!?…:;\"”»":
        out += WEIGHTS["sentence"]
    if "©" in block.text[:40] or block.text.lower().startswith(("all rights reserved", "copyright")):
        out += WEIGHTS["mark"]
    return out


def joined(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: page neighbours, and the last and next block under each common parent."""
    edges = []
    for k, b in enumerate(found):
        parent = b.node.parent
        if k:
            before = found[k - 1].node
            border = [{id(n): n for n in path(x) if n.name in BORDERS or "boilerplate name" in n.flags} for x in (before, b.node)]
            if border[0].keys() != border[1].keys():
                weight = ACROSS
            else:
                weight = SAME_PARENT if before is b.node or before.parent is parent else SAME_GRANDPARENT
            edges.append((k - 1, k, weight))
        if parent is not None:
            if parent.last >= 0 and parent.last < k - 1:
                edges.append((parent.last, k, SAME_GRANDPARENT))
            parent.last = k
    return edges


def source_side(keep: list[float], drop: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut: ``keep`` are capacities from the source, ``drop`` to the sink."""
    n = len(keep)
    excess = [a - b for a, b in zip(keep, drop)]  # what passes straight through is cut in any case
    if all(x <= 0 for x in excess):
        return [False] * n
    if all(x >= 0 for x in excess):
        return [True] * n
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to, room = [], []

    def edge(a: int, b: int, forth: float, back: float) -> None:
        heads[a].append(len(to)), to.append(b), room.append(forth)
        heads[b].append(len(to)), to.append(a), room.append(back)

    for k, x in enumerate(excess):
        if x > 0:
            edge(source, k, x, 0.0)
        elif x < 0:
            edge(k, sink, -x, 0.0)
    for a, b, weight in edges:
        edge(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        place = [0] * (n + 2)
        trail: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in trail)
                for e in trail:
                    room[e] -= least
                    room[e ^ 1] += least
                first = next(k for k, e in enumerate(trail) if room[e] <= 1e-9)
                a = to[trail[first] ^ 1]
                del trail[first:]
            while place[a] < len(heads[a]):
                e = heads[a][place[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                place[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[trail.pop() ^ 1]
                continue
            e = heads[a][place[a]]
            trail.append(e)
            a = to[e]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    values = [value(b) for b in found]
    softplus = lambda x: x if x > 30 else math.log1p(math.exp(x))
    side = source_side([softplus(v) for v in values], [softplus(-v) for v in values], joined(found))
    return "\n".join(b.text for b, kept in zip(found, side) if kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
