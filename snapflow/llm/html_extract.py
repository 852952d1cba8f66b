"""HTML extraction by minimum-cut labelling.

A page becomes blocks of text. A classifier's costs tie each block to the terminals
"content" and "boilerplate"; blocks that follow one another, and siblings in the tree,
are tied to each other. The minimum cut, found by maximum flow, parts the two kinds at
the least cost of misfits and broken ties. Blocks whose own cost outweighs all their
ties are settled before, which leaves small graphs.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame

from snapflow.llm.common import map_slices

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li "
    "legend main menu nav ol optgroup option p pre search section select summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed frame hr img input keygen link meta param source track wbr".split()
)
#: Elements whose content is no text of the page; the first have raw content.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = RAW | frozenset("head noscript template svg math canvas object audio video select".split())
#: Start tags that end an open paragraph, and items that end an open one of their kind.
ENDS_P = BLOCKS - frozenset("body caption head html legend option optgroup summary title".split())
SIBLINGS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPE = frozenset("ul ol dl table article section main aside nav header footer body html".split())

#: The classifier, in units of the tie between two neighbours.
AWAY_TAGS = {"nav": 12, "aside": 12, "footer": 12, "form": 12, "menu": 12, "button": 8, "dialog": 12,
             "label": 6, "fieldset": 8, "header": 8, "search": 12}
HOME_TAGS = {"article": 6, "main": 5}
AWAY_WORDS = {
    word: 12
    for word in "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo "
    "promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside rail widget footer masthead "
    "topbar comment comments commentlist disqus discussion reply replies respond reaction share "
    "sharing social follow related recommended recommendations trending popular newsletter subscribe "
    "subscription signup login search form pagination pager toolbar skip copyright legal disclaimer "
    "paywall toc tags".split()
} | {"header": 8, "head": 4, "meta": 3, "byline": 3, "author": 3}
HOME_WORDS = {
    word: 5
    for word in "article post entry story content main body text maincontent articlebody postbody "
    "hentry page prose".split()
}
ROLES_AWAY = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
    "toolbar".split()
)
_LEGAL = re.compile(r"©|\(c\) \d|copyright\b|all rights reserved", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+|\d+")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_MARK = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)",
    re.DOTALL,
)


@dataclass
class Node:
    """An open element: how far it speaks for boilerplate, or for content."""

    tag: str
    parent: Node | None
    away: int = 0
    home: int = 0
    depth: int = 0
    hidden: bool = False
    link: bool = False
    last: int = -1


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


def _opened(tag: str, attributes: str, parent: Node | None) -> Node:
    node = Node(tag, parent)
    if parent is not None:
        node.away, node.home = parent.away, parent.home
        node.depth, node.link, node.hidden = parent.depth + 1, parent.link, parent.hidden
    node.hidden |= tag in UNSEEN
    node.link |= tag == "a"
    away, home = AWAY_TAGS.get(tag, 0), HOME_TAGS.get(tag, 0)
    if tag == "header" and node.home:
        away = 0  # the heading of an article
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id"):
                found = _WORD.findall(value)
                kin = sum(HOME_WORDS.get(w, 0) for w in found)
                far = max([AWAY_WORDS.get(w, 0) for w in found], default=0)
                if "header" in found and (kin or node.home):
                    far = 0
                away, home = max(away, far), max(home, kin if not far else 0)
            elif name == "role" and value in ROLES_AWAY:
                away = max(away, 12)
            elif name == "role" and value in ("main", "article"):
                home = max(home, 5)
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                node.hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                node.hidden = True
    # Never hide or turn away the page as a whole.
    if tag in ("html", "body"):
        node.hidden, away, home = False, 0, 0
    node.away += away
    node.home = max(node.home, min(home, 8))
    return node


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order, those without visible text left out."""
    root = Node("", None)
    stack, found = [root], []
    block = Block(root)

    def close() -> None:
        nonlocal block
        if block.parts and any(not p.isspace() for p in block.parts):
            found.append(block)
        near = next((n for n in reversed(stack) if n.tag in BLOCKS), root)
        block = Block(near)

    def text(raw: str) -> None:
        if raw and not stack[-1].hidden:
            # The innermost element's hints count, also if it is an inline one.
            if not block.parts:
                block.node = stack[-1]
            block.parts.append(raw)
            if stack[-1].link:
                block.linked += len(raw.strip())

    at = 0
    while True:
        mark = _MARK.search(html, at)
        if mark is None:
            text(html[at:])
            break
        text(html[at : mark.start()])
        at = mark.end()
        slash, tag, attributes = mark.group(1), mark.group(2), mark.group(3)
        if tag is None:
            slash, tag, attributes = mark.group(4), mark.group(5), mark.group(6)
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            # An end tag does not close the containers around it but its own.
            if depth and (
                tag in SCOPE or not any(n.tag in SCOPE for n in stack[depth + 1 :])
            ):
                if any(n.tag in BLOCKS for n in stack[depth:]):
                    close()
                del stack[depth:]
            elif tag == "p":
                close()
            continue
        if tag in ENDS_P or tag in SIBLINGS:
            kinds = SIBLINGS.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in kinds:
                    close()
                    del stack[i:]
                    if stack[-1].tag not in kinds:
                        break
                elif stack[i].tag in SCOPE or stack[i].tag == "div":
                    break
        if tag in BLOCKS:
            close()
        elif tag == "br":
            text(" ")
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>]|$)", re.IGNORECASE).search(html, at)
            at = html.find(">", end.end()) + 1 if end else len(html)
            at = at or len(html)
            continue
        if tag == "body" and len(stack) > 1:
            stack[1:] = [n for n in stack[1:] if n.tag != "head"]
        stack.append(_opened(tag, attributes, stack[-1]))
    close()
    return found


def leaning(block: Block, text: str) -> float:
    """The classifier: above 0 for content, below for boilerplate."""
    node, size = block.node, len(text)
    score = node.home - node.away
    score += min(3.0, size / 60) + 0.5
    if _LEGAL.match(text):
        score -= 4
    density = block.linked / max(1, size)
    if density > 0.5:
        score -= 5 * density
    if node.tag in ("p", "pre", "blockquote", "h1"):
        score += 1.5
    elif node.tag in ("li", "td", "th", "dt", "option"):
        score -= 1
    return score


def ties_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Ties of neighbours, weaker across more levels of the tree, and of siblings."""
    ties = []
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            a, b, steps = blocks[i - 1].node, block.node, 0
            while a is not b:
                if a.depth >= b.depth:
                    a = a.parent
                else:
                    b = b.parent
                steps += 1
            ties.append((i - 1, i, 2.0 / (1 + steps)))
        parent = block.node.parent or block.node
        before = last.get(id(parent))
        if before is not None and before != i - 1:
            ties.append((before, i, 0.5))
        last[id(parent)] = i
    return ties


def label(scores: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Content or not, at the least cost: |score| of blocks that go against their score,
    plus the ties between blocks of different labels. Ties in cost go to content."""
    own = [s + 1e-6 for s in scores]
    near: list[dict[int, float]] = [{} for _ in own]
    for i, j, weight in ties:
        near[i][j] = near[i].get(j, 0) + weight
        near[j][i] = near[j].get(i, 0) + weight
    fixed: list[bool | None] = [None] * len(own)
    waiting = deque(range(len(own)))
    while waiting:
        i = waiting.popleft()
        if fixed[i] is None and abs(own[i]) >= sum(near[i].values()):
            fixed[i] = own[i] > 0
            for j, weight in near[i].items():
                if fixed[j] is None:
                    own[j] += weight if fixed[i] else -weight
                    del near[j][i]
                    waiting.append(j)
    rest = [i for i, f in enumerate(fixed) if f is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        side = _cut(
            [own[i] for i in rest],
            [(place[i], place[j], w) for i in rest for j, w in near[i].items() if i < j and j in place],
        )
        for i, content in zip(rest, side):
            fixed[i] = content
    return fixed


def _cut(own: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut (flow in layers, by Dinic)."""
    source, sink = len(own), len(own) + 1
    head: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(len(own) + 2)]

    def edge(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(head))
        out[b].append(len(head) + 1)
        head.extend((b, a))
        room.extend((forth, back))

    for i, score in enumerate(own):
        if score > 0:
            edge(source, i, score, 0.0)
        else:
            edge(i, sink, -score, 0.0)
    for a, b, weight in ties:
        edge(a, b, weight, weight)
    while True:
        level = [-1] * len(out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-9 and level[head[e]] < 0:
                    level[head[e]] = level[a] + 1
                    queue.append(head[e])
        if level[sink] < 0:
            return [n >= 0 for n in level[: len(own)]]
        tried = [0] * len(out)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                at, path = source, []
                continue
            while tried[at] < len(out[at]):
                e = out[at][tried[at]]
                if room[e] > 1e-9 and level[head[e]] == level[at] + 1:
                    break
                tried[at] += 1
            else:
                if at == source:
                    break
                e = path.pop()
                at = head[e ^ 1]
                tried[at] += 1
                continue
            path.append(e)
            at = head[e]


def main_text(html: str | None) -> str:
    """The main text of a page: its content blocks, a line each."""
    if not html:
        return ""
    pairs = [(b, b.text()) for b in blocks_of(html)]
    pairs = [(b, t) for b, t in pairs if t]
    if not pairs:
        return ""
    chosen = [b for b, _ in pairs]
    labels = label([leaning(b, t) for b, t in pairs], ties_of(chosen))
    return "\n".join(t for (_, t), content in zip(pairs, labels) if content)


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Main text of each page: `key`, `url`, text and n_chars (code points).

    Null and empty pages, and pages of boilerplate alone, have an empty text. Every row
    has its own result, also repeated ones. Other columns of `pages` are not read.
    """

    def make():
        def act(keys, urls, texts):
            found = [main_text(t) for t in texts]
            return keys, urls, found, [len(t) for t in found]

        return act

    kind = pages.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, `{url}` string, text string, n_chars long"
    return map_slices(pages.select(key, url, html), out, make)
