"""HTML extraction by minimum cut: blocks of a page are labelled content or boilerplate together."""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements whose content is never text of the page: raw text, which only its end tag or the end of
#: the page ends, and others, which count only if they are closed before the next of their name.
RAW = frozenset("script style title textarea".split())
CLOSED = frozenset("noscript template select button iframe object svg canvas audio video".split())
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
NEXT = {name: re.compile(rf"<{name}\b|</{name}\s*>", re.IGNORECASE) for name in CLOSED}
TAG = re.compile(r"<(?:(?P<comment>!--)|(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)|[/!?])")
ATTRIBUTES = re.compile(r"[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+>")
#: Elements that begin and end blocks of text.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary
table tbody td tfoot th thead tr ul""".split())
#: Inline elements that are blank space in a line, and elements without content.
SPACES = frozenset(["br", "wbr", "img", "input", "hr"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("html head meta link title base script style noscript template".split())
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.IGNORECASE)
UNSEEN = re.compile(r"display\s*:\s*none|\baria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)")
#: Elements whose names speak of the page and not of its text; first parts that turn a name round.
WHOLE, TURNED = frozenset(["html", "body"]), frozenset("no not has with without is hide".split())
#: What an element says about the text in it, in log odds of content.
OF_TAG = {"article": 4.0, "main": 2.5, "nav": -7.0, "aside": -6.0, "footer": -7.0, "form": -6.0, "header": -5.0,
          "menu": -6.0, "dialog": -5.0, "figure": -1.0, "fieldset": -3.0}
OF_NAME = [
    (re.compile(r"^(ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|"
                r"newsletter|subscribe|signup|login|side|sidebar|menu|nav|navbar|navigation|navmenu|breadcrumbs?|pagination|pager|"
                r"footer|foot|masthead|topbar|toolbar|header|share|sharing|social|related|recommend\w*|widget|comments?|"
                r"commentlist|respond|replies|reply|disqus|feedback|search|form|contentinfo|complementary|banner|skip|legal|"
                r"copyright|disclaimer|tags?|byline|meta)$"), -6.0),
    (re.compile(r"^(article|articlebody|post|entry|story|content|main|maincontent|body|text|prose)$"), 1.5),
]
#: Strength of the bonds between neighbours in the page and in the tree.
ADJACENT, SIBLING = 0.6, 0.5


def tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``(start, end, name, closing, attributes)`` of the tags of a page; no name for what is passed over.

    Every search goes on where the last one ended, or is not made again once it has reached the end of
    the page in vain. So the time grows with the page, however broken it is.
    """
    at, last, quoted, none_left = 0, html.rfind(">"), True, set()
    while (m := TAG.search(html, at)) is not None:
        name, start = (m["name"] or "").lower(), m.start()
        if m["comment"]:
            at = html.find("-->", m.end())
            at = len(html) if at < 0 else at + 3
            yield start, at, "", False, ""
            continue
        if start > last:  # no tag ends any more
            at = m.end()
            continue
        end = html.find(">", m.end()) + 1
        if not name:
            at = end
            yield start, at, "", False, ""
            continue
        if name in RAW and not m["end"]:
            found = RAW_END[name].search(html, end)
            at = found.end() if found else len(html)
            yield start, at, "", False, ""
            continue
        if name in CLOSED and not m["end"] and html[end - 2] != "/" and name not in none_left:
            found = NEXT[name].search(html, end)
            if found and html[found.start() + 1] == "/":
                at = found.end()
                yield start, at, "", False, ""
                continue
            if not found:
                none_left.add(name)
        if quoted:
            found = ATTRIBUTES.match(html, m.end())
            # a quote that nothing closes: from here on a tag ends with the next bracket
            quoted, end = found is not None, found.end() if found else end
        at = end
        yield start, at, name, bool(m["end"]), html[m.end():at - 1]


@dataclass
class Block:
    """A block of text, the number of the element around its own, the depth of its own, and how deep
    the elements are that it shares with the block before."""

    text: str
    tag: str
    parent: int
    depth: int
    shared: int
    odds: float
    linked: float


def names_odds(attributes: str) -> float:
    """Log odds of the names of an element; the last part of a hyphenated name says what it is, and
    each meaning counts once."""
    names = [w for v in NAMED.findall(attributes) for w in v.lower().strip("\"'").split()]
    hidden = HIDDEN.search(VALUE.sub("= ", attributes)) or UNSEEN.search(attributes) or "hidden" in names
    meanings = set()
    for name in names:
        words = re.findall(r"[a-z0-9]+", name)
        if words and words[0] not in TURNED:
            meanings |= {next((o for pattern, o in OF_NAME if pattern.match(words[-1])), 0.0)}
    return max(sum(meanings) - (5.0 if hidden else 0.0), -9.0)


def blocks_of(html: str) -> list[Block]:
    """Blocks of text in page order, with what their elements say about them.

    Unclosed and stray tags are taken as they come: an end tag closes the nearest open element of
    its name, a paragraph ends where the next block begins.
    """
    out: list[Block] = []
    stack: list[tuple[str, int, float]] = []  # name, number, log odds so far
    pieces: list[tuple[str, bool]] = []
    number, links, at, in_head, shared = 0, 0, 0, False, 0
    opened: Counter[str] = Counter()

    def flush() -> None:
        nonlocal shared
        if pieces:
            text = " ".join(unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = sum(len(p) for p, l in pieces if l) / max(1, sum(len(p) for p, _ in pieces))
                tag = stack[-1][0] if stack else ""
                parent = stack[-2][1] if len(stack) > 1 else 0
                out.append(Block(text, tag, parent, len(stack), shared, stack[-1][2] if stack else 0.0, linked))
                shared = len(stack)
            pieces.clear()

    for start, end, name, closing, attributes in tags(html):
        if start > at and not in_head:
            pieces.append((html[at:start], links > 0))
        at = end
        if not name:
            continue
        if name == "head":
            in_head = not closing
        elif in_head and not closing and name not in HEAD:
            in_head = False
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        elif name in SPACES and name not in BLOCKS:
            pieces.append((" ", links > 0))
        elif name in BLOCKS:
            flush()
            links = 0
            if closing:
                while opened[name]:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
            elif name not in VOID:
                if stack and stack[-1][0] == "p":
                    stack.pop()
                    opened["p"] -= 1
                shared = min(shared, len(stack))
                number += 1
                odds = (stack[-1][2] if stack else 0.0) + OF_TAG.get(name, 0.0) + (names_odds(attributes) if name not in WHOLE else 0.0)
                stack.append((name, number, odds))
                opened[name] += 1
            shared = min(shared, len(stack))
    if at < len(html) and not in_head:
        pieces.append((html[at:], links > 0))
    flush()
    return out


def content_odds(block: Block) -> float:
    """The classifier: log odds that a block is content, from its elements, links and length."""
    odds = max(-12.0, min(12.0, block.odds)) - 3.5 * block.linked
    odds += {"p": 1.0, "pre": 1.0, "blockquote": 1.0, "h1": 0.8, "h2": 0.6, "h3": 0.4}.get(block.tag, 0.0)
    odds += min(2.0, math.log1p(len(block.text) / 80)) - 0.8
    if "©" in block.text[:40]:
        odds -= 3.0
    return odds


def costs(odds: float) -> tuple[float, float]:
    """Cost of calling a block boilerplate, and of calling it content: minus log probabilities."""
    soft = lambda x: math.log1p(math.exp(-abs(x))) + max(x, 0.0)
    return soft(odds), soft(-odds)


def bonds(blocks: Sequence[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in the page, weaker the further apart in the tree, and the next
    block under the same parent."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            out.append((i - 1, i, ADJACENT / max(1, b.depth + blocks[i - 1].depth - 2 * b.shared - 1)))
        if b.parent in last:
            out.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    return out


def cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Sides of a minimum cut, True for the source's: the cheapest labels of all nodes together.

    ``source[i]`` is paid if i is on the sink's side, ``sink[i]`` otherwise, an edge's weight if its
    ends differ. A node whose own costs differ by more than all its open edges together takes
    the cheaper side in any minimum; those are settled first, and their edges become costs of
    the others. Maximum flow separates what stays open.
    """
    n = len(source)
    gain, slack, near = [a - b for a, b in zip(source, sink)], [0.0] * n, [[] for _ in range(n)]
    for i, j, w in edges:
        near[i].append((j, w))
        near[j].append((i, w))
        slack[i] += w
        slack[j] += w
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is None and abs(gain[i]) >= slack[i]:
            side[i] = gain[i] > 0
            for j, w in near[i]:
                if side[j] is None:
                    gain[j] += w if side[i] else -w
                    slack[j] -= w
                    todo.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        reached = flow(rest, gain, near, side)
        for i in rest:
            side[i] = i in reached
    return [bool(s) for s in side]


def flow(nodes: list[int], gain: list[float], near: list[list[tuple[int, float]]], side: list) -> set[int]:
    """Nodes that the source still reaches after a maximum flow by shortest augmenting paths."""
    s, t = -1, -2
    left: dict[int, dict[int, float]] = {i: {} for i in [*nodes, s, t]}
    for i in nodes:
        if gain[i] > 0:
            left[s][i], left[i][s] = gain[i], 0.0
        elif gain[i] < 0:
            left[i][t], left[t][i] = -gain[i], 0.0
        for j, w in near[i]:
            if side[j] is None:
                left[i][j] = left[i].get(j, 0.0) + w
                left[j].setdefault(i, 0.0)
    while True:
        came, queue = {s: s}, deque([s])
        while queue and t not in came:
            i = queue.popleft()
            for j, c in left[i].items():
                if c > 1e-12 and j not in came:
                    came[j] = i
                    queue.append(j)
        if t not in came:
            return set(came) - {s}
        path, j = [], t
        while j != s:
            path.append((came[j], j))
            j = came[j]
        push = min(left[i][j] for i, j in path)
        for i, j in path:
            left[i][j] -= push
            left[j][i] = left[j].get(i, 0.0) + push


def main_text(html: str | None) -> str:
    """The blocks on the content side of the cut, in page order, two line feeds between them."""
    blocks = blocks_of(html) if html else []
    priced = [costs(content_odds(b)) for b in blocks]
    # calling a block boilerplate costs as much as it looks like content
    content = cut([a for a, _ in priced], [b for _, b in priced], bonds(blocks))
    return "\n\n".join(b.text for b, kept in zip(blocks, content) if kept)


def extracted(html: Column) -> Column:
    """The main text of each page; null and empty pages give an empty text."""
    @F.arrow_udf("string")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return each(html)


def extract(pages: DataFrame, *, html: str = "html", id: str = "page_id", url: str = "url") -> DataFrame:
    """``(id, url, text)`` of every page, from its whole html.

    White space within a block, also that of character references, is one blank. A page without
    content gives an empty text. Repeated rows stay rows, a null id or url stays null; other
    columns are not looked at.
    """
    return pages.select(F.col(id), F.col(url), extracted(F.col(html)).alias("text"))
