"""Main-text extraction by minimum cuts.

A page is read as a sequence of text blocks, each with the elements it stands
in. A small classifier gives every block a cost of calling it content and a cost
of calling it boilerplate (link share, length, sentence ends, and what the
elements around it say). These costs are capacities to the two terminals of a
graph; neighbouring blocks, and blocks of the same container, are joined by
smoothness edges. The minimum cut is the labelling of least total cost: short
blocks follow their surroundings, and firm evidence (navigation, scripts,
forms) holds against them.

White space inside a block becomes one space; blocks are joined by \\n; nothing
else is changed or cut. Null or empty html, or a page without content: empty
text. Unclosed, stray and truncated tags are accepted as browsers do, roughly.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
HIDDEN = frozenset("script style noscript template title svg math iframe object canvas audio video textarea select option datalist".split())
RAW = frozenset("script style noscript template title iframe textarea".split())
FRAME = frozenset("nav header footer aside form menu dialog button fieldset label".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the first kind ends when one of the second begins.
ENDS_BEFORE = {
    "p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 article section main aside header footer nav form blockquote pre hr figure address fieldset".split()),
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option"}),
}
# Words in class, id and role that name parts of a page's frame.
FRAME_WORDS = frozenset(
    "ad ads advert advertisement banner sponsor sponsored promo popup modal cookie cookies consent gdpr notice alert nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar side widget related recommended share sharing social footer foot header "
    "masthead comment comments discussion disqus replies reply respondent newsletter subscribe signup login search form "
    "pagination pager tags toolbar copyright legal complementary contentinfo".split()
)
MAIN_WORDS = frozenset("article content main post story entry body text".split())

_token = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</(?![a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_named = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_hidden = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_part = re.compile(r"[a-z]+")
_white = re.compile(r"\s+")
_sentence = re.compile(r"[.!?…。](?=\s|$|[\"'»”)])")
_closers: dict[str, re.Pattern] = {}


class Block:
    """A run of text without a block element inside, and where it stands."""

    __slots__ = ("frame", "heading", "in_main", "linked", "main_word", "parent", "text")

    def __init__(self, text, linked, frame, in_main, main_word, heading, parent):
        self.text, self.linked, self.frame, self.in_main = text, linked, frame, in_main
        self.main_word, self.heading, self.parent = main_word, heading, parent


def _attribute_words(attrs: str) -> set[str]:
    return {w for m in _named.finditer(attrs) for w in _part.findall((m[1] or m[2] or m[3] or "").lower())}


def page_blocks(page: str) -> list[Block]:
    """Text blocks in page order; what is never shown is left out."""
    out: list[Block] = []
    # an open element: (name, block container number, frame depth, main, main word, heading, hidden)
    stack = [("", 0, 0, False, False, False, False)]
    text: list[str] = []
    linked = depth_a = at = containers = 0

    def flush():
        nonlocal linked
        if text:
            s = _white.sub(" ", "".join(text)).strip()
            if s:
                name, parent, frame, main, word, heading, _ = stack[-1]
                out.append(Block(s, linked, frame, main, word, heading, parent))
            text.clear()
        linked = 0

    def say(raw: str):
        nonlocal linked
        if raw and not stack[-1][6]:
            s = entities.unescape(raw) if "&" in raw else raw
            text.append(s)
            if depth_a:
                linked += len(s.strip())

    def close(k: int):
        nonlocal depth_a
        for e in stack[k:]:
            if e[0] == "a":
                depth_a -= 1
        del stack[k:]

    while True:
        m = _token.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        inline = name in INLINE
        if not inline:
            flush()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if inline and stack[k][0] not in INLINE:
                    break  # a stray end tag
            continue
        if name in VOID:
            continue
        while stack[-1][0] in INLINE and not inline and name in ENDS_BEFORE["p"]:
            close(len(stack) - 1)  # a block inside an unclosed inline element
        if name in ENDS_BEFORE.get(stack[-1][0], ()):
            close(len(stack) - 1)
        if m[3].rstrip().endswith("/") and name in RAW:
            continue
        if name in RAW:
            end = _closers.setdefault(name, re.compile(rf"</{name}\b[^>]*>?", re.I)).search(page, at)
            at = end.end() if end else len(page)
            continue
        _, parent, frame, main, word, heading, hidden = stack[-1]
        words = _attribute_words(m[3]) if "=" in m[3] else ()
        if not inline:
            containers += 1
            parent = parent if name in ("p", "br", "hr") or name in HEADINGS else containers
        frame += 2 * (name in FRAME and not (name == "header" and main))
        if words and name not in ("body", "html") and MAIN_WORDS.isdisjoint(words):
            frame += 2 * (not FRAME_WORDS.isdisjoint(words))
        if name in MAIN or "main" in words and name == "div":
            main = True
        word = word or bool(words and not MAIN_WORDS.isdisjoint(words))
        hidden = hidden or name in HIDDEN or bool(m[3] and _hidden.search(m[3]))
        if name == "a":
            depth_a += 1
        stack.append((name, parent, frame, main, word, heading or name in HEADINGS, hidden))
    flush()
    return out


# Weights of the block classifier: positive speaks for content.
WEIGHTS = {"main": 4.0, "main_word": 1.0, "frame": -6.0, "linked": -3.0, "long": 0.6, "sentences": 0.8, "heading": 0.5, "outside": -3.0, "bias": 0.2}
SMOOTH, SAME_CONTAINER = 0.5, 0.7


def evidence(b: Block, marked: bool) -> float:
    """Log odds of content. marked: the page marks its main part somewhere."""
    n, w = len(b.text), WEIGHTS
    return (
        w["bias"] + w["main"] * b.in_main + w["outside"] * (marked and not b.in_main) + w["main_word"] * b.main_word + w["frame"] * b.frame + w["linked"] * min(1, b.linked / n)
        + w["long"] * min(4, n / 80) + w["sentences"] * min(3, len(_sentence.findall(b.text))) * (b.linked * 2 < n)
        + w["heading"] * b.heading
    )


def minimum_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Labels of least cost: a node with odds z pays z for false (z > 0) or -z
    for true (z < 0), an edge its weight when its ends differ. Shortest
    augmenting paths by levels; the source side of the residual graph is true."""
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for i, z in enumerate(odds):
        if z > 0:
            link(source, i, z, 0.0)
        elif z < 0:
            link(i, sink, -z, 0.0)
    for (a, b), w in edges.items():
        link(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, [source]
        for u in queue:
            for e in out[u]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                k = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[u] < len(out[u]):
                e = out[u][turn[u]]
                if room[e] > 1e-9 and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            if turn[u] < len(out[u]):
                path.append(out[u][turn[u]])
                u = to[path[-1]]
            elif u == source:
                break
            else:
                level[u] = -1
                u = to[path.pop() ^ 1]


def main_text(page: str | None) -> str:
    found = page_blocks(page or "")
    edges: dict[tuple[int, int], float] = {}
    latest: dict[int, int] = {}
    for i, b in enumerate(found):
        if i and (b.frame > 0) == (found[i - 1].frame > 0):
            edges[i - 1, i] = SMOOTH
        k = latest.get(b.parent)
        if k is not None and (b.frame > 0) == (found[k].frame > 0):
            edges[k, i] = edges.get((k, i), 0.0) + SAME_CONTAINER
        latest[b.parent] = i
    marked = any(b.in_main for b in found)
    content = minimum_cut([evidence(b, marked) for b in found], edges)
    return "\n".join(b.text for b, good in zip(found, content, strict=True) if good)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """All columns of pages, text and n_chars."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in parts:
            yield pd.Series([main_text(p) for p in column], dtype=object)

    pages = pages.drop("text", "n_chars") if html not in ("text", "n_chars") else pages
    return pages.withColumn("text", F.pandas_udf(run, "string")(html)).withColumn("n_chars", F.length("text").cast("long"))
