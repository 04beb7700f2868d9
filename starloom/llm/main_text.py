"""Main text of web pages by a minimum cut.

A page is read into text blocks. A linear classifier gives each block a score for being content;
its size is the cost of the other label (terminal capacity). Blocks that follow each other and
blocks of one parent are tied by smoothness edges, weaker the further apart they are in the page's
tree. The labelling of least cost is a minimum cut, found by maximum flow.
"""

from __future__ import annotations

import functools
import html as html_module
import math
import re
from collections import deque
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_batches

# Element names of the HTML standard and words that pages use in class and id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre search section summary table tbody tfoot thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is neither text nor tags, up to their end tag or the end of the page.
RAW = frozenset(
    "script style noscript iframe textarea title noframes noembed xmp".split())
#: Elements with tags whose text is not shown; they end with their parent at the latest.
OPAQUE = frozenset("template svg math canvas object audio video select".split())
#: Elements that hold no article text.
ASIDE = frozenset("nav footer aside form dialog menu button label search fieldset legend".split())
MAIN = frozenset("article main".split())
#: Start tags that end an open element of the same group.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "tbody", "thead", "tfoot"),
    "thead": ("tr", "tbody", "thead", "tfoot"), "tfoot": ("tr", "tbody", "thead", "tfoot"),
}
#: What ENDS may not reach across.
SCOPE = OPAQUE | frozenset("ul ol dl table menu dir body article section div".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot adbox banner sponsor sponsored "
    "promo promotion sidebar rail widget cookie cookies consent gdpr notice notification alert "
    "popup modal overlay toast comment comments discussion disqus reply replies respond share "
    "sharing social follow related recommended recommendations more teaser trending popular "
    "newsletter subscribe subscription signup signin login breadcrumb breadcrumbs pagination pager "
    "menu nav navbar navigation navi topbar toolbar footer foot header masthead copyright legal "
    "disclaimer skip search form paywall tags taglist byline meta".split())
STATE_WORDS = frozenset("has with without no is".split())
CONTENT_WORDS = frozenset("article content post entry story main body text".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar".split())

# Weights of the classifier; a positive score speaks for content.
BASE, IN_MAIN, IN_ASIDE, NAMED_CONTENT = -0.6, 3.0, -7.0, 1.2
PARAGRAPH, TITLE, LIST_ITEM, PER_WORD, MOST_WORDS = 0.8, 0.3, -0.4, 0.45, 2.5
SENTENCE, LINKED, RIGHTS = 0.5, -3.5, -2.0
# Smoothness of neighbours in the page and of neighbours below one parent.
BESIDE, SIBLING = 1.2, 0.6

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")
#: One attribute after the other, each with its whole name and value.
_ATTRIBUTE = re.compile(
    r"""([^\s/=][^\s/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s"']\S*+)))?""")
#: A slash that ends a bare value does not close the tag.
_SLASH_IN_VALUE = re.compile(r"""=\s*+[^\s"'=]+/$""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE_END = re.compile(r"[.!?…。！？]")


@functools.lru_cache(maxsize=None)
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])", re.I)


@dataclass
class Block:
    """Text of a block, its score, and where it stands in the tree."""

    text: str
    score: float
    parent: int
    distance: int  # steps in the tree from the block before


class _Open:
    """An open element: what it hands down to the text in it."""

    __slots__ = ("name", "number", "aside", "main", "named", "hidden", "link")

    def __init__(self, name, number, above):
        self.name, self.number = name, number
        self.aside, self.main = (above.aside, above.main) if above else (0, 0)
        self.named, self.hidden = (above.named, above.hidden) if above else (0, False)
        self.link = above.link if above else False


def _attributes(element: _Open, text: str) -> None:
    for m in _ATTRIBUTE.finditer(text):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            element.hidden = True
        elif key == "style":
            style = value.lower().replace(" ", "")
            element.hidden |= "display:none" in style or "visibility:hidden" in style
        elif key == "role":
            if value.lower() in ASIDE_ROLES:
                element.aside = 2
            elif value.lower() in MAIN:
                element.main = 1
        elif key in ("class", "id"):
            words = {w.lower() for w in _NAME_WORD.findall(value)}
            against = BOILERPLATE_WORDS & words
            if element.name in ("html", "body") or not STATE_WORDS.isdisjoint(words):
                continue  # tells about the page, not about what is in the element
            if against == {"header"} and not CONTENT_WORDS.isdisjoint(words):
                continue  # the head of an article, not of the site
            if against:
                element.aside = 2
            elif not CONTENT_WORDS.isdisjoint(words):
                element.named = 1


class _Reader:
    """Reads a page in one pass; each sign is looked at a bounded number of times."""

    def __init__(self):
        self.stack: list[_Open] = [_Open("", 0, None)]
        self.levels: list[int] = []  # places of block elements in the stack
        self.opaque: list[int] = []  # places of opaque elements in the stack
        self.count: dict[str, int] = {}
        self.made = 0
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.lowest = 0  # least depth since the last block
        self.last_depth = 0

    def text(self, raw: str) -> None:
        if raw and not self.stack[-1].hidden:
            plain = html_module.unescape(raw) if "&" in raw else raw
            self.parts.append(plain)
            if self.stack[-1].link:
                self.linked += len(plain.replace(" ", ""))

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        if text:
            depth = len(self.levels)
            low = min(self.lowest, depth)
            top = self.stack[self.levels[-1]] if self.levels else self.stack[-1]
            above = self.stack[self.levels[-2]] if depth > 1 else self.stack[0]
            self.blocks.append(Block(
                text, _score(text, top, self.linked), above.number,
                self.last_depth - low + depth - low))
            self.last_depth = self.lowest = depth
        self.parts, self.linked = [], 0

    def push(self, name: str, attributes: str) -> None:
        block = name in BLOCK
        if block:
            if not self.opaque:
                self.flush()
            if self.levels and self.stack[self.levels[-1]].name == "p" and (
                    not self.opaque or self.opaque[-1] < self.levels[-1]):
                self.pop_to(self.levels[-1])
        if name in ENDS:
            self.end_open(ENDS[name])
        self.made += 1
        above = self.stack[-1]
        new = _Open(name, self.made, above)
        if name in MAIN:
            new.main = 1
            if above.aside == 1:  # an article inside a form is still one
                new.aside = 0
        elif name in ASIDE:
            new.aside = max(new.aside, 1 if name in ("form", "fieldset") else 2)
        elif name == "header" and not new.main:
            new.aside = 2
        elif name == "a":
            new.link = True
        elif name in OPAQUE:
            new.hidden = True
            self.opaque.append(len(self.stack))
        if attributes:
            _attributes(new, attributes)
        if block:
            self.levels.append(len(self.stack))
        self.stack.append(new)
        self.count[name] = self.count.get(name, 0) + 1

    def end_open(self, names: tuple[str, ...]) -> None:
        """Ends the nearest open element of these names, unless another scope lies between."""
        if not any(self.count.get(n) for n in names):
            return
        for at in range(len(self.stack) - 1, max(0, len(self.stack) - 64), -1):
            if self.stack[at].name in names:
                if not self.unseen(at):
                    self.flush()
                self.pop_to(at)
                return
            if self.stack[at].name in SCOPE:
                return

    def unseen(self, at: int) -> bool:
        """Whether the element at this place of the stack is opaque or lies in one that is."""
        return bool(self.opaque) and at >= self.opaque[0]

    def end(self, name: str) -> None:
        if name == "p" and not self.count.get("p"):
            if not self.opaque:
                self.flush()  # an end tag alone is an empty paragraph
            return
        if not self.count.get(name):
            return
        at = len(self.stack) - 1
        while self.stack[at].name != name:
            at -= 1
        if not self.unseen(at) and (name in BLOCK or self.levels and self.levels[-1] >= at):
            self.flush()
        self.pop_to(at)

    def pop_to(self, at: int) -> None:
        for element in self.stack[at:]:
            self.count[element.name] -= 1
        del self.stack[at:]
        while self.levels and self.levels[-1] >= at:
            self.levels.pop()
        while self.opaque and self.opaque[-1] >= at:
            self.opaque.pop()
        self.lowest = min(self.lowest, len(self.levels))

    def read(self, page: str) -> list[Block]:
        at, size = 0, len(page)
        while at < size:
            open_ = page.find("<", at)
            if open_ < 0:
                self.text(page[at:])
                break
            if open_ > at:
                self.text(page[at:open_])
            following = page[open_ + 1:open_ + 2]
            if page.startswith("<!--", open_):
                if page.startswith(">", open_ + 4) or page.startswith("->", open_ + 4):
                    at = page.index(">", open_) + 1
                    continue
                close = page.find("-->", open_ + 4)
                at = size if close < 0 else close + 3
            elif following in ("!", "?"):
                close = page.find(">", open_)
                at = size if close < 0 else close + 1
            elif following == "/":
                m = _NAME.match(page, open_ + 2)
                close = page.find(">", open_)
                if m:
                    self.end(m[0].lower())
                elif close == open_ + 2:
                    pass
                at = size if close < 0 else close + 1
            elif m := _NAME.match(page, open_ + 1):
                rest = _REST.match(page, m.end())
                close = rest.end() if page.startswith(">", rest.end()) else page.find(">", rest.end())
                if close < 0:
                    break
                at = close + 1
                name, inside = m[0].lower(), page[m.end():close]
                attributes = inside.rstrip("/ ")
                if inside.endswith("/") and (
                        name in ("svg", "math") or self.count.get("svg") or self.count.get("math")
                ) and not _SLASH_IN_VALUE.search(inside):
                    continue  # only in SVG and MathML a slash closes the element
                if name in VOID:
                    if name in BLOCK and not self.opaque:
                        self.flush()
                    elif name == "br":
                        self.parts.append(" ")
                elif name in RAW:
                    end = _end_of(name).search(page, at)
                    if end is None:
                        break
                    close = page.find(">", end.end())
                    at = size if close < 0 else close + 1
                else:
                    if name in ("td", "th"):
                        self.parts.append(" ")
                    self.push(name, attributes)
            else:
                self.text("<")
                at = open_ + 1
        self.flush()
        return self.blocks


def _score(text: str, top: _Open, linked: int) -> float:
    words = text.count(" ") + 1
    score = BASE + min(MOST_WORDS, PER_WORD * math.log2(1 + words))
    score += IN_ASIDE * (top.aside > 0) + IN_MAIN * top.main + NAMED_CONTENT * top.named
    if top.name in ("p", "blockquote", "pre"):
        score += PARAGRAPH
    elif top.name in HEADING:
        score += TITLE
    elif top.name in ("li", "dt", "dd", "tr"):
        score += LIST_ITEM
    if _SENTENCE_END.search(text):
        score += SENTENCE
    if linked:
        score += LINKED * min(1.0, linked / max(1, len(text) - words + 1))
    if "©" in text or "all rights reserved" in text.lower():
        score += RIGHTS
    return score


# -- labelling -----------------------------------------------------------------------------


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other and between neighbours below one parent."""
    edges = [(i - 1, i, BESIDE / max(1, b.distance)) for i, b in enumerate(blocks) if i]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        j = last.get(b.parent)
        if j is not None:
            edges.append((j, i, SIBLING))
        last[b.parent] = i
    return edges


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least cost; of equally good ones that with most content.

    A block whose score outweighs all its edges has its label in every minimum cut. It is settled
    first, and its edges become part of its neighbours' scores; maximum flow labels the rest.
    """
    n = len(scores)
    score = list(scores)
    beside: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    pull = [0.0] * n
    for i, j, w in edges:
        beside[i].append((j, w))
        beside[j].append((i, w))
        pull[i] += w
        pull[j] += w
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(score[i]) > pull[i] + 1e-9:
            label[i] = score[i] > 0
            for j, w in beside[i]:
                if label[j] is None:
                    score[j] += w if label[i] else -w
                    pull[j] -= w
                    queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        inner = [(place[i], place[j], w) for i, j, w in edges if i in place and j in place]
        for i, content in zip(rest, _flow([score[i] for i in rest], inner)):
            label[i] = content
    return label


def _flow(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Dinic's maximum flow from the content terminal to the boilerplate terminal.

    A block is content unless it still reaches the boilerplate terminal.
    """
    n = len(scores)
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(scores):
        if x > 0:
            add(s, i, x, 0.0)
        elif x < 0:
            add(i, t, -x, 0.0)
    for i, j, w in edges:
        add(i, j, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            break
        turn = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                least = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= least
                    room[e ^ 1] += least
                first = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(out[a][turn[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                turn[a] += 1
            else:
                break
    reaches = [False] * (n + 2)
    reaches[t] = True
    queue = deque([t])
    while queue:
        b = queue.popleft()
        for e in out[b]:
            a = to[e]
            if not reaches[a] and room[e ^ 1] > tiny:
                reaches[a] = True
                queue.append(a)
    return [not r for r in reaches[:n]]


def main_text(page: str) -> str:
    """The content blocks of a page, joined by an empty line."""
    blocks = _Reader().read(page)
    labels = minimum_cut([b.score for b in blocks], smoothness(blocks))
    return "\n\n".join(b.text for b, content in zip(blocks, labels) if content)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in column ``into``.

    A missing page counts as empty and gives an empty text, as does one without content. Equal pages
    get equal texts; a column named like ``into`` is replaced; an empty table gives no rows.
    """
    text_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def run(found: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in found.fillna("")], dtype=object)

    return pages.withColumn(into, run(html))
