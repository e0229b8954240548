"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into blocks, runs of text between block-level tags, each with its place in
the DOM. A linear classifier gives every block a log odds of being content, from the
region of the page that it stands in, its links, length and punctuation. The odds become
capacities to the source or the sink; blocks next to each other, and blocks of one parent,
are tied by edges that are the stronger the closer they are in the DOM. The minimum cut of
that graph is the labelling that costs least: short paragraphs follow their neighbours,
while menus, notices or comments between paragraphs are cut out.

Hidden elements and elements for menus, asides or controls are taken out by a cost that
nothing outweighs. A class word such as ``sidebar`` or a form costs a fixed amount, and
nothing around nearly all text of the page: an aside has something beside it.

Every block of the page is labelled and kept whole or dropped whole. Null and empty html,
and pages without text, give an empty text. Broken html is read as far as it goes: a tag
cut off at the end counts as a tag, a ``<`` that opens none is text. Pages are independent
of each other; columns besides the html are passed on unread.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements of html by their part in a page: fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNREAD = frozenset(
    "audio canvas head iframe math noframes noscript object script style svg template textarea"
    " title video xmp".split()
)
RAW = frozenset("iframe noframes noscript script style textarea title xmp".split())
ASIDE = frozenset(
    "aside button dialog fieldset footer label menu nav search select".split()
)
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A start tag of the key closes an open element of the value within the same parent.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# Words of classes, ids and roles: fixed values.
BAD_WORDS = frozenset(
    "ad ads adsense advert advertisement adverts advertising alert banner breadcrumb breadcrumbs"
    " comment comments commentlist complementary consent contentinfo cookie cookies copyright"
    " disclaimer disqus foot footer form gdpr legal login masthead menu menubar modal nav navbar"
    " navigation newsletter notice notification outbrain overlay pager pagination popup promo"
    " promotion recommended related replies reply respond search share sharing sidebar signup skip"
    " social sponsor sponsored subscribe taboola toolbar widget".split()
)
GOOD_WORDS = frozenset("article articlebody content entry main post story".split())
#: Words that make the rest of a class name a statement about the page: ``has-sidebar``.
ABOUT = frozenset("has no with without".split())
NOTES = re.compile(r"©|\bcookies?\b|all rights reserved", re.IGNORECASE)

# The classifier: log odds of content, in hundredths.
BIAS, IN_ARTICLE, IN_CONTENT, IN_ASIDE = -50, 300, 150, -1500
#: Cost inside an element with a bad word or a form; in full up to that share of the page's
#: text without links, and falling to none at the other.
SOFT, PART, WHOLE = -500, 0.75, 0.95
PER_CHAR, MOST_CHARS, SENTENCE, HEADING = 0.5, 400, 50, 50
LINKS, LINKS_IN_ARTICLE, NOTE = -400, -200, -150
#: Cost of a boundary between two blocks at DOM distance 0, and between two of one parent.
NEXT, SAME_PARENT = 150, 60

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|\Z)",
    re.DOTALL,
)
# A quoted string without a name is read over.
ATTRIBUTE = re.compile(
    r"\"[^\"]*\"|'[^']*'|([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?"
)
#: Elements with children that a slash makes empty, and that slash: not one of a value.
FOREIGN = ("svg", "math")
EMPTY = re.compile(r"(?:^|[\s\"'])/$")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)]*(?:\s|$)")


class Place:
    """A block element of the page, known by its parent and depth."""

    __slots__ = ("parent", "depth")

    def __init__(self, parent: Place | None) -> None:
        self.parent = parent
        self.depth = parent.depth + 1 if parent else 0


def apart(a: Place, b: Place) -> int:
    """Steps in the tree from one place to the other."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


@dataclass
class Block:
    text: str
    odds: int
    place: Place


class _Open:
    """An open element: its tag, the region it makes, what costs inside and where it is."""

    __slots__ = ("tag", "region", "unread", "soft", "place", "heading", "block")

    def __init__(
        self, tag: str, region: int, unread: bool, soft: int, place: Place, heading: bool, block: int
    ) -> None:
        self.tag, self.region, self.unread = tag, region, unread
        self.soft = soft  # number of the innermost element around that costs, 0 without one
        self.place, self.heading = place, heading
        self.block = block  # where the innermost open block element is, -1 without one


def attributes_of(raw: str) -> dict[str, str]:
    """Attributes of a start tag by name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(raw):
        if name:
            out.setdefault(name.lower(), value.strip("\"'"))
    return out


def words_of(value: str) -> set[str]:
    """Words of the names in a class, id or role."""
    out: set[str] = set()
    for name in value.split():
        for word in WORD.findall(name):
            if word.lower() in ABOUT:
                break
            out.add(word.lower())
    return out


def region_of(tag: str, raw: str, parent: int) -> tuple[int, bool]:
    """Odds by the region that an element makes, inside one with the odds ``parent``, and
    whether it costs besides."""
    if parent == IN_ASIDE or tag in ASIDE:
        return IN_ASIDE, False
    if tag == "header" and parent < IN_ARTICLE:
        return IN_ASIDE, False
    words: set[str] = set()
    if raw and tag not in ("html", "body"):
        found = attributes_of(raw)
        if (
            "hidden" in found
            or found.get("aria-hidden", "").lower() == "true"
            or re.search(r"display\s*:\s*none", found.get("style", ""), re.IGNORECASE)
        ):
            return IN_ASIDE, False
        words = words_of(" ".join(found.get(name, "") for name in ("class", "id", "role")))
    good = not GOOD_WORDS.isdisjoint(words)
    bad = not BAD_WORDS.isdisjoint(words)
    if tag == "main" or (tag in ARTICLE and not bad):
        return IN_ARTICLE, bad and not good
    if tag == "form" or (bad and not good):
        return IN_CONTENT if good else 0, True
    return max(parent, IN_CONTENT) if good else parent, False


def soft_cost(share: float) -> float:
    """What it costs to be in an element with a bad word, by its share of the page's text."""
    return SOFT * min(1.0, max(0.0, (WHOLE - share) / (WHOLE - PART)))


def odds_of(text: str, linked: int, region: int, heading: bool) -> int:
    """The classifier: log odds in hundredths that a block is content."""
    odds = BIAS + region + PER_CHAR * min(len(text), MOST_CHARS)
    odds += (LINKS_IN_ARTICLE if region == IN_ARTICLE else LINKS) * min(1.0, linked / len(text))
    if SENTENCE_END.search(text):
        odds += SENTENCE
    if heading:
        odds += HEADING
    if len(text) < MOST_CHARS and region < IN_ARTICLE and NOTES.search(text):
        odds += NOTE
    return round(odds)


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order."""
    out: list[Block] = []
    soft_of: list[int] = []  # of each block
    outer: dict[int, int] = {0: 0}  # elements that cost, with the next such around each
    inside: Counter[int] = Counter()  # letters without links in each of them
    total = 0
    stack: list[_Open] = []
    opened: Counter[str] = Counter()  # open elements by tag
    root = Place(None)
    parts: list[str] = []
    linked, number, at = 0, 0, 0
    # Text belongs to the block that was open when its first piece came, and to the region
    # that holds most of its letters.
    place: tuple[Place, bool] | None = None
    regions: Counter[tuple[int, int]] = Counter()

    def text_piece(raw: str) -> None:
        nonlocal linked, place
        if stack and stack[-1].unread:
            return
        if place is None and raw.strip():
            place = (stack[-1].place, stack[-1].heading) if stack else (root, False)
        parts.append(raw)
        regions[(stack[-1].region, stack[-1].soft) if stack else (0, 0)] += len(raw.strip())
        if opened["a"]:
            linked += len(raw)

    def end_block() -> None:
        nonlocal linked, place, total
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text and place:
                where, heading = place
                region, soft = max(regions, key=regions.__getitem__)
                out.append(Block(text, odds_of(text, linked, region, heading), where))
                soft_of.append(soft)
                if region != IN_ASIDE:
                    letters = max(0, len(text) - linked)
                    total += letters
                    inside[soft] += letters
            parts.clear()
        regions.clear()
        linked, place = 0, None

    def close(depth: int) -> None:
        for e in stack[depth:]:
            opened[e.tag] -= 1
        del stack[depth:]

    while True:
        tag = TAG.search(page, at)
        if tag is None:
            text_piece(page[at:])
            break
        text_piece(page[at : tag.start()])
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS:
            end_block()
        elif name == "br":
            parts.append(" ")
        if tag[1]:
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == name))
            continue
        if name in BLOCKS and name not in ("option",):
            depth = stack[-1].block if stack else -1
            if depth >= 0 and stack[depth].tag == "p":
                close(depth)
        if name in CLOSES and any(opened[tag] for tag in CLOSES[name]):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag in CLOSES[name]:
                    close(depth)
                    break
                if stack[depth].tag in ("ul", "ol", "dl", "table", "menu", "select"):
                    break
        if name == "body" and stack and stack[-1].unread:
            close(next(i for i, e in enumerate(stack) if e.unread))  # a head left open
        foreign = name in FOREIGN or any(opened[tag] for tag in FOREIGN)
        if name in VOID or (foreign and EMPTY.search(tag[3])):
            continue
        parent = stack[-1] if stack else None
        unread = name in UNREAD or bool(parent and parent.unread)
        region, costs = region_of(name, tag[3], parent.region if parent else 0)
        number += 1
        soft = parent.soft if parent else 0
        if costs:
            outer[number] = soft
            soft = number
        inner, heading, block = (parent.place, parent.heading, parent.block) if parent else (root, False, -1)
        if name in BLOCKS:
            inner, block = Place(inner), len(stack)
        stack.append(_Open(name, region, unread, soft, inner, heading or name in HEADINGS, block))
        opened[name] += 1
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
    end_block()
    for element in sorted(outer, reverse=True)[:-1]:
        inside[outer[element]] += inside[element]
    # The innermost holds the least and so costs the most.
    for block, soft in zip(out, soft_of, strict=True):
        if soft:
            block.odds += round(soft_cost(inside[soft] / max(1, total)))
    return out


def smoothness(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Edges between blocks: next to each other, or of one parent, with their capacities."""
    edges = []
    last: dict[Place, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT * 2 // (2 + apart(blocks[i - 1].place, block.place))))
        parent = block.place.parent or block.place
        if last.get(parent, i - 1) < i - 1:
            edges.append((last[parent], i, SAME_PARENT))
        last[parent] = i
    return edges


def minimum_cut(odds: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut, by Dinic's maximum flow.

    A node with positive odds takes that much from the source, one with negative odds
    passes as much on to the sink; edges run both ways. Nodes that could be on either
    side are on the sink's.
    """
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(odds):
        if x > 0:
            join(source, i, x, 0)
        elif x < 0:
            join(i, sink, -x, 0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        row = [source]
        for u in row:
            for e in out[u]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    row.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if not room[e])
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[u] < len(out[u]):
                e = out[u][turn[u]]
                if room[e] and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            if turn[u] < len(out[u]):
                path.append(out[u][turn[u]])
                u = to[path[-1]]
            elif path:
                level[u] = -1
                u = to[path.pop() ^ 1]
            else:
                break


def main_text(page: str) -> str:
    """The blocks of a page that the cut labels as content, one to a line."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    content = minimum_cut([b.odds for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, content, strict=True) if keep)


def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([main_text(p) for p in batch], dtype=object)


def extracted(html: str = "html") -> Column:
    """Column with the main text of a html column; null html counts as empty."""
    return F.pandas_udf(_extract, "string")(F.coalesce(F.col(html), F.lit("")))
