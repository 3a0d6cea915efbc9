"""The main text of web pages by line-block distribution.

Markup is stripped to lines, one per block of the page. Elements that never hold the article (scripts,
menus, footers, forms, adverts, notices, comments) leave no text, unless they are found to hold the page's
article element or most of its text. Each line then has a block length: the characters in the window of lines
from it on, links not counted. Where the block length surges over a threshold and until it dives, lines are
kept: the article is the stretch with most text, and stretches not far shorter, looked for inside the page's
article element if it marks one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.batches import slices

# Element names of HTML.
_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
_RAW = frozenset("script style noscript template textarea iframe svg math object noembed noframes xmp".split())
_ASIDE = frozenset("nav footer aside form button select dialog menu".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = _BLOCKS - frozenset(["br", "body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"])
# Names of class, id or role tokens of parts that are not the article. One part of a token is enough for _PLAIN
# names; all parts of the token must be side names or _PARTS for the others, which also occur in names of wrappers.
_PLAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr newsletter "
    "subscribe subscription signup paywall popup breadcrumb breadcrumbs related recommended recommendations disqus commentlist".split()
)
_REPLIES = frozenset("comment comments commentlist disqus respond reply replies cookie cookies consent gdpr".split())
_FRAME = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer foot copyright contentinfo skip".split())
_WHOLE = _PLAIN | _REPLIES | _FRAME | frozenset(
    "banner notice notices alert modal overlay login sidebar side aside widget widgets share sharing social legal search masthead "
    "topbar toolbar tags pagination pager complementary".split()
)
_CARDS = _REPLIES | frozenset("ad advert sponsored promo related teaser".split())
_PARTS = frozenset(
    "site page main primary secondary list links link button buttons bar box area section block item items form icons icon post posts "
    "entry article articles stories body card thread div to".split()
)
_TELLING = frozenset("class id role hidden aria-hidden style".split())
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
_STATES = frozenset("has with no without category tag tagged topic type format status".split())
# A quote opens a value only right after the sign of equality; anywhere else it is a letter like others.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=\s*[^\s\"'>][^\s>]*|[^>])*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


# How surely an element is not the article: it may be a wrapper of it, it is only where the article element is
# in it, or never.
_SOFT, _FIRM, _NEVER = 1, 2, 3


class _Line:
    """`own` is the length outside links, 0 where links leave no letter or digit; `parent` is the number of the element
    that holds its paragraph or heading, -1 for other lines."""

    __slots__ = ("text", "own", "article", "parent")

    def __init__(self, text: str, own: int, article: bool, parent: int):
        self.text, self.own, self.article, self.parent = text, own, article, parent


class _Part:
    """A side element or an article element: the side and the article around it, its text outside links.

    `never` is set where it or an element around it never holds the article, `lost` where one of them is set aside.
    """

    __slots__ = ("level", "main", "side", "article", "size", "gone", "never", "lost")

    def __init__(self, level: int, main: bool, side: _Part | None, article: _Part | None):
        self.level, self.main, self.side, self.article, self.size, self.gone = level, main, side, article, 0, level > 0
        self.never = level == _NEVER or bool(side and side.never)
        self.lost = False


@lru_cache(maxsize=10_000)
def _named(value: str, card: bool) -> int:
    """The level that a class, id or role gives; a `card` is an article element, which wrapper names do not matter for."""
    level = 0
    for token in value.lower().split():
        names = {x for x in (part.rstrip("0123456789") for part in re.split("[-_]+", token)) if x}
        if names & _STATES:
            continue
        whole = names <= (_CARDS if card else _WHOLE) | _PARTS and not names <= _PARTS
        if whole or not card and names & _PLAIN:
            level = max(level, _NEVER if whole and names & _REPLIES else _FIRM if whole and names & _FRAME else _SOFT)
    return level


def _level(tag: str, attributes: str, in_article: bool) -> int:
    if tag in ("html", "body"):
        return 0
    level = (_SOFT if tag == "form" else _FIRM) if tag in _ASIDE else _SOFT if tag == "header" and not in_article else 0
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name = name.lower()
        if name not in _TELLING:
            continue
        value = "".join(values)
        if name in ("class", "id", "role"):
            if tag != "main":
                level = max(level, _named(value, tag == "article"))
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            level = max(level, _FIRM)
    return level


def _around(part: _Part) -> Iterator[_Part]:
    """The sides around a part, from the inside."""
    side = part.side
    while side:
        yield side
        side = side.side


def _mark_lost(parts: list[_Part]):
    """Parts stand in the order in which they open, so what is around one comes before it."""
    for x in parts:
        x.lost = (x.level > 0 and x.gone) or bool(x.side and x.side.lost)


def _spare(parts: list[_Part], total: int, free: int):
    """Take back that elements are set aside which hold the article, or most of the text of what they are in."""
    for x in reversed(parts):  # sizes of inner parts are part of the outer ones'
        if not x.never:
            outer = x.side if x.level else x.article
            if outer:
                outer.size += x.size
    articles = [x for x in parts if not x.level and not x.gone and not x.never]
    if articles:
        top = max(articles, key=lambda x: x.size)
        if top.main or top.size > free:
            for x in _around(top):
                x.gone = False
    _mark_lost(parts)
    marked = any(not x.lost for x in articles)
    for x in parts:
        if x.level == _SOFT and (x.article or not marked) and 2 * x.size > (x.article.size if x.article else total):
            x.gone = False
    _mark_lost(parts)


class _Open:
    """The open elements, and how many there are of each name: in all, and in the innermost table cell."""

    def __init__(self):
        self.stack: list[tuple] = []  # name, side, article, number
        self.named: dict[str, int] = {}
        self.cells: list[dict[str, int]] = [{}]

    def push(self, name: str, *rest):
        self.stack.append((name, *rest))
        self.named[name] = self.named.get(name, 0) + 1
        if name in _CELLS:
            self.cells.append({})
        else:
            self.cells[-1][name] = self.cells[-1].get(name, 0) + 1

    def pop(self) -> tuple:
        entry = self.stack.pop()
        self.named[entry[0]] -= 1
        if entry[0] in _CELLS:
            self.cells.pop()
        else:
            self.cells[-1][entry[0]] -= 1
        return entry

    def is_open(self, name: str, in_cell: bool) -> bool:
        return self.cells[-1].get(name, 0) > 0 if in_cell else self.named.get(name, 0) > 0


_CELLS = frozenset(["td", "th", "table"])
_TABLE = frozenset(["table", "tr", "tbody", "thead", "tfoot", "body", "html", "td", "th"])
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
_LISTS = frozenset(["ul", "ol", "dl", "menu", "table", "select"])


def lines_of(html: str) -> list[_Line]:
    """The lines of text of a page, without elements that never hold the article. Time is in proportion to the page."""
    pieces: list[tuple | None] = []  # text, whether in a link, side it is in, article, parent; None ends a line
    opened = _Open()
    stack = opened.stack
    parts: list[_Part] = []
    side: _Part | None = None
    article: _Part | None = None
    links = total = free = number = 0

    def end_line():
        if pieces and pieces[-1] is not None:
            pieces.append(None)

    def shut(down_to: int):
        nonlocal side, article, links
        while len(stack) > down_to:
            name, side, article, _ = opened.pop()
            links -= name == "a"

    def text_from(piece: str):
        nonlocal total, free
        if not piece:
            return
        parent = -1
        for name, _, _, above in stack[:-4:-1]:  # a paragraph, perhaps with emphasis in a link
            if name in _BLOCKS:
                parent = above if name in _PARAGRAPHS else -1
                break
        pieces.append((piece, links > 0, side, article, parent))
        size = 0 if links else len(piece.strip())
        if size and not (side and side.never):
            total += size
            if side:
                side.size += size
            else:
                free += size
            if article:
                article.size += size

    at, size = 0, len(html)
    while at < size:
        start = html.find("<", at)
        if start < 0:
            text_from(html[at:])
            break
        text_from(html[at:start])
        found = _TAG.match(html, start)
        if not found:
            text_from("<")
            at = start + 1
            continue
        at = found.end()
        if found[1] is not None:
            text_from(found[1].replace("&", "&amp;"))
            continue
        if not found[3]:
            continue
        tag, attributes = found[3].lower(), found[4]
        if found[2]:
            if tag in _BLOCKS:
                end_line()
            if opened.is_open(tag, tag not in _TABLE):
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                shut(i)
            continue
        if tag in _RAW or tag == "title" or tag == "head":
            if tag == "head":
                continue
            shown = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = shown.end() if shown else size
            continue
        if tag in _BLOCKS:
            end_line()
        if tag in _CLOSES_P and opened.is_open("p", True):
            # A new block ends an open paragraph, and whatever was opened in it.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    shut(i)
                    break
                if stack[i][0] in _BLOCKS:
                    break
        same = _SIBLINGS.get(tag, ())
        if any(opened.is_open(x, False) for x in same):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in same:
                    shut(i)
                    break
                if stack[i][0] in _LISTS:
                    break
        if tag in _VOID or attributes.rstrip().endswith("/") and tag not in _BLOCKS:
            continue
        level = _level(tag, attributes, article is not None)
        opened.push(tag, side, article, stack[-1][3] if tag in _PARAGRAPHS and stack else number)
        number += 1
        links += tag == "a"
        if level:
            side = _Part(level, False, side, article)
            parts.append(side)
        if tag in ("article", "main"):
            article = _Part(0, tag == "main", side, article)
            article.gone = level > 0  # set aside itself, so no candidate
            parts.append(article)
    end_line()
    if any(x.level for x in parts):
        _spare(parts, total, free)

    lines: list[_Line] = []
    line: list[tuple] = []
    for piece in pieces:
        if piece is not None:
            if not (piece[2] and piece[2].lost):
                line.append(piece)
            continue
        text = _SPACE.sub(" ", unescape("".join(x[0] for x in line))).strip()
        if text:
            own = len(text)
            if any(x[1] for x in line):
                outside = _SPACE.sub(" ", unescape("".join(x[0] for x in line if not x[1]))).strip()
                own = len(outside) if any(c.isalnum() for c in outside) else 0
            lines.append(_Line(text, own, line[0][3] is not None, line[0][4]))
        line.clear()
    return lines


def _stretches(own: list[int], window: int, least_block: int, upward: bool) -> list[tuple[int, int]]:
    """First and end line of the stretches of text, joined across gaps of at most `window` lines."""
    size = len(own)
    block = [sum(own[i : i + window]) for i in range(size)]
    surge = min(least_block, max(1, max(block) // 10))
    found: list[tuple[int, int]] = []
    at = 0
    while at < size:
        if own[at] == 0 or block[at] < surge:
            at += 1
            continue
        first, end = at, at
        # The dive: a line without text from which on the window holds too little.
        while end < size and (own[end] > 0 or block[end] >= surge):
            end += 1
        at = end
        floor = found[-1][1] if found else 0
        while (upward or found) and first > floor and own[first - 1] > 0:
            first -= 1
        while own[end - 1] == 0:
            end -= 1
        if found and first - found[-1][1] <= window:
            first = found.pop()[0]
        found.append((first, end))
    return found


def main_text(html: str | None, window: int = 3, least_block: int = 80) -> str:
    """The article of a page, its blocks joined by \n; empty for null, for no text, and where there is no article.

    A line's block length is the sum, over the `window` lines from it on, of their characters outside
    links. A surge is a line whose block length reaches `least_block`, or a tenth of the page's longest if
    that is less; its dive is the next line that is only a link and whose block length is under that. Short
    lines next to a stretch belong to it, and stretches at most `window` lines apart are one, with the link
    lines between them. The stretch with most text is the article, with all that have a tenth of its text.

    Of the lines that are left, paragraphs and headings below the first stretch that stand in the same element
    as a paragraph of a stretch belong to the article, too, however short and wherever lists of links are between.

    Where the page marks its article, only those lines take part, and all of them do from the first stretch on, lists of
    links included: nothing in the element but what is set aside is dropped. Above it, short lines next to it belong to
    it, and so do at most `window` lines of links. If links hold all its text, they count as text.
    """
    lines = lines_of(html) if html else []
    marked = [x for x in lines if x.article]
    lines = marked or lines
    if not lines:
        return ""
    own = [x.own for x in lines]
    if marked and not any(own):
        own = [len(x.text) for x in lines]
    found = _stretches(own, window, least_block, bool(marked))
    if not found:
        return ""
    if marked:
        return "\n".join(x.text for x in lines[0 if found[0][0] <= window else found[0][0] :])
    sizes = [sum(own[first:end]) for first, end in found]
    found = [x for x, n in zip(found, sizes) if 10 * n >= max(sizes)]
    inside = {i for first, end in found for i in range(first, end)}
    parents = {lines[i].parent for i in inside} - {-1}
    kept = [x.text for i, x in enumerate(lines) if i in inside or i > found[0][0] and x.own and x.parent in parents]
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of `pages`; other columns are ignored.

    One pass without a shuffle; repeated rows, null ids and an empty table need no care.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages_html in slices(batches, "html"):
            texts = [main_text(h) for h in pages_html]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(each, rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"))
