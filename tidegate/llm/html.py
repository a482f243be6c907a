"""Main text of web pages by two-pass block rules.

Pass one labels each block of a page by link density, length and stop-word density, and by the part it stands in (menus,
footers, forms, hidden parts, containers named as advert, notice, sidebar or comments are bad). Pass two decides the
others from their nearest decided neighbours on both sides: a heading goes with the text after it, a short block that ends
as a sentence does with good text before it, any other short block with the nearer of the two, and a middling block needs
one good neighbour.
Where a page marks its article, that is one more feature of undecided blocks only: inside it they are good, outside bad.

Markup is read in one walk: what cannot be finished (a quote, a comment, an element without its end) is looked for once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Common function words of the languages covered.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which will with you
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sur un une vous
    als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch oder sich sie sind so und von war was wie wir zu zum zur
    al como con de del el ella en entre es esta este la las lo los más no o para pero por que se sin sobre su sus un una y ya
    """.split()
)
# Names of elements.
_RAW = "script|style|title|textarea|iframe|noscript|template|svg|math|object|canvas|audio|video"
_BAD = frozenset("nav footer header aside form menu select button dialog fieldset figcaption".split())
_MAIN = frozenset("article main".split())
_NESTING = frozenset("div section ul ol dl table blockquote figure details center body html".split()) | _BAD | _MAIN
_BLOCK = _NESTING | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre address hr option legend summary head".split())
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in _RAW.split("|")}
_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice|alert|popup|modal|newsletter|subscribe|signup|login|"
    r"comment\w*|disqus|replies|respond|sidebar|side|widget|menu|nav|navbar|navigation|breadcrumb\w*|pagination|pager|footer|foot|copyright|related|recommend\w*|"
    r"share|sharing|social|tags|toolbar|search|skip|masthead|topbar|complementary|contentinfo)(?:$|[\s_-])",
    re.IGNORECASE,
)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»„“”…"

#: Characters below which a block is short, and from which it is long.
SHORT, LONG = 70, 200
#: Share of stop words from which a long block is good at once, and a shorter one middling.
FEW_STOPS = 0.12
#: Share of characters in links above which a block is bad.
LINKED = 0.33

_GOOD, _BADLY, _MIDDLE, _SHORTLY = 1, 0, 2, 3
_SENTENCE_ENDS = tuple(".!?…。»”\"")


class Block(NamedTuple):
    text: str
    linked: int  # characters in links
    place: int  # 1 in a marked article, 0 in an excluded part, -1 elsewhere
    heading: bool


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Markup of a page in order: start, end, "/" or "", name ("" for what is no element) and attributes.

    A quote that is never closed makes all later tags of the page end at their first ">"; a comment or a raw element
    without an end takes the rest of the page. Every character is looked at a fixed number of times.
    """
    at, last, quoted = 0, page.rfind(">"), True
    while 0 <= (start := page.find("<", at)):
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            yield start, at, "", "", ""
            continue
        if start > last:  # nothing that starts here can end
            return
        if page[start + 1 : start + 2] in ("!", "?"):
            at = page.find(">", start) + 1
            yield start, at, "", "", ""
            continue
        m = _NAME.match(page, start + 1)
        if m is None:
            at = start + 1
            continue
        end = m.end()
        while quoted:
            end = _UNQUOTED.match(page, end).end()
            if page[end : end + 1] in (">", ""):
                break
            close = page.find(page[end], end + 1)
            quoted = close >= 0
            end = close + 1
        if not quoted or end >= len(page):
            quoted, end = False, page.find(">", m.end())
        name, attributes, at = m[2].lower(), page[m.end() : end], end + 1
        if name in _RAW_END and not m[1]:
            found = _RAW_END[name].search(page, at)
            at = found.end() if found else len(page)
            name = ""
        yield start, at, m[1], name, attributes


def blocks(page: str) -> list[Block]:
    """The page's non-empty blocks."""
    found: list[Block] = []
    stack: list[tuple[str, int]] = []
    open_of: Counter = Counter()
    text: list[str] = []
    linked, in_link, own, at, heading = 0, False, -1, 0, False

    def close() -> None:
        nonlocal linked
        joined = " ".join(unescape("".join(text)).split())
        if joined:
            found.append(Block(joined, min(linked, len(joined)), 0 if own == 0 else stack[-1][1] if stack else -1, heading))
        text.clear()
        linked = 0

    for start, after, end, name, attributes in tags(page):
        piece = page[at:start]
        if piece:
            text.append(piece)
            if in_link:
                linked += len(piece.strip())
        at = after
        if not name:
            continue
        if name == "a":
            in_link = not end
        elif name == "br":
            text.append(" ")
        if name not in _BLOCK:
            continue
        close()
        own, heading = -1, name in _HEADINGS and not end
        if end:
            while open_of[name]:  # else there is nothing to look for
                closed = stack.pop()[0]
                open_of[closed] -= 1
                if closed == name:
                    break
            continue
        place = stack[-1][1] if stack else -1
        if place != 0:
            named = " ".join(x for n in _NAMED.findall(attributes) for x in n if x) if attributes else ""
            if name in _BAD and not (name == "header" and place == 1) and name != "figcaption" or (named and _HINT.search(named) and name not in ("body", "html")) or (attributes and _HIDDEN.search(attributes)):
                place = 0
            elif name in _MAIN:
                place = 1
        if name in _NESTING:
            if not attributes.endswith("/"):
                stack.append((name, place))
                open_of[name] += 1
        else:
            own = place if place == 0 else -1
    text.append(page[at:])
    close()
    return found


def first_pass(block: Block) -> int:
    """Good, bad, middling or short, from one block alone."""
    text, linked = block.text, block.linked
    if block.place == 0 or "©" in text and len(text) < LONG:
        return _BADLY
    if block.heading:
        return _SHORTLY
    if linked / len(text) > LINKED:
        return _BADLY
    if len(text) < SHORT:
        return _SHORTLY
    words = text.lower().split()
    stops = sum(w.strip(_EDGE) in STOP_WORDS for w in words) / len(words)
    if len(text) >= LONG:
        return _GOOD if stops >= FEW_STOPS else _MIDDLE
    return _MIDDLE if stops >= FEW_STOPS else _SHORTLY


def second_pass(found: list[Block], labels: list[int]) -> list[bool]:
    """Undecided blocks inherit from the nearest decided ones before and after."""
    marked = any(b.place == 1 for b in found)
    if _GOOD not in labels:  # a page of unknown words: its long blocks are its text
        labels = [_GOOD if x == _MIDDLE and len(b.text) >= LONG else x for b, x in zip(found, labels, strict=True)]
    none = (len(labels) + 1, None)

    def nearest(order: Iterable[int]) -> list[tuple[int, int | None]]:
        """How far the last decided block was, and its label."""
        out, far = [none] * len(labels), none
        for k in order:
            far = (far[0] + 1, far[1]) if far[1] is not None else far
            out[k] = far
            if labels[k] in (_GOOD, _BADLY):
                far = (0, labels[k])
        return out

    before, after = nearest(range(len(labels))), nearest(range(len(labels) - 1, -1, -1))
    keep = []
    for b, x, (d1, l1), (d2, l2) in zip(found, labels, before, after, strict=True):
        if x in (_GOOD, _BADLY):
            keep.append(x == _GOOD)
        elif marked:
            keep.append(b.place == 1)
        elif x == _MIDDLE:
            keep.append(_GOOD in (l1, l2))
        elif b.heading:
            keep.append((l1 if l2 is None else l2) == _GOOD)
        elif b.text.endswith(_SENTENCE_ENDS) and l1 == _GOOD:
            keep.append(True)
        else:
            keep.append((l1 if d1 < d2 else l2) == _GOOD)
    return keep


def main_text(page: str) -> str:
    """The good blocks in page order, one a line."""
    found = blocks(page)
    keep = second_pass(found, [first_pass(b) for b in found])
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text``, ``n_chars``.

    Null and empty pages, and pages without a good block, give an empty text. Null ids and urls and repeated rows stay as
    they are; an empty table gives no rows; other columns are not read. Pages are independent: no shuffle.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            columns = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "link", "text", "n_chars"])

    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("link"), text_of(html_col).alias("html"))
    found = read.mapInArrow(part, f"id {kinds[id_col]}, link {kinds[url_col]}, text string, n_chars long")
    return found.withColumnsRenamed({"id": id_col, "link": url_col})
