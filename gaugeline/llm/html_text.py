"""Main text of web pages: the best-scoring contiguous stretch of words (plus) and tags (minus)."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from itertools import accumulate
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Comments, declarations and tags; a quote opens a string only where a value begins.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
NAME_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")

#: Elements whose content is no markup, and elements without content.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot"
    " thead title tr ul".split()
)
#: Elements that a start tag of a block, or one of their own kind, closes.
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSED_BY_OWN = frozenset("li dd dt option tr td th".split())
#: Elements that are never part of an article; an annotation repeats its formula and is not shown.
OUTSIDE = frozenset(
    "annotation annotation-xml aside button datalist dialog embed footer form frameset head iframe input menu nav noembed noframes noscript object"
    " script select style svg template textarea title".split()
)
#: Words in class, id, role or itemprop that mark what is not article.
MARKS = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment commentary comments complementary"
    " consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus footer gdpr hidden login masthead menu modal nav"
    " navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended"
    " related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser"
    " toolbar".split()
)
#: Words that may stand beside a mark in a name without taking away its meaning.
BESIDE = frozenset(
    "area bar block body box btn button buttons container content entry footer form global group header holder inner item items left"
    " link links list main module outer page panel post posts primary reader right row secondary section site text thread title top user"
    " widget widgets wrap wrapper".split()
)
HOLDERS = frozenset(("article", "main"))
#: Elements of an article whose id and label name their subject.
SUBJECTS = frozenset("h1 h2 h3 h4 h5 h6 section".split())

#: Weights before any page is seen, and the bounds of learned ones.
WORD, LINK_WORD, BLOCK_TAG, INLINE_TAG = 1.0, -0.5, -0.5, -0.1
LOWEST_TAG, MOST_KINDS = -8.0, 256


@dataclass
class Element:
    """An element's place among the events of its page."""

    name: str
    start: int
    marked: bool
    link: bool
    end: int = 0
    holds: bool = False


@dataclass
class Page:
    """Events in page order: (kind, value), kind being text, start or end; elements with their spans."""

    events: list[tuple[str, object]] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def _marked_name(name: str) -> bool:
    """Whether a name such as ``comment-list`` is made of marks; ``ad-free`` and ``social-history`` are not."""
    words = {w.lower() for w in NAME_WORD.findall(name)}
    return not MARKS.isdisjoint(words) and words <= MARKS | BESIDE


def _marks(attributes: str, name_of: str, held: bool) -> bool:
    """Whether an element's attributes say that it is not article.

    A class or role says so by one whole name; an id or label by all its words.
    Inside an article or main element (``held``), an id or label says so only by
    marks alone, as in id="comments", and never on a heading or section.
    """
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "role", "itemprop", "data-role"):
            if any(map(_marked_name, value.split())):
                return True
        elif name in ("id", "aria-label"):
            words = {w.lower() for w in NAME_WORD.findall(value)}
            if words and words <= MARKS and not (held and name_of in SUBJECTS) or not held and _marked_name(value):
                return True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


class OpenElements:
    """The elements open at a place, and the places on that stack of each name, of blocks and of holders.

    Every step takes constant time but for the elements it closes.
    """

    def __init__(self, close):
        self.stack, self.close = [], close
        self.named: dict[str, list[int]] = {}
        self.blocks, self.holders = [], []

    def _lists(self, name: str) -> list[list[int]]:
        lists = [self.named.setdefault(name, [])]
        if name in BLOCKS:
            lists.append(self.blocks)
        if name in HOLDERS:
            lists.append(self.holders)
        return lists

    def push(self, element: Element) -> None:
        for places in self._lists(element.name):
            places.append(len(self.stack))
        self.stack.append(element)

    def pop_to(self, place: int) -> None:
        """Close everything from the top down to a place on the stack."""
        while len(self.stack) > place:
            element = self.stack.pop()
            for places in self._lists(element.name):
                places.pop()
            self.close(element)

    def last(self, name: str) -> int:
        places = self.named.get(name)
        return places[-1] if places else -1

    def end(self, name: str) -> None:
        """An end tag; a stray one does not end the article around it."""
        place = self.last(name)
        inside = not self.holders or place >= self.holders[-1] or name in HOLDERS or name in ("body", "html")
        if place >= 0 and inside:
            self.pop_to(place)

    def make_room(self, name: str) -> None:
        """Close what a start tag closes: an open paragraph, or an item of its own kind, if no block lies between."""
        place = max(self.last("p") if name in BLOCKS else -1, self.last(name) if name in CLOSED_BY_OWN else -1)
        if place >= 0 and place >= (self.blocks[-1] if self.blocks else -1):
            self.pop_to(place)


def read_page(html: str) -> Page:
    """Cut a page into texts and tags; end tags that are missing or stray are made good. Linear in the page."""
    page = Page()
    events = page.events

    def close(element: Element) -> None:
        element.end = len(events)
        events.append(("end", element))

    opened = OpenElements(close)
    at = 0
    while match := TOKEN.search(html, at):
        if match.start() > at:
            events.append(("text", html[at : match.start()]))
        at = match.end()
        if not match[2]:
            continue
        name = match[2].lower()
        if match[1]:
            opened.end(name)
            continue
        opened.make_room(name)
        element = Element(name, len(events), bool(match[3]) and _marks(match[3], name, bool(opened.holders)), name == "a")
        page.elements.append(element)
        events.append(("start", element))
        if name in VOID or match[3].endswith("/") and name not in BLOCKS and name not in RAW:
            close(element)
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
            close(element)
        else:
            opened.push(element)
    if at < len(html):
        events.append(("text", html[at:]))
    opened.pop_to(0)
    holders = [e.start for e in page.elements if e.name in HOLDERS]
    for element in page.elements:
        after = bisect_right(holders, element.start)
        element.holds = after < len(holders) and holders[after] < element.end
    return page


def _excluded(element: Element, in_holder: bool) -> bool:
    if element.name in OUTSIDE:
        return True
    if element.name == "header":
        return not in_holder and not element.holds
    return element.marked and not element.holds and element.name not in ("html", "body", *HOLDERS)


def _tag_weight(name: str) -> float:
    return BLOCK_TAG if name in BLOCKS else INLINE_TAG


def scored_events(page: Page, weights: dict[str, float]) -> list[tuple[int, float, bool]]:
    """(place, score, inside a holder) of every event that may be article; a text scores by its words."""
    out, skipped, holders, links = [], 0, 0, 0
    for place, (kind, value) in enumerate(page.events):
        if kind == "start":
            if skipped or _excluded(value, holders > 0):
                skipped += 1
                continue
            holders += value.name in HOLDERS
            links += value.link
            out.append((place, weights.get(value.name, _tag_weight(value.name)), holders > 0))
        elif kind == "end":
            if skipped:
                skipped -= 1
                continue
            out.append((place, weights.get(value.name, _tag_weight(value.name)), holders > 0))
            holders -= value.name in HOLDERS
            links -= value.link
        elif not skipped:  # blanks alone score nothing, but part words
            out.append((place, len(value.split()) * weights.get("#link" if links else "#word", LINK_WORD if links else WORD), holders > 0))
    return out


def best_stretch(scores: list[tuple[int, float, bool]]) -> tuple[int, int] | None:
    """First and last place of the contiguous stretch with the highest sum; the first one of equals."""
    best, found, total, start = 0.0, None, 0.0, None
    for place, score, _ in scores:
        if total <= 0:
            total, start = 0.0, place
        total += score
        if total > best:
            best, found = total, (start, place)
    return found


def main_text(html: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best stretch, one a line.

    If most of its words stand in an article or main element, the stretch is
    that element: the scan finds the content, the element says where it ends.
    """
    page = read_page(html or "")
    scores = scored_events(page, weights)
    found = best_stretch(scores)
    if not found:
        return ""
    places = [p for p, _, _ in scores]
    sums = [0.0, *accumulate(s if page.events[p][0] == "text" else 0.0 for p, s, _ in scores)]
    words = lambda low, high: sums[max(bisect_right(places, high), bisect_left(places, low))] - sums[bisect_left(places, low)]
    holders = [e for e in page.elements if e.name in HOLDERS and e.start <= found[1] and e.end >= found[0]]
    for name in ("article", "main"):
        own = [e for e in holders if e.name == name]
        if own:
            widest = max(own, key=lambda e: words(max(e.start, found[0]), min(e.end, found[1])))
            if 2 * words(max(widest.start, found[0]), min(widest.end, found[1])) >= words(*found):
                outer = [e for e in own if e.start <= widest.start and e.end >= widest.end]
                found = min((e.start, e.end) for e in outer)
                break
    blocks, parts = [], []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(text)
        parts.clear()

    for place, _, _ in scores:
        if not found[0] <= place <= found[1]:
            continue
        kind, value = page.events[place]
        if kind == "text":
            parts.append(unescape(value))
        elif value.name in BLOCKS:
            flush()
        elif value.name in ("br", "td", "th", "img"):
            parts.append(" ")
    flush()
    return "\n".join(blocks)


def count_kinds(html: str | None, counts: Counter) -> None:
    """Add a labelled page's tags and words by where they stand: in its article or main element, or outside.

    Pages without such an element, or with one that holds no words, are not labelled.
    """
    page = read_page(html or "")
    if not any(e.name in HOLDERS for e in page.elements):
        return
    holders = links = 0
    for kind, value in page.events:
        if kind == "text":
            counts["#link" if links else "#word", holders > 0] += len(value.split())
            continue
        if kind == "start":
            holders += value.name in HOLDERS
            links += value.link
        if value.name not in HOLDERS:
            counts[value.name, holders > 0] += 1
        if kind == "end":
            holders -= value.name in HOLDERS
            links -= value.link


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Weights of words and tags from all pages whose markup labels their content.

    A kind's weight is the logarithm of how much rarer it is in content than
    outside, for each word of either; words stay positive and tags negative.
    The most common kinds are kept, so that the table is of bounded size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for html in batch.column(0).slice(at, 64).to_pylist():
                    count_kinds(html, counts)
        rows = [(name[:40], inside, n) for (name, inside), n in counts.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.bool_(), pa.int64()))], names=["kind", "inside", "n"]
        )

    seen = pages.select(F.col("html").cast("string").alias("html")).mapInArrow(count, "kind string, inside boolean, n long")
    inside, outside = (F.coalesce(F.sum(F.when(F.col("inside") == x, F.col("n"))), F.lit(0)) for x in (True, False))
    table = seen.groupBy("kind").agg(inside.alias("inside"), outside.alias("outside"))
    rows = table.orderBy(F.desc(F.col("inside") + F.col("outside")), "kind").limit(MOST_KINDS).collect()
    known = {r[0]: (r[1], r[2]) for r in rows}
    within = 1 + sum(known.get(k, (0, 0))[0] for k in ("#word", "#link"))
    without = 1 + sum(known.get(k, (0, 0))[1] for k in ("#word", "#link"))
    weights = {}
    for kind, (a, b) in known.items():
        odds = log((b + 1) / without) - log((a + 1) / within)
        if kind == "#word":
            weights[kind] = WORD
        elif kind == "#link":
            weights[kind] = min(WORD, max(-WORD, -odds)) if a + b >= 100 else LINK_WORD
        else:
            weights[kind] = max(LOWEST_TAG, _tag_weight(kind) - max(0.0, odds))
    return weights


def extract_text(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.

    Null or empty html: an empty text. Repeated rows: each its own. Null page_id
    or url: kept. No labelled pages: the weights that are set beforehand. Pages of
    any length are read whole, in time linear in their length but for sorting. Of
    stretches with equal sums the first counts. Empty table: no rows. Other columns
    play no part, whatever their names.
    """
    weights = learn_weights(pages) if weights is None else weights

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [main_text(x, weights) for x in part.column(2).to_pylist()]
                sizes = pa.array([len(x) for x in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
