"""Main text of web pages by text-to-tag ratio.

``html.parser`` events are streamed into lines (block elements); each line
has its text, its tags and its place in the element tree. The text-to-tag
ratio of the lines is smoothed with a Gaussian, and lines above the standard
deviation of the smoothed ratios form the content cluster. The content region
is the smallest element that holds all of that cluster, widened to the
outermost ``article`` or ``main`` around it; its lines are returned, short
ones too, without elements that are not article text. Of the lists in it,
only menus are left out: lists of links alone, outside ``article`` and
``main``, that come before all content, or after all content where the region
is the page itself.

Scripts, controls and hidden elements have no text. Other elements are marked
by tag, role, class or id, and a mark is weighed against the text:

* a sure mark (``nav``, ``class="cookie-notice"``) takes the element out, unless
  it wraps the article: it has the only ``article`` or ``main``, longer than all
  text outside marks, or ``ENOUGH`` characters beside less than a tenth of that
  outside. Comments, footers and dialogs never wrap an article.
* a doubtful mark (a listed word among others, as in ``class="has-sidebar"`` or
  ``id="social-history"``) takes it out only where it holds no content, or less
  than half of it outside any ``article`` and ``main``.

A ``header`` inside ``article`` or ``main`` belongs to the article; ``body``,
or any element that cannot stand in a ``head``, ends an open ``head``.

Cases: null or empty html, or a page without text outside such elements, gives
an empty text; unclosed and stray tags are tolerated (an end tag closes what
is open inside it); ``br`` and table cells are white space inside their line;
repeated rows are all returned; empty input gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from os.path import commonprefix
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textarrays import CHUNK_BYTES

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody thead tr ul".split())
CONTAINER = frozenset("article body center div html main section".split())
WHOLE = frozenset("article main".split())   # hold whole articles
PAGE = frozenset("body html".split())
LIST = frozenset("li menu ol ul".split())
NEVER = frozenset(
    "button head iframe noscript object script select style svg template textarea".split())
HEAD = frozenset("base head html link meta noscript script style template title".split())
MARKED = frozenset("aside dialog fieldset footer form header menu nav".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
NAMES = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies copyright dialog discussion disqus footer gdpr header masthead menu menus modal "
    "nav navbar navigation newsletter notice notification pager pagination popup promo promoted promotion recommended "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toolbar widget widgets".split())
#: Words that are no part of other names, words that go with a listed one in
#: the name of a page's part, and words that say something of the page instead.
SURE = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts breadcrumb breadcrumbs commentlist consent cookie "
    "cookies disqus gdpr masthead modal navbar newsletter pager pagination popup promoted signup sponsor sponsored "
    "subscribe toolbar".split())
PARTS = frozenset(
    "area bar block body bottom box button buttons card column container entry form group holder icon icons inner item "
    "items left link links list main meta module outer page panel post posts primary right row secondary section site "
    "slot sub text thread title top unit wrap wrapper".split())
ABOUT = frozenset("has hide hides no with without".split())
FIXED = frozenset("comment comments commentlist discussion disqus footer replies reply respond".split())
SIGMA = 1.0     # of the Gaussian, in lines
ENOUGH = 400    # characters outside links that make an article of a marked element

_NAME = re.compile(r"[a-z]+")
_KERNEL = np.exp(-0.5 * (np.arange(-2, 3) / SIGMA) ** 2)


CLEAR, DOUBTFUL, OUT, OUT_FIXED, NO_TEXT = range(5)


def _mark(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> int:
    """What the element is by its tag and attributes; ``inside`` an article."""
    if tag in NEVER:
        return NO_TEXT
    if tag in MARKED and not (tag == "header" and inside):
        mark = OUT_FIXED if tag in ("footer", "dialog") else OUT
    else:
        mark = CLEAR
    if not attrs or tag in ("body", "html", "article", "main"):
        return mark
    a = dict(attrs)
    if "hidden" in a or "display:none" in (a.get("style") or "").replace(" ", "").lower():
        return NO_TEXT
    if (a.get("role") or "").lower() in ROLES:
        mark = max(mark, OUT)
    for name in f"{a.get('class') or ''} {a.get('id') or ''}".lower().split():
        words = set(_NAME.findall(name))
        if words.isdisjoint(NAMES):
            continue
        if words.isdisjoint(ABOUT) and (words <= NAMES | PARTS or not words.isdisjoint(SURE)):
            mark = max(mark, OUT if words.isdisjoint(FIXED) else OUT_FIXED)
        else:
            mark = max(mark, DOUBTFUL)
    if tag not in BLOCK:  # inside a line: text of the line around it goes on
        return NO_TEXT if mark >= OUT else CLEAR
    return mark


class _Line(NamedTuple):
    text: str
    plain: int                  # characters outside links
    tags: int
    around: tuple[int, ...]     # numbers of the containers around it
    out: tuple[int, ...]        # of the surely marked elements
    doubtful: tuple[int, ...]   # and of the doubtful ones
    whole: int | None           # of the innermost article or main
    outer: int | None           # of the outermost list
    kept: bool = True


class _Open(NamedTuple):
    tag: str
    number: int
    mark: int


class _Lines(HTMLParser):
    """Collects the lines of a page and what is open around each."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = []
        self.number = self.links = self.tags = self.plain = self.silent = 0
        self.skipped = False  # text seen in the element without text that is open
        self.text: list[str] = []
        self.lines: list[_Line] = []
        self.whole: set[int] = set()  # numbers of the elements that hold whole articles
        self.page: set[int] = set()   # and of those that hold the page
        self.fixed: set[int] = set()  # numbers of the marked elements that wrap no article

    def updatepos(self, i, j):  # line numbers of the source are not used
        return j

    def _line(self, text: str, plain: int, tags: int, kept: bool = True):
        def numbers(fits):
            return tuple(e.number for e in self.open if fits(e))

        around = numbers(lambda e: e.tag in CONTAINER)
        whole = next((n for n in reversed(around) if n in self.whole), None)
        outer = numbers(lambda e: e.tag in LIST)[0] if any(e.tag == "li" for e in self.open) else None
        self.lines.append(_Line(text, plain, tags, around, numbers(lambda e: OUT <= e.mark <= OUT_FIXED),
                                numbers(lambda e: e.mark == DOUBTFUL), whole, outer, kept))

    def _cut(self):
        text = " ".join("".join(self.text).split())
        if text:
            self._line(text, self.plain, self.tags)
        self.text, self.tags, self.plain = [], 0, 0

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD and self.open:  # ends an open head
            head = next((k for k, e in enumerate(self.open[:4]) if e.tag == "head"), None)
            if head is not None and not any(e.tag in HEAD and e.mark == NO_TEXT for e in self.open[head + 1:]):
                self._close(head)
        if tag in BLOCK:
            if self.text:
                self._cut()
            inner = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k].tag in BLOCK), None)
            if inner is not None and self.open[inner].tag == "p":  # a block ends an open paragraph
                self._close(inner)
        self.tags += 1
        if tag in ("br", "td", "th"):
            self.text.append(" ")
        if tag not in VOID:
            self.number += 1
            self.links += tag == "a"
            if tag in WHOLE:
                self.whole.add(self.number)
            elif tag in PAGE:
                self.page.add(self.number)
            mark = _mark(tag, attrs, any(e.tag in WHOLE for e in self.open))
            if mark == OUT_FIXED:
                self.fixed.add(self.number)
            self.silent += mark == NO_TEXT
            self.open.append(_Open(tag, self.number, mark))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, k: int):
        for e in self.open[k:]:
            self.links -= e.tag == "a"
            self.silent -= e.mark == NO_TEXT
        del self.open[k:]
        if self.skipped and not self.silent:
            self._line("", 0, 1, kept=False)
            self.skipped = False

    def handle_endtag(self, tag):
        self.tags += 1
        k = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i].tag == tag), None)
        if k is not None:
            if any(e.tag in BLOCK for e in self.open[k:]):
                self._cut()
            self._close(k)
        elif tag in BLOCK:
            self._cut()

    def handle_data(self, data):
        if self.silent:
            self.skipped = True
            return
        self.text.append(data)
        if not self.links and not data.isspace():
            self.plain += len(data)

    def result(self) -> list[_Line]:
        self.close()
        self._cut()
        return self.lines


def _wrappers(lines: list[_Line], fixed: set[int]) -> set[int]:
    """Surely marked elements that wrap the article, found from the outside in."""
    cleared: set[int] = set()
    if not any(x.out for x in lines):
        return cleared
    while True:
        clear = 0
        wholes: Counter[tuple[int, ...]] = Counter()   # text in article and main by the marks around
        straight: Counter[int] = Counter()             # text right under one marked element
        for x in lines:
            out = tuple(n for n in x.out if n not in cleared)
            if not out:
                clear += x.plain
            elif fixed.isdisjoint(out):
                if x.whole is not None and x.whole > out[-1]:   # opened in the marked element
                    wholes[out] += x.plain
                if len(out) == 1:
                    straight[out[0]] += x.plain
        out, most = max(wholes.items(), key=lambda w: w[1], default=((), 0))
        if most > clear:
            cleared.update(out)
            continue
        wrap, most = max(straight.items(), key=lambda w: w[1], default=(0, 0))
        if most < ENOUGH or clear * 10 >= most:
            return cleared
        cleared.add(wrap)


def _content(lines: list[_Line]) -> list[int]:
    """Lines of the content cluster; runs of lines that are out count as one."""
    at = [k for k, x in enumerate(lines) if x.kept or not k or lines[k - 1].kept]
    ratio = np.array([lines[k].plain / (lines[k].tags + 1) if lines[k].kept else 0.0 for k in at])
    smooth = np.convolve(ratio, _KERNEL / _KERNEL.sum())[2:len(ratio) + 2]
    level = smooth.std()
    return [k for j, k in enumerate(at) if lines[k].kept and smooth[j] >= level and ratio[j] > 0]


def _weighed(lines: list[_Line], whole: set[int], fixed: set[int]) -> list[_Line]:
    """The lines, those in marked elements that are not of the article not kept."""
    cleared = _wrappers(lines, fixed)
    lines = [x._replace(kept=x.kept and cleared.issuperset(x.out)) for x in lines]
    if not any(x.doubtful and x.kept for x in lines):
        return lines
    content = _content(lines)
    total = sum(lines[k].plain for k in content)
    held: Counter[int] = Counter()
    in_whole: set[int] = set()
    for k in content:
        for n in lines[k].doubtful:
            held[n] += lines[k].plain
            if not whole.isdisjoint(lines[k].around):
                in_whole.add(n)
    stay = {n for n, size in held.items() if n in in_whole or size * 2 >= total}
    return [x._replace(kept=x.kept and stay.issuperset(x.doubtful)) for x in lines]


def main_text(html: str | None) -> str:
    parser = _Lines()
    parser.feed(html or "")
    lines = _weighed(parser.result(), parser.whole, parser.fixed)
    if not any(x.kept for x in lines):
        return ""
    content = _content(lines)
    first, last = min(content, default=len(lines)), max(content, default=0)
    path = tuple(commonprefix([lines[k].around for k in content]))
    at = next((k for k, n in enumerate(path) if n in parser.whole), len(path))
    path = path[:at + 1]  # to the smallest that holds all content, or the outermost article or main on the way
    page = parser.page.issuperset(path)
    worded = {x.outer for x in lines if x.kept and x.plain}

    def menu(k, x):
        return (x.outer is not None and x.outer not in worded and parser.whole.isdisjoint(x.around)
                and (k < first or page and k > last))

    return "\n\n".join(x.text for k, x in enumerate(lines) if x.kept and x.around[:len(path)] == path and not menu(k, x))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start, size = 0, 0
        html = batch.column("_html")
        texts: list[str] = []
        for k in range(len(html)):
            texts.append(main_text(html[k].as_py()))
            size += len(texts[-1])
            if size > CHUNK_BYTES or k == len(html) - 1:
                rows = batch.slice(start, k + 1 - start)
                kept = {n: rows.column(n) for n in rows.schema.names if n != "_html"}
                yield pa.RecordBatch.from_pydict(kept | {
                    "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})
                start, size, texts = k + 1, 0, []


def html_text(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """``keys`` with the main text and its length."""
    few = pages.select(*keys, F.col(html).alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in few.schema if f.name != "_html")
    return few.mapInArrow(_extract, schema + ", text string, n_chars long")
