"""Main text of web pages from parser events.

Events of the standard library's parser become lines (block by block), each with its text, the number of tags that
stand in it, the text inside links, and the element that holds it. The text-to-tag ratio of the lines, in page order,
is smoothed by a Gaussian and split into two clusters by a threshold; the upper cluster marks content. The nearest
container that holds all marked text is the content region, with the containers around it that add more text than links.
A legal notice at the end goes, and so does, where no <article> or <main> says what is content, a list of short links before or after all content.
On pages with <article> or <main> the tag is a hint: where these hold at least half of the marked text they are the
region, otherwise their own text counts as marked. All blocks of the region stay, short ones and those that are mostly
links too. Lines inside menus, forms, notices and the like are no candidates, by their element or the words of its class
and id; words that name content win, save in comment areas.

NULL, empty and text-free pages give the empty text. Broken markup never fails: open elements end where an enclosing one
ends or the page stops. Rows are independent; repeated and NULL ids and urls pass through.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwright.llm.common import in_batches, prepare, whole_text

#: Elements whose text is never content.
SILENT = frozenset("script style noscript template head title svg iframe object canvas select option textarea button datalist audio video".split())
ASIDE = frozenset("nav footer aside form menu dialog header label fieldset search".split())
CONTAINERS = frozenset("article main section div body td table center".split())
BLOCKS = CONTAINERS | ASIDE | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption address tr th thead tbody tfoot caption hr details summary hgroup html".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class, id or role that mark what surrounds an article.
AROUND = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar aside footer masthead topbar toolbar header comment comments commentlist reply replies respond disqus cookie cookies consent "
    "gdpr notice notices notification alert alertdialog dialog popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations widget pagination pager copyright legal disclaimer tags skip search contentinfo complementary".split()
)
#: An element that says it is the content is not a surrounding one, whatever else it says, unless it is a comment area.
CONTENT = frozenset("article content main post entry story body text".split())
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
#: First words of a name that tells a state of the element (has-sidebar, no-comments), and those of comments (comments-open).
_STATES = frozenset("no not has with without".split())
_COMMENT_STATES = frozenset("tag category open closed on off enabled disabled".split())
_LAYOUT = frozenset("area wrapper wrap container inner outer column col page section region holder".split())
#: An element's own heading: post-header.
_OWN_HEADING = CONTENT - {"main", "body", "text"}
#: Names that a container has for its place beside or below the content, and only as a whole.
_BESIDE = frozenset("right rail bottom".split())
#: How a line of legal notice begins.
_LEGAL = re.compile(r"(©|\(c\)\s*\d{4}|copyright\s*(©|\(c\)|\d{4})|all rights reserved)", re.IGNORECASE)
#: Most characters of such a line; and the least items of a menu and the most characters of each.
_LEGAL_CHARS, _MENU_ITEMS, _MENU_CHARS = 200, 3, 40
#: How far text is surrounded: not, by a named wrapper, for good, or by a wrapper that an article stands in.
FREE, WRAPPED, OUT, HELD = range(4)
_WORDS = re.compile(r"[A-Za-z]+")
_CUT_TAG = re.compile(r"<[A-Za-z/!?][^>]*\Z")
_SPLIT_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _is_state(words: list[str]) -> bool:
    return words[0] in _STATES or bool(COMMENTS & set(words) and {words[0], words[-1]} & _COMMENT_STATES)


def _names_content(words: list[str]) -> bool:
    """main-content and content-area do; text-center and sidebar-content do not."""
    if AROUND & set(words):
        return False
    return words[-1] in CONTENT or (words[0] in CONTENT - {"body", "text"} and words[-1] in _LAYOUT)


def surrounding_by_name(tag: str, names: str, role: str) -> int:
    """FREE, WRAPPED or OUT, by the names in class, id and role."""
    article = tag in ("article", "main")
    if {w.lower() for w in _WORDS.findall(role)} & AROUND and not article:
        return OUT
    named = [[w.lower() for w in _WORDS.findall(_SPLIT_CASE.sub(" ", name))] for name in f"{names} {role}".split()]
    named = [words for words in named if words and not _is_state(words)]
    every = {w for words in named for w in words}
    says_content = any(_names_content(words) for words in named)
    if every & COMMENTS and not (article and says_content):
        return OUT
    if says_content or (article and every & CONTENT) or any(words[-1] == "header" and _OWN_HEADING & set(words) for words in named):
        return FREE
    beside = tag in CONTAINERS and any(len(words) == 1 and words[0] in _BESIDE for words in named)
    return WRAPPED if beside or every & AROUND else FREE


class _Lines(HTMLParser):
    """Collects lines from parser events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int]] = []  # tag, silent, around, container
        self.places: dict[str, list[int]] = defaultdict(list)  # of each tag, where it is open in the stack
        self.containers: list[int] = []  # where any container is open
        self.asides: list[int] = []  # where a menu, header or the like is open
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, characters in links, container
        self.items: set[int] = set()  # lines inside list items
        self.held: set[int] = set()  # lines of articles inside a wrapper named as surrounding
        self.parents = [0]  # of each container; the page itself is 0
        self.article_of: dict[int, int] = {}  # container: the outermost article or main around it
        self.parts: list[str] = []
        self.tags = self.links = self.link_depth = 0

    def _state(self) -> tuple[bool, int, int]:
        return self.stack[-1][1:] if self.stack else (False, FREE, 0)

    def _cut(self, at: int) -> None:
        """End all elements from ``at`` on, links left open among them."""
        while len(self.stack) > at:
            tag, *_ = self.stack.pop()
            self.places[tag].pop()
            self.link_depth -= tag == "a"
            for held in (self.containers, self.asides):
                if held and held[-1] == len(self.stack):
                    held.pop()

    def _flush(self) -> None:
        silent, around, container = self._state()
        text = " ".join("".join(self.parts).split())
        if text:
            if around == HELD:
                self.held.add(len(self.lines))
            if self.places["li"]:
                self.items.add(len(self.lines))
            self.lines.append((text, self.tags, self.links, container))
        if text or silent or around:
            self.tags = 0
        self.parts, self.links = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag in ("article", "main") and self.asides:
            # A menu or header that was never closed ends where the article starts.
            self._cut(self.asides[0])
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and any(t == tag for t, *_ in self.stack[-3:]):
            self._close(tag, self.stack[-3:])
        silent, around, container = self._state()
        article = self.article_of.get(container)
        if tag in CONTAINERS:
            self.parents.append(container)
            container = len(self.parents) - 1
            if article is not None or tag in ("article", "main"):
                self.article_of[container] = container if article is None else article
        if tag in ASIDE and not (tag == "header" and article is not None):  # an article's own heading
            surrounding = OUT
        elif tag in BLOCKS | {"span"} and tag not in ("html", "body"):
            names = " ".join(v for k, v in attrs if k in ("class", "id") and v)
            role = " ".join(v for k, v in attrs if k == "role" and v)
            surrounding = surrounding_by_name(tag, names, role) if names or role else FREE
        else:
            surrounding = FREE
        if around == WRAPPED and surrounding == FREE and tag in ("article", "main"):
            around = HELD
        elif around != OUT and surrounding != FREE:
            around = surrounding
        self.link_depth += tag == "a"
        self.places[tag].append(len(self.stack))
        if tag in CONTAINERS:
            self.containers.append(len(self.stack))
        if around and tag in ASIDE:
            self.asides.append(len(self.stack))
        self.stack.append((tag, silent or tag in SILENT, around, container))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag in BLOCKS:
            self._flush()
        self.tags += 1

    def _close(self, tag: str, near: list) -> None:
        at = len(self.stack) - len(near) + next(i for i in range(len(near) - 1, -1, -1) if near[i][0] == tag)
        if any(t in CONTAINERS and t != tag for t, *_ in self.stack[at + 1 :]):
            return
        self._flush()
        self._cut(at)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
        # The innermost one ends, with all that is in it, unless a container opened since keeps an inline tag from reaching it.
        if self.places[tag] and (tag in BLOCKS or not self.containers or self.containers[-1] <= self.places[tag][-1]):
            self._cut(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        silent, around, _ = self._state()
        if silent or around in (WRAPPED, OUT):
            self.parts.append(" ")
            return
        self.parts.append(data)
        if self.link_depth:
            self.links += len(data)

    def finish(self) -> None:
        self.close()
        self._flush()


def smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; the kernel is cut at three sigma and re-weighted at the ends."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(values, kernel, "full")[reach : reach + len(values)]
    return total / np.convolve(np.ones(len(values)), kernel, "full")[reach : reach + len(values)]


def two_clusters(values: np.ndarray) -> float:
    """The threshold between two clusters: midway between their means, to a fixed point."""
    low, high = float(values.min()), float(values.max())
    cut = (low + high) / 2
    for _ in range(32):
        above = values >= cut
        if above.all() or not above.any():
            return low
        moved = (float(values[above].mean()) + float(values[~above].mean())) / 2
        if abs(moved - cut) < 1e-9:
            break
        cut = moved
    return cut


def region(parents: list[int], home: np.ndarray, marked: np.ndarray, size: np.ndarray, in_links: np.ndarray) -> np.ndarray:
    """Which lines lie in the nearest container of all marked ones, widened while what joins is not mostly links.

    A heading, a short section or a table row beside the marked text has no mark of its own, but belongs to it.
    """
    count = len(parents)
    held, chars, links = (np.bincount(home, w, count).tolist() for w in (marked, size, in_links))
    for container in range(count - 1, 0, -1):  # a parent comes before what it holds
        for sums in (held, chars, links):
            sums[parents[container]] += sums[container]
    at = max(container for container in range(count) if held[container] == held[0])
    while at and 2 * (links[parents[at]] - links[at]) <= chars[parents[at]] - chars[at]:
        at = parents[at]
    inside = [container == at for container in range(count)]
    for container in range(at + 1, count):
        inside[container] = inside[parents[container]]
    return np.array(inside)[home]


def menus(keep: np.ndarray, content: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Runs of list items that are one short link each, before or after all content lines that are kept."""
    found = np.zeros(len(keep), bool)
    text = np.flatnonzero(keep & content)
    if not len(text):
        return found
    edge = np.flatnonzero(keep & links)
    for side in (edge[edge < text[0]], edge[edge > text[-1]]):
        for run in np.split(side, np.flatnonzero(np.diff(side) > 1) + 1):
            if len(run) >= _MENU_ITEMS:
                found[run] = True
    return found


def main_text(page: str, *, sigma: float = 1.0, link_share: float = 0.6) -> str:
    """The main text of one page."""
    start = page.rfind("<")
    if start >= 0 and _CUT_TAG.match(page, start):
        page = page[:start]  # the page stops inside a tag
    parser = _Lines()
    parser.feed(page)
    parser.finish()
    lines, items = parser.lines, [i in parser.items for i in range(len(parser.lines))]
    if parser.held:
        # Such articles count where they hold more than all other text; then the wrapper is named wrongly.
        held = sum(len(lines[i][0]) for i in parser.held)
        if 2 * held <= sum(len(text) for text, *_ in lines):
            kept = [i for i in range(len(lines)) if i not in parser.held]
            lines, items = [lines[i] for i in kept], [items[i] for i in kept]
    if not lines:
        return ""
    size = np.array([len(text) for text, *_ in lines], float)
    tags = np.array([max(1, n) for _, n, *_ in lines], float)
    in_links = np.array([n for _, _, n, _ in lines], float)
    linked = in_links > link_share * size
    ratio = np.log1p(np.where(linked, 0.0, size) / tags)
    smoothed = smooth(ratio, sigma)
    # Lines of one kind only (a page of one paragraph, say) form one cluster.
    content = (smoothed >= two_clusters(smoothed)) & ~linked if np.ptp(ratio) > 1e-9 else ~linked
    home = np.array([container for *_, container in lines])
    article = np.array([parser.article_of.get(container, -1) for container in home.tolist()])
    tagged = article >= 0
    if tagged.any() and 2 * size[content & tagged].sum() >= size[content].sum():
        # The tag and the clusters agree: whole articles, without those that are only links beside others.
        chosen = np.unique(article[tagged & ~linked])
        keep = np.isin(article, chosen) if len(chosen) else tagged
    else:
        # The region of all marked text, widened to the own text of articles.
        marked = content | (tagged & ~linked)
        keep = region(parser.parents, home, marked, size, in_links) if marked.any() else marked
        keep = keep & ~menus(keep, content, np.array(items) & (in_links >= size) & (size <= _MENU_CHARS))
    places = np.flatnonzero(keep)
    while len(places) and len(lines[places[-1]][0]) <= _LEGAL_CHARS and _LEGAL.match(lines[places[-1]][0]):
        keep[places[-1]] = False  # a legal notice closes the page
        places = places[:-1]
    return " ".join(text for (text, *_), kept in zip(lines, keep.tolist(), strict=True) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    prepare(pages.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                text = main_text(html)
                yield page_id, url, text, len(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), schema, lambda row: 2 * len(row[2]) + 128)

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), whole_text("html").alias("html"))
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
