"""Main text of web pages by text-to-tag ratios.

The events of the standard library's parser are read as a stream into lines, one for each block of
text. A line's ratio is its text's length by its number of tags; lines inside menus and the like have
ratio 0. The ratios are smoothed by a Gaussian, and two-means clustering of the smoothed values gives
the threshold that content lines exceed. What is kept is all article and main elements that have
content lines, with the headings and paragraphs of the sections around them; where most content stands
elsewhere, the smallest section that holds all of it and has no text of an outer section beside it. It
is whole but for its boilerplate: short paragraphs belong to the article, wherever they stand. If
that section is the page's body, it begins at the first content line, with the headings and paragraphs
before it.

Words of class, id or role are hints: one that only says that a thing is absent or switched
(``has-sidebar``, ``share-enabled``) is none, and one at an element that holds an article, or more than
all unsuspected text, isn't believed. So is a form around the page.

Defined results: a null or empty page, or one without text, gives the empty string; elements that
are never closed end where an outer one does, or with the page; repeated rows are read each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches

# Elements that hold no text of an article, elements that end a line of text, and
# words of class, id or role that name boilerplate.
SKIPPED = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video nav menu "
    "footer aside button select option textarea input label dialog".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that a new block of the same kind ends when they are still open.
IMPLIED = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# Foreign matter wherever it stands, and parts of a page's frame.
FOREIGN = (
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alert|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|paywall|comments?|disqus|replies|respond"
)
FRAME = (
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-?bar|widgets?|related|recommend\w*|share|"
    r"sharing|social|footer|masthead|site-?header|page-?header|toolbar|skip-?link|pagination|pager|"
    r"login|signup|search"
)
# What makes a name say that something is absent or switched, not that this is it.
STATES = frozenset(
    "has have no not non with without is hide show enable disable enabled disabled free ready visible "
    "on off open closed js".split()
)
_FOREIGN, _FRAME = (re.compile(rf"(?:.*[_-])?(?:{x})(?:[_-].*)?") for x in (FOREIGN, FRAME))
SIGMA = 1.5
#: A lone paragraph, heading, list or table is no region: what stands beside it may belong to it.
PROSE = frozenset({"p", "pre", "blockquote"}) | HEADINGS
NO_REGION = PROSE | frozenset("ul ol dl li dt dd table caption tbody thead tfoot tr td th".split())
BODY = ("", "html", "body")
MAIN = frozenset({"article", "main"})


def named(attributes) -> str:
    """What class, id and role say of an element: ``foreign``, ``frame`` or nothing."""
    found = ""
    for key, value in attributes:
        if key in ("class", "id", "role", "itemtype") and value:
            for token in value.lower().split():
                words = re.split("[_-]+", token)
                if words[0] in STATES or words[-1] in STATES:
                    continue
                if _FOREIGN.fullmatch(token):
                    return "foreign"
                if _FRAME.fullmatch(token):
                    found = "frame"
    return found


class _Lines(HTMLParser):
    """Lines of text with their tags and the elements that hold them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # open elements: tag, number, whether its text is none of an article's
        self.open: list[tuple[str, int, bool]] = [("", 0, False)]
        self.parent = [-1]
        self.names = [""]
        #: What an element's name says of it, see ``named``; forms are parts of the frame.
        self.said = [""]
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.holder: list[int] = []
        self.skipped: list[bool] = []
        self.heading: list[bool] = []
        self._many: Counter = Counter()  # open elements by tag
        self._parts: list[str] = []
        self._count = 0

    def end_line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.texts.append(text)
            self.tags.append(self._count)
            self.holder.append(self.open[-1][1])
            self.skipped.append(self.open[-1][2])
            self.heading.append(any(self._many[tag] for tag in HEADINGS))
            self._count = 0
        self._parts = []

    def _skips(self, tag: str, attributes) -> bool:
        """Whether the tag alone says that its text is none of an article's."""
        if tag in SKIPPED:
            return True
        if tag == "header":
            return not any(self._many[name] for name in MAIN)
        return any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attributes)

    def _says(self, tag: str, attributes) -> str:
        if tag in ("html", "body"):
            return ""
        said = named(attributes)
        if said == "frame" and (tag in PROSE or tag in MAIN):
            return ""
        return said or ("frame" if tag == "form" else "")

    def _pop_to(self, place: int) -> None:
        self.end_line()
        self._many.subtract(tag for tag, _, _ in self.open[place:])
        del self.open[place:]

    def handle_starttag(self, tag, attributes):
        if tag in BLOCKS:
            self.end_line()
            ends = IMPLIED.get(tag, ())
            if self.open[-1][0] == "p":
                self._pop_to(len(self.open) - 1)
            if self.open[-1][0] in ends:
                self._pop_to(len(self.open) - 1)
        self._count += 1
        if tag in VOID:
            if tag == "br":
                self._parts.append(" ")
            return
        outer = self.open[-1][2]
        skip = outer or self._skips(tag, attributes)
        said = "" if skip else self._says(tag, attributes)
        if tag in BLOCKS or said or (skip and not outer):
            if tag not in BLOCKS:
                self.end_line()
            self.parent.append(self.open[-1][1])
            self.names.append(tag)
            self.said.append(said)
            self.open.append((tag, len(self.parent) - 1, skip))
            self._many[tag] += 1

    def handle_startendtag(self, tag, attributes):
        if tag in VOID:
            self.handle_starttag(tag, attributes)
        else:
            self.handle_starttag(tag, attributes)
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._count += 1
        for place in range(len(self.open) - 1, 0, -1) if self._many[tag] else ():
            if self.open[place][0] == tag:
                self._pop_to(place)
                return
            # a stray end tag closes no section around it
            if tag not in BLOCKS and self.open[place][0] in BLOCKS:
                break
        if tag in BLOCKS:
            self.end_line()

    def handle_data(self, data):
        self._parts.append(data)

    def updatepos(self, i, j):
        return j  # line numbers aren't asked for


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    radius = int(np.ceil(3 * sigma))
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    weights = np.convolve(np.ones(len(values)), kernel)[radius : radius + len(values)]
    return np.convolve(values, kernel)[radius : radius + len(values)] / weights


def threshold(values: np.ndarray) -> float:
    """Middle of the centres of two clusters."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        middle = (low + high) / 2
        below = values <= middle
        if below.all() or not below.any():
            break
        centres = float(values[below].mean()), float(values[~below].mean())
        if centres == (low, high):
            break
        low, high = centres
    return (low + high) / 2


def _sums(page: _Lines, lines: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of some lines in each element."""
    out = np.zeros(len(page.parent))
    np.add.at(out, np.array(page.holder)[lines], values[lines])
    for number in range(len(out) - 1, 0, -1):  # a child has a higher number than its parent
        out[page.parent[number]] += out[number]
    return out


def _within(page: _Lines, marked: np.ndarray) -> np.ndarray:
    """Marked elements and all that they hold."""
    out = marked.copy()
    for number in range(1, len(out)):
        out[number] |= out[page.parent[number]]
    return out


def _boilerplate(page: _Lines, lengths: np.ndarray, hard: np.ndarray) -> np.ndarray:
    """Lines that aren't an article's by the names of the elements around them.

    A name is believed unless the element holds articles with more text than those that nothing is
    said of, or has more text than the rest of the page (for foreign matter: is all there is).
    """
    said = np.array(page.said)
    suspect = _within(page, said != "")
    main = np.array([n in MAIN for n in page.names])
    articles = _within(page, main & ~suspect)
    text = _sums(page, ~hard, lengths)
    holds = _sums(page, ~hard & _within(page, main & (said == ""))[page.holder], lengths)
    plain = float(lengths[~hard & articles[page.holder]].sum())
    outside = float(lengths[~hard & ~suspect[page.holder]].sum())
    believed = np.zeros(len(said), bool)
    for number in np.flatnonzero(said != ""):
        foreign = said[number] == "foreign"
        if holds[number]:
            believed[number] = plain > 0 if foreign else plain >= text[number]
        elif plain:
            believed[number] = True
        else:
            believed[number] = outside > 0 if foreign else outside >= text[number]
    return _within(page, believed)[page.holder]


def _region(page: _Lines, mass: np.ndarray, skipped: np.ndarray) -> int:
    """Number of the element whose text is kept; ``mass`` is each element's content text.

    The smallest section that holds all content lines, or an outer one with text of its own beside it.
    """
    region = 0
    for number in range(1, len(mass)):
        section = page.names[number] not in NO_REGION
        if section and page.parent[number] == region and mass[number] >= mass[0]:
            region = number
            if page.names[number] in MAIN:
                break  # an article is whole
    section_of = _sections(page)
    # sections with text of their own, the body only by paragraphs and headings: it has menus too
    own = {
        section_of[holder]
        for holder, skip in zip(page.holder, skipped, strict=True)
        if not skip
        and (page.names[section_of[holder]] not in BODY or page.names[holder] in PROSE)
    }
    wider = region
    while page.parent[wider] >= 0:
        wider = page.parent[wider]
        if wider in own:
            region = wider
    return region


def _sections(page: _Lines) -> list[int]:
    """For each element the nearest one around it, or itself, that is a section."""
    out = list(range(len(page.parent)))
    for number in range(1, len(out)):
        if page.names[number] in NO_REGION:
            out[number] = out[page.parent[number]]
    return out


def _articles(page: _Lines, mass: np.ndarray, skipped: np.ndarray) -> np.ndarray | None:
    """Lines of all outermost article and main elements with content, and of what belongs to them:

    headings and paragraphs of the sections around them. None if most content is elsewhere.
    """
    marked = np.array([n in MAIN for n in page.names]) & (mass > 0)
    inside = _within(page, marked)
    tops = [n for n in np.flatnonzero(marked) if not inside[page.parent[n]]]
    if not tops or mass[tops].sum() < 0.5 * mass[0]:
        return None
    around = set()
    for number in tops:
        up = page.parent[number]
        while up >= 0 and up not in around:
            around.add(up)
            up = page.parent[up]
    sections = _sections(page)
    holder = np.array(page.holder)
    beside = np.array(
        [page.names[h] in PROSE and sections[h] in around for h in page.holder], bool
    )
    # a title in a box of its own
    boxes = _sums(page, ~skipped, np.ones(len(holder)))
    title = np.array([page.names[h] == "h1" and boxes[sections[h]] == 1 for h in page.holder], bool)
    return ~skipped & (inside[holder] | beside | title)


def main_text(html: str | None) -> str:
    page = _Lines()
    page.feed(html or "")
    page.close()
    page.end_line()
    hard = np.array(page.skipped, bool)
    if not len(hard) or hard.all():
        return ""
    lengths = np.array([len(t) for t in page.texts], float)
    skipped = hard | _boilerplate(page, lengths, hard)
    if skipped.all():
        return ""
    ratios = np.where(skipped, 0.0, lengths / np.maximum(np.array(page.tags), 1))
    smooth = smoothed(ratios)
    content = ~skipped & (smooth >= threshold(smooth))
    if not content.any():
        content = ~skipped
    mass = _sums(page, content, lengths)
    kept = _articles(page, mass, skipped)
    if kept is None:
        region = _region(page, mass, skipped)
        marked = np.zeros(len(mass), bool)
        marked[region] = True
        kept = ~skipped & _within(page, marked)[page.holder]
        if page.names[region] in BODY:
            first = at = int(np.flatnonzero(content)[0])
            while at and (
                skipped[at - 1] or page.heading[at - 1] or page.names[page.holder[at - 1]] in PROSE
            ):
                at -= 1
                first = first if skipped[at] else at
            kept[:first] = False
    return "\n".join(t for t, k in zip(page.texts, kept, strict=True) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each row of ``pages``."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1 << 24):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        read, f"page_id {kind}, url string, text string, n_chars long"
    )
