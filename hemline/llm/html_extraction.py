"""Main text of web pages by smoothed text-to-tag ratios.

The standard library's parser streams events; every block boundary ends a line, which has its text
(references decoded, white space runs as one blank), its number of tags and linked characters, and the
content container (article, main, else section, division or body) it lies in. Lines inside menus,
headers, footers, sidebars, notices, adverts, controls of forms, comments and the like are no
candidates; they are told by element, or by a class, id or role all of whose words name such things
or parts of a page's frame. A form is left out unless more than half of the page's text lies in it.
Where a page has an article or main element with text, only its lines are candidates.

A candidate's ratio is its characters per tag. The candidates' ratios, in page order, are smoothed with
a Gaussian and split in two clusters. A container with a line in the upper cluster is content, and
its other lines, short ones too, are kept; but three and more successive lines that are links as a
whole, most of them in the lower cluster, are a list of links, and left out.

One page is parsed at a time, row by row without a shuffle. NULL and empty html give an empty text.
Unclosed and stray tags are tolerated. Repeated rows give equal rows, an empty table an empty one;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemline.llm.common import small_batches

SIGMA = 1.0

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
#: Elements that never hold main text.
DROPPED = frozenset(
    "nav footer aside label legend datalist script style noscript template button select option textarea iframe object svg canvas "
    "dialog menu head title audio video map".split())
CONTAINERS = frozenset("article main section div body td".split())
#: Words of a class, id or role that name adverts and notices, on any element.
NOTICES = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscri\w+")
#: Words that name other things than main text, on elements that hold blocks.
MARKS = re.compile(
    r"sidebar|menu|nav\w*|breadcrumbs?|header|footer|masthead|comments?|disqus|replies|social|share|sharing|related|"
    r"recommend\w*|widget|login|signup|search|pagination|pager")
#: Words that may stand beside them and only say where or what kind of box it is.
FRAME = frozenset(
    "area article bar block blog body bottom box button buttons col column container entry global group icons inner item items "
    "left link links list main module outer page panel post posts primary reader right row secondary section site slot sticky "
    "stories story text top unit user wrap wrapper".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption table dl dt dd".split())
#: Successive lines of nothing but links that make a list of links.
LINK_LIST = 3
CLOSED_BY_BLOCK = frozenset({"p"})
CLOSED_BY_SAME = frozenset("li dt dd tr td th option".split())


def marked(tag: str, names: str) -> bool:
    """Whether one of the names says that an element isn't main text."""
    for name in names.lower().split():
        words = [w for w in re.split(r"[-_\d]+", name) if w]
        notices = [bool(NOTICES.fullmatch(w)) for w in words]
        marks = [bool(MARKS.fullmatch(w)) for w in words]
        if (any(notices) or (any(marks) and tag not in TEXT_BLOCKS)) and all(
                n or m or w in FRAME for w, n, m in zip(words, notices, marks)):
            return True
    return False


class Line(NamedTuple):
    text: str
    tags: int
    linked: int  # characters inside links
    container: int
    article: bool
    form: int  # number of the form it lies in, or 0


class _State(NamedTuple):
    """What holds inside an open element."""

    dropped: bool = False
    container: int = 0
    article: bool = False
    form: int = 0
    link: bool = False


class _Lines(HTMLParser):
    """Collects the lines of a page; those that are dropped have no text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, _State]] = []
        self.pieces: list[str] = []
        self.tags = self.containers = self.forms = self.linked = 0

    def _state(self) -> _State:
        return self.open[-1][1] if self.open else _State()

    def _end_line(self) -> None:
        text, state = " ".join("".join(self.pieces).split()), self._state()
        if text and not state.dropped:
            self.lines.append(Line(text, self.tags, self.linked, state.container, state.article, state.form))
        self.pieces, self.tags, self.linked = [], 0, 0

    def _close(self, tag: str, within: frozenset[str] | None = None) -> bool:
        """Close the innermost open ``tag``, unless an element not in ``within`` lies between."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                return True
            if within is not None and self.open[at][0] not in within:
                return False
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag not in INLINE
        if block:
            self._end_line()
            if tag not in VOID:
                for closed in CLOSED_BY_BLOCK:
                    self._close(closed, INLINE)
                if tag in CLOSED_BY_SAME:
                    self._close(tag, INLINE | CLOSED_BY_BLOCK)
        self.tags += 1
        if tag in VOID:
            return
        state, content = self._state(), tag in ("article", "main")
        names = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        dropped = tag in DROPPED or (tag == "header" and not state.article) or (
            tag not in ("html", "body") and not (content and not state.article) and marked(tag, names))
        article, container, form = state.article or content, state.container, state.form
        if content or (tag in CONTAINERS and not article):
            self.containers += 1
            container = self.containers
        if tag == "form":
            self.forms += 1
            form = self.forms
        self.open.append((tag, _State(state.dropped or dropped, container, article, form, state.link or tag == "a")))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID or tag in INLINE:
            self.tags += 1
            if tag not in INLINE:
                self._end_line()
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        self._close(tag)

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)
        if self._state().link:
            self.linked += len(data)

    def finish(self) -> list[Line]:
        self.close()
        self._end_line()
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach), kernel / kernel.sum(), mode="valid")


def upper_cluster(values: np.ndarray) -> np.ndarray:
    """Which values lie in the upper of two clusters; all of them when they are alike."""
    threshold = (values.min() + values.max()) / 2
    while True:
        upper = values >= threshold
        if upper.all():
            return upper
        moved = (values[upper].mean() + values[~upper].mean()) / 2
        if moved == threshold or ((values >= moved) == upper).all():
            return upper
        threshold = moved


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    lines = parser.finish()
    in_form: dict[int, int] = {}
    for line in lines:
        in_form[line.form] = in_form.get(line.form, 0) + len(line.text)
    total = sum(in_form.values())
    lines = [x for x in lines if not x.form or 2 * in_form[x.form] > total]
    lines = [x for x in lines if x.article] or lines
    if not lines:
        return ""
    high = upper_cluster(smoothed(np.array([len(x.text) / max(x.tags, 1) for x in lines])))
    chosen = {x.container for x, upper in zip(lines, high) if upper}
    kept: list[str] = []
    for is_link, run in groupby(zip(lines, high), key=lambda pair: pair[0].linked >= len(pair[0].text)):
        own = list(run)
        if not is_link or len(own) < LINK_LIST or 2 * sum(upper for _, upper in own) >= len(own):
            kept += [x.text for x, _ in own if x.container in chosen]
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    small_batches(pages.sparkSession, 500)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
