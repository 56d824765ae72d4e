"""HTML extraction: main text of pages from text-to-tag ratios over parser events.

The standard library's parser feeds one page at a time.  Its events are folded into blocks: a block is
the text between two block-level tags, with the number of tags met on its way and the containers it
stands in.  Each block has a text-to-tag ratio; ratios are smoothed by a Gaussian and the blocks above
a threshold, taken from the page's own spread, form clusters.  The container that holds the clusters'
text is the content region, and all of its blocks that are no page furniture are the article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Fixed tag names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre search section select summary table "
    "tbody td template textarea tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template head title iframe object svg canvas select option textarea button datalist".split()
)
FURNITURE = frozenset("nav footer menu dialog search".split())
#: Tags that are furniture only where they hold little of the page's text, as names and hidden elements are.
MINOR = frozenset("aside form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tags whose end is implied by the next tag of the same kind, and what bounds the search for them.
IMPLIED = {
    "p": frozenset(["p"]),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
}
BOUNDS = frozenset("article aside body div dl footer form header html main nav ol section table td th ul".split())
#: Names and roles of furniture in id, class and role attributes, as whole words.
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus dialog disclaimer footer form gdpr menu modal nav navbar "
    "navigation newsletter notice notices popup promo promoted promotion related replies respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
_NAME = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")
#: Deviation of the smoothing, in blocks, and threshold as a fraction of the ratios' deviation.
SMOOTH = 1.0
THRESHOLD = 0.5


def _hidden(attributes: list[tuple[str, str | None]]) -> bool:
    return any(key == "hidden" or (key == "aria-hidden" and value == "true") for key, value in attributes)


def _named(attributes: list[tuple[str, str | None]]) -> bool:
    for key, value in attributes:
        if key in ("class", "id", "role") and value:
            for name in value.split():
                words = _NAME.split(re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower())
                if FURNITURE_NAMES & set(words):
                    return True
    return False


@dataclass(frozen=True)
class Open:
    """An open element and what holds for the text directly in it."""

    tag: str
    container: int = 0
    furniture: bool = False
    minor: int = -1  # innermost element that is furniture only if it is small
    in_article: bool = False
    in_main: bool = False  # in an article or main
    header: int = -1  # container around a header that stands in no article or main


class Blocks(HTMLParser):
    """Folds parser events into blocks; every event takes constant time, whatever the depth."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [Open("")]
        # Places in the stack of each open tag, and of the elements that bound the search for an implied end.
        self.places: dict[str, list[int]] = {}
        self.bounds: list[int] = []
        self.silent = 0
        self.containers: list[tuple[int, str]] = [(-1, "")]
        # Elements that may be furniture: the one around each, and whether it stands in an article.
        self.minor: list[tuple[int, bool]] = []
        self.holders: set[int] = set()  # those that are or hold article or main
        self.blocks: list[tuple[str, int, Open]] = []
        self.text: list[str] = []
        self.tags = 0

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        self.text.clear()
        if text:
            self.blocks.append((text, self.tags, self.stack[-1]))
            self.tags = 0

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
            if tag in IMPLIED:
                self._close(max((self._last(t) for t in IMPLIED[tag]), default=0), self._bound())
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        above = self.stack[-1]
        container, minor, page = above.container, above.minor, tag in ("html", "body")
        if not page and (tag in MINOR or _hidden(attributes) or _named(attributes)):
            self.minor.append((minor, above.in_article))
            minor = len(self.minor) - 1
        marked = tag in ("article", "main")
        around = minor
        while marked and around >= 0 and around not in self.holders:
            self.holders.add(around)
            around = self.minor[around][0]
        # A header inside the article holds its title; whether another one does depends on the region found.
        header = above.header
        if tag == "header" and not above.in_main and header < 0:
            header = container
        if tag in BLOCKS and tag not in IMPLIED and tag not in HEADINGS:
            self.containers.append((container, tag))
            container = len(self.containers) - 1
        self.silent += tag in SILENT
        own = above.furniture or tag in FURNITURE or tag in SILENT
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BOUNDS:
            self.bounds.append(len(self.stack))
        self.stack.append(Open(tag, container, own, minor, above.in_article or tag == "article", above.in_main or marked, header))

    def _last(self, tag: str) -> int:
        """Place of the innermost open element of a tag; zero if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def _bound(self) -> int:
        return self.bounds[-1] if self.bounds else 0

    def _close(self, at: int, bound: int = 0) -> None:
        """Close the element at a place and all inside it, unless it lies outside of ``bound``."""
        if at and at >= bound:
            for element in self.stack[at:]:
                self.places[element.tag].pop()
                self.silent -= element.tag in SILENT
            del self.stack[at:]
            while self.bounds and self.bounds[-1] >= at:
                self.bounds.pop()

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
        # An end tag of an inline element closes no container around it.
        self._close(self._last(tag), 0 if tag in BLOCKS else self._bound())

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)
        if tag not in VOID and tag in ("script", "style", "svg", "iframe"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data)

    def close(self) -> None:
        super().close()
        self._flush()


def smoothed(ratios: np.ndarray, deviation: float = SMOOTH) -> np.ndarray:
    """Gaussian smoothing that keeps the sum of weights at the ends."""
    reach = int(np.ceil(3 * deviation))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / deviation) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weights


def _clusters(ratios: np.ndarray, furniture: np.ndarray) -> np.ndarray:
    """Blocks whose smoothed ratio is above the threshold; furniture has the ratio zero and is none."""
    ratios = np.where(furniture, 0.0, ratios)
    if not ratios.any():
        return np.zeros(len(ratios), bool)
    smooth = smoothed(ratios)
    return (smooth >= min(THRESHOLD * ratios.std(), smooth[~furniture].max())) & ~furniture


def _held(parents: list[int], own: dict[int, float]) -> list[float]:
    """Sum of each node's own value and those of all nodes inside it; parents come before their children."""
    sums = [own.get(n, 0.0) for n in range(len(parents))]
    for n in range(len(parents) - 1, 0, -1):
        if parents[n] >= 0:
            sums[parents[n]] += sums[n]
    return sums


def _below(parents: list[int], chosen: set[int]) -> list[bool]:
    """Whether each node is chosen or inside a chosen one."""
    inside: list[bool] = []
    for n, parent in enumerate(parents):
        inside.append(n in chosen or (parent >= 0 and inside[parent]))
    return inside


def _text_by(places: list[int], sizes: np.ndarray, content: np.ndarray) -> dict[int, float]:
    found: dict[int, float] = {}
    for at in np.flatnonzero(content).tolist():
        found[places[at]] = found.get(places[at], 0.0) + sizes[at]
    return found


def _ruled_out(parser: Blocks, sizes: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Blocks inside an element that a name, a tag such as form or a hidden state rules out.

    These decide small blocks only: they do not count on an element that is or holds article or main,
    unless that stands in an article itself, nor on one with most of the text of the clusters, which are
    those of the page without regard to them.
    """
    places = [b[2].minor for b in parser.blocks]
    held = _held([around for around, _ in parser.minor], _text_by(places, sizes, content))
    half = sizes[content].sum() / 2
    out = {n for n, (_, nested) in enumerate(parser.minor) if held[n] <= half and (n not in parser.holders or nested)}
    inside = _below([around for around, _ in parser.minor], out)
    return np.array([n >= 0 and inside[n] for n in places])


def main_text(html: str | None) -> str:
    """Article of a page, one line per block; empty if there is none."""
    html = html or ""
    # A comment that nothing ends goes on to the end of the page.
    opened = html.rfind("<!--")
    if opened >= 0 and "-->" not in html[opened:] and "</script" not in html[opened:].lower():
        html = html[:opened]
    parser = Blocks()
    parser.feed(html)
    parser.close()
    blocks = parser.blocks
    if not blocks:
        return ""
    in_header = np.array([b[2].header >= 0 for b in blocks])
    furniture = np.array([b[2].furniture for b in blocks])
    sizes = np.array([len(b[0]) for b in blocks], dtype=np.float64)
    ratios = sizes / np.maximum(1, [b[1] for b in blocks])
    if parser.minor:
        furniture |= _ruled_out(parser, sizes, _clusters(ratios, furniture | in_header))
    content = _clusters(ratios, furniture | in_header)
    if not content.any():
        return ""
    # Text of the clusters by container, each container holding that of the containers inside it.
    parents = [around for around, _ in parser.containers]
    held = _held(parents, _text_by([b[2].container for b in blocks], sizes, content))
    marked = {c for c, (_, tag) in enumerate(parser.containers) if tag in ("article", "main")}
    nested = _below(parents, marked)
    outer = {c for c in marked if held[c] > 0 and not (parents[c] >= 0 and nested[parents[c]])}
    if outer:
        # Marked articles that hold clusters; a feed of several articles is read in page order.
        regions = outer
    else:
        # The innermost container that holds all clusters: of those, which lie in each other, the last one opened.
        whole = sizes[content].sum()
        regions = {max(c for c, text in enumerate(held) if text >= whole)}
    inside = _below(parents, regions)
    # A header belongs to the page, unless it stands in a content region that is not the page itself.
    own = {c for c in regions if parser.containers[c][1] not in ("", "html", "body")}
    titled = _below(parents, own)
    lines = [
        text
        for at, (text, _, element) in enumerate(blocks)
        if not furniture[at] and inside[element.container] and (element.header < 0 or titled[element.header])
    ]
    return "\n".join(lines)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page", "text"])


def extract(pages: DataFrame, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: page_id, url, text.

    Null and empty pages, and pages that are all furniture, have an empty text.  Unclosed tags close
    with their container, repeated rows keep their own row, other columns are not read.
    """
    page = F.struct(F.col(page_id).alias("page_id"), F.col(url).alias("url")).alias("page")
    read = pages.select(page, F.col(html).cast("string").alias("html"))
    schema = StructType([read.schema["page"], StructField("text", StringType())])
    return read.mapInArrow(_extract, schema).select("page.*", "text")


def digest(texts: DataFrame) -> DataFrame:
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
