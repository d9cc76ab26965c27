"""Main text of a web page from the standard library's streaming parser.

Parser events become lines: the text between block-level tags, with its number of tags. Each line
gets its text-to-tag ratio, that of characters outside links; the ratios are smoothed with a Gaussian;
lines at or above the mean smoothed ratio form the content cluster. The cluster chooses in three
steps, whatever the elements are called:

* its lines vote, by their length, for the elements around them: the content region is the deepest
  element that holds most of the votes;
* where that element lies in an ``article`` or ``main``, the region grows to it, so that headlines and
  short last lines stay; where several of these lie in the region, it shrinks to the one with most
  votes; where none does, one elsewhere with ``PART`` of the votes takes its place. Without such an element the region runs from the first to the last line of the cluster,
  with the headings just before;
* within the region, runs of at least ``RUN`` lines outside the cluster go if their text is mostly links:
  menus and lists of links that no name marks.

Names help with what ratios cannot tell: left out everywhere are navigation, page headers, footers,
asides, forms, scripts, styles, and elements whose class, id or role names an advert, notice, menu,
comment section and the like.

Character references are decoded; white space within a line becomes one space; lines are joined by
``\\n`` in page order; nothing is capped. Null or empty html, and pages without text, give "". Unclosed
tags are closed by what follows, as browsers do. Repeated rows and null ids are kept, extra columns
ignored, whatever their names; an empty table gives no rows; pages of any length and nesting are
read whole, in linear time.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA, RADIUS, SHARE, PART, RUN, LINKS = 1.0, 2, 0.6, 0.25, 3, 0.8
#: HTML element names by their role here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr html"
    " legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = set(
    "applet aside audio button canvas datalist dialog footer form frameset head iframe input link map math menu meta nav noframes noscript object script search"
    " select style svg template textarea title video".split()
)
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
REGIONS = {"article", "main"}
#: Parts of class names, ids and roles that mark boilerplate.
MARKS = set(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo"
    " cookie cookies discussion disqus footer masthead menu menubar modal nav navbar navigation newsletter notice notification pager pagination popup promo"
    " promoted promotion recommended related respond responses share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription"
    " toolbar widget".split()
)
REPLIES = set("comment comments commentlist discussion disqus respond responses".split())
#: Boilerplate names outside an article only.
PAGE_MARKS = {"header", "top"}
_PART = re.compile("[A-Za-z]+")


class _Lines(HTMLParser):
    """Collects (text, tags, element, dropped, heading, characters in links) per line; element: the number of the innermost open one, -1 if none.

    Elements are numbered in page order, so a parent's number is smaller than its children's.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = []  # name, number, dropped: 0 no, 1 yes, 2 replies
        self.names: list[str] = []
        self.parents: list[int] = []
        self.lines: list[tuple[str, int, int, bool, bool, int]] = []
        self.regions = self.headings = 0  # open ones
        self.count: dict[str, int] = {}  # open elements by name
        self.blocks: list[int] = []  # places of the open block elements
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.off = 0

    def flush(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                self.lines.append((line, self.tags, self.open[-1][1] if self.open else -1, self.off > 0, self.headings > 0, min(self.linked, len(line))))
            self.text = []
        self.tags = self.linked = 0

    def pop(self, at: int) -> None:
        for x in self.open[at:]:
            self.off -= x[2] > 0
            self.regions -= x[0] in REGIONS
            self.headings -= x[0] in HEADINGS
            self.count[x[0]] -= 1
        del self.open[at:]
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()

    def marked(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in DROPPED:
            return 1
        inside = self.regions > 0
        if tag == "header" and not inside:
            return 1
        if tag in ("html", "body", "main"):
            return 0
        for k, v in attrs:
            if k in ("class", "id", "role") and v:
                parts = {p.lower() for p in _PART.findall(v)}
                if tag != "article" and (parts & MARKS or (not inside and parts & PAGE_MARKS)):
                    return 2 if parts & REPLIES else 1
                if parts & REPLIES:
                    return 2
            elif k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and v and re.search(r"display\s*:\s*none", v)):
                return 1
        return 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            shut = CLOSES_ITSELF.get(tag, set()) | {"p"} | (HEADINGS if tag in HEADINGS else set())
            for i in reversed(self.blocks):
                name = self.open[i][0]
                if name in shut:
                    self.pop(i)
                    break
                if name != "p" and not (tag in ("tr", "td", "th") and name in ("td", "th", "tr")):
                    break
            if tag in REGIONS and self.off:  # an unclosed menu or advert before the content
                for i, x in enumerate(self.open):
                    if x[2] == 1 and x[0] not in REGIONS:
                        self.pop(i)
                        break
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        dropped = self.marked(tag, attrs)
        self.off += dropped > 0
        self.regions += tag in REGIONS
        self.headings += tag in HEADINGS
        self.parents.append(self.open[-1][1] if self.open else -1)
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((tag, len(self.names), dropped))
        self.names.append(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in DROPPED - VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        else:
            self.tags += 1
        if not self.count.get(tag):
            return
        for i in reversed(self.blocks) if tag in BLOCKS else range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                self.pop(i)
                return
            if tag not in BLOCKS and name in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if self.off and (self.open[-1][0] in ("script", "style") or data.isspace()):
            return
        self.text.append(data)
        if self.count.get("a"):
            self.linked += len(" ".join(data.split()))


_KERNEL = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]


def smoothed(ratios: list[float]) -> list[float]:
    """Gaussian mean of each value and its neighbours; at the ends the kernel is cut and scaled."""
    n, found = len(ratios), []
    for i in range(n):
        near = [(ratios[i + k], _KERNEL[k + RADIUS]) for k in range(max(-RADIUS, -i), min(RADIUS, n - 1 - i) + 1)]
        found.append(sum(x * w for x, w in near) / sum(w for _, w in near))
    return found


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.lines
    if not lines:
        return ""
    ratio = smoothed([(len(x[0]) - x[5]) / max(1, x[1]) for x in lines])
    cut = sum(ratio) / len(ratio)
    free = [i for i, x in enumerate(lines) if not x[3]]
    cluster = [i for i in free if ratio[i] >= cut] or free
    if not cluster:
        return ""
    names, parents = parser.names, parser.parents

    def held(which: list[int]) -> list[int]:
        """Characters of the lines within each element."""
        found = [0] * (len(names) + 1)  # the last stands for the page
        for i in which:
            found[lines[i][2]] += len(lines[i][0])
        for e in range(len(names) - 1, -1, -1):
            found[parents[e]] += found[e]
        return found

    def within(region: int) -> list[bool]:
        found = [False] * (len(names) + 1)
        for e in range(len(names)):
            found[e] = e == region or found[parents[e]]
        return found

    votes = held(cluster)
    total = votes[-1]
    region = max((e for e in range(len(names)) if votes[e] >= SHARE * total and names[e] not in ("p", *HEADINGS)), default=-1)
    around = region
    while around >= 0 and names[around] not in REGIONS:
        around = parents[around]
    inside = within(region) if region >= 0 else [True] * (len(names) + 1)
    named = [e for e in range(len(names)) if names[e] in REGIONS and votes[e]]
    marked = [e for e in named if inside[e]] or [e for e in named if votes[e] >= PART * total]
    if around >= 0:
        region, inside = around, within(around)
    elif marked:
        # Of nested ones the inner, as long as it holds most of the votes.
        region = max(marked, key=lambda e: (votes[e], -e))
        inside = within(region)
        for e in marked:
            if e > region and inside[e] and votes[e] >= SHARE * votes[region]:
                region, inside = e, within(e)
    chosen = [i for i in free if inside[lines[i][2]]]
    if around < 0 and not marked:
        first, last = cluster[0], cluster[-1]
        while first and lines[first - 1][4] and not lines[first - 1][3]:
            first -= 1
        chosen = [i for i in chosen if first <= i <= last]
    return "\n".join(lines[i][0] for i in unlinked(lines, chosen, set(cluster)))


def unlinked(lines: list[tuple], chosen: list[int], cluster: set[int]) -> list[int]:
    """The chosen lines without their runs outside the cluster that are mostly links.

    Smoothing lifts the first and last line of such a run into the cluster; they count as links all the same.
    """
    kept, run = [], []
    for i in [*chosen, None]:
        if i is not None and not lines[i][4] and (i not in cluster or lines[i][5] >= LINKS * len(lines[i][0])):
            run.append(i)
            continue
        low = any(k not in cluster for k in run)
        if len(run) < RUN or not low or sum(lines[k][5] for k in run) < LINKS * sum(len(lines[k][0]) for k in run):
            kept += run
        run = []
        if i is not None:
            kept.append(i)
    return kept


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["_id", "_url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), F.col(html_col).alias("_h"))
    return rows.mapInArrow(run, "_id long, _url string, text string, n_chars long").withColumnsRenamed({"_id": id_col, "_url": url_col})
