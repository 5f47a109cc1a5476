"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, and threshold clusters."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import kind, pick, ship, strings

SIGMA, RADIUS = 1.0, 3

# Element names of the HTML standard, by their part here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
OUTSIDE = set(
    "aside audio button canvas datalist dialog footer form head iframe input map menu meter nav noframes noscript object "
    "optgroup option progress script select style svg template textarea title video".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
PARAGRAPHS = HEADINGS | set("blockquote dd dt figcaption li p pre td th".split())
ARTICLES = set("article main".split())
CLOSES_P = BLOCKS - set("body caption dd dt html legend li option summary tbody td tfoot th thead tr".split())
#: A start tag ends the nearest open element of the first set unless one of the second lies between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Whole class names and ids of what surrounds an article. They only weigh the density of lines.
COMMENTS = set("comment comments commentlist disqus replies reply respond responses".split())
TEASERS = set("recommendations recommended related teaser teasers".split())
AROUND = set(
    "ad ads adbox adv advert advertisement advertising alert alerts aside banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright disclaimer flash footer gdpr header hint infobar legal login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification notifications overlay pager pagination paywall popup promo promotion rail share "
    "sharing side sidebar signup skip social sponsor sponsored subscribe subscription tags toast toc toolbar topbar tracking "
    "warning widget widgets".split()
)
#: Words that may stand beside those in a name ("cookie-banner-inner"); any other word makes it another name.
BESIDE = set("area bar block body box container div form inner item list section site wrap wrapper".split())
#: What a name takes from the text-to-tag ratio of the lines below it.
NAMED = 0.05
#: A header of these is the article's own.
OWN_HEADERS = set("article content entry heading post section story title".split())
_name = re.compile(r"[a-z]+")
_hidden = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Element:
    tag: str
    parent: int
    outside: bool = False  # by its tag, role or style, or those of an element around it
    names: tuple[tuple[str, int], ...] = ()  # its names that speak against it, and how strongly


@dataclass
class Line:
    element: int
    outside: bool
    heading: bool
    parts: list[str] = field(default_factory=list)
    tags: int = 1
    linked: int = 0
    text: str = ""


class Lines(HTMLParser):
    """Streams a page into lines: one for each run of text between block boundaries."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", -1)]
        self.open = [0]
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.links = 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
            if tag in CLOSES_P:
                self.close_nearest({"p"}, {"table", "td", "th", "button", "object"})
        if tag in IMPLIED:
            self.close_nearest(*IMPLIED[tag])
        if self.line is not None:
            self.line.tags += 1
            if tag == "br":
                self.line.parts.append(" ")
        if tag in VOID:
            return
        outside = self.elements[self.open[-1]].outside or self.is_outside(tag, attrs)
        self.elements.append(Element(tag, self.open[-1], outside, self.names(tag, attrs)))
        self.open.append(len(self.elements) - 1)
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash says nothing outside foreign elements

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_line()
        elif self.line is not None:
            self.line.tags += 1
        for at in range(len(self.open) - 1, 0, -1):
            found = self.elements[self.open[at]].tag
            if found == tag:
                gone = self.open[at:] if tag in BLOCKS else [self.open[at]]
                self.links -= sum(self.elements[e].tag == "a" for e in gone)
                self.open[at:] = [] if tag in BLOCKS else self.open[at + 1 :]
                return

    def handle_data(self, data):
        if self.line is None:
            if data.isspace():
                return
            element = self.open[-1]
            outside = self.elements[element].outside or (self.in_header() and not self.inside(HEADINGS))
            self.line = Line(element, outside, self.inside(HEADINGS))
            self.lines.append(self.line)
        here = self.elements[self.open[-1]]
        if here.outside and not self.line.outside:
            return  # a script or button within a paragraph
        self.line.parts.append(data)
        if self.links:
            self.line.linked += len(data)

    def close(self):
        super().close()
        self.end_line()

    def end_line(self):
        if self.line is not None:
            self.line.text = " ".join("".join(self.line.parts).split())
            if not self.line.text:
                self.lines.pop()
            self.line = None

    def close_nearest(self, tags, bounds):
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.elements[self.open[at]].tag
            if tag in tags:
                self.links -= sum(self.elements[e].tag == "a" for e in self.open[at:])
                del self.open[at:]
                return
            if tag in bounds:
                return

    def inside(self, tags) -> bool:
        return any(self.elements[e].tag in tags for e in self.open)

    def in_header(self) -> bool:
        return any(self.elements[e].tag == "header" for e in self.open)

    def is_outside(self, tag, attrs) -> bool:
        if tag in OUTSIDE or tag == "header" and not self.inside(ARTICLES):
            return True
        if not attrs or tag in ("html", "body", "main"):
            return False
        values = {k: (v or "").lower() for k, v in attrs}
        if "hidden" in values or values.get("aria-hidden") == "true" or _hidden.search(values.get("style", "")):
            return True
        return values.get("role") in ROLES

    def names(self, tag, attrs) -> tuple[tuple[str, int], ...]:
        """Names that speak against an element: 2 for the text of others, 1 for what surrounds an article."""
        if not attrs or tag not in BLOCKS or tag in ("html", "body", "main"):
            return ()
        values = {k: (v or "").lower() for k, v in attrs}
        found, words = [], set()
        for name in (values.get("class", "") + " " + values.get("id", "")).split():
            parts = set(_name.findall(name))
            words |= parts
            telling = parts - BESIDE
            key = "-".join(sorted(telling))  # comment-1 and comment-2 are one name
            if telling & (COMMENTS | TEASERS) and telling <= COMMENTS | TEASERS | AROUND:
                found.append((key, 2))
            elif telling and telling <= AROUND and tag not in ARTICLES and tag not in HEADINGS:
                found.append((key, 1))
        if words & OWN_HEADERS or self.inside(ARTICLES):
            found = [x for x in found if "header" not in x[0]]
        return tuple(found)


def named(lines: list[Line], elements: list[Element]) -> list[int]:
    """For each element how strongly names speak against it: its own and those around it.

    A name does not count if what carries it holds most of the text of the page's articles, but for
    those of comments and teasers, or most of the page's text where there is no such article. An
    article outlasts weak names around it.
    """
    strong = {name for e in elements for name, by in e.names if by == 2}
    carried: list[set[str]] = [set()]
    article = [False]
    for e in elements[1:]:
        carried.append(carried[e.parent].union(name for name, _ in e.names) if e.names else carried[e.parent])
        article.append((e.tag in ARTICLES or article[e.parent]) and not carried[-1] & strong)
    texts = [x for x in lines if not x.outside]
    texts = [x for x in texts if article[x.element]] or texts
    most, held = sum(len(x.text) for x in texts) / 2, {}
    for line in texts:
        for name in carried[line.element]:
            held[name] = held.get(name, 0) + len(line.text)
    ignored = {name for name, n in held.items() if n > most}
    out = [0]
    for e in elements[1:]:
        above = out[e.parent]
        out.append(max([by for name, by in e.names if name not in ignored] + [0 if above == 1 and e.tag in ARTICLES else above]))
    return out


def smooth(values: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; ends are mirrored by renormalising the kernel."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(values)), kernel, "full")[radius:-radius]
    return np.convolve(values, kernel, "full")[radius:-radius] / weights


def threshold(values: np.ndarray) -> float:
    """The bound between two clusters of numbers: the middle of their means, found from the extremes."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        upper = values > cut
        if not upper.any() or upper.all():
            return cut
        moved = float(values[~upper].mean()), float(values[upper].mean())
        if moved == (low, high):
            return cut
        low, high = moved
    return (low + high) / 2


def content_lines(lines: list[Line], against: np.ndarray) -> np.ndarray:
    """Which lines lie in a dense region: smoothed text-to-tag ratio in the upper of two clusters.

    Names weigh the ratio; a line that they speak against must be as dense as the denser of the other lines are
    on average, whatever menus and other linked or empty lines the page has.
    """
    ratios = np.array([0.0 if x.outside else max(0, len(x.text) - x.linked) / x.tags for x in lines])
    values = np.log1p(np.where(against, NAMED, 1) * ratios)
    smoothed = smooth(values).round(9)  # equal lines stay equal
    inside = np.array([not x.outside for x in lines])
    cut = threshold(smoothed)
    own = values[inside & ~against & (ratios > 0)]
    own = own[own >= threshold(own)] if len(own) else values[inside]
    return inside & (smoothed >= cut) & (~against | (values >= own.mean()))


def is_menu(line: Line) -> bool:
    return line.linked * 2 > len(line.text)


def is_paragraph(line: Line, elements: list[Element]) -> bool:
    return not is_menu(line) and elements[line.element].tag in PARAGRAPHS


def main_lines(parser: Lines) -> list[Line]:
    """The lines of the dense regions, with title and lead, and of marked articles, and short paragraphs in the
    container of them all."""
    lines, elements = parser.lines, parser.elements
    if not any(not x.outside for x in lines):
        return []
    weak = named(lines, elements)
    against = np.array([weak[x.element] > 0 for x in lines])
    if all(a for x, a in zip(lines, against, strict=True) if not x.outside):
        weak, against = [0] * len(elements), np.zeros(len(lines), bool)
    dense = content_lines(lines, against)
    if not dense.any():
        dense = np.array([not x.outside for x in lines])
    article = [False] * len(elements)
    for at, e in enumerate(elements[1:], 1):
        article[at] = not e.outside and not weak[at] and (e.tag in ARTICLES or article[e.parent])
    # Title and lead: the headings and paragraphs that stand right before the first dense line.
    lead, before = np.zeros(len(lines), bool), int(np.argmax(dense)) - 1
    while before >= 0 and not lines[before].outside and not against[before] and is_paragraph(lines[before], elements):
        lead[before], before = True, before - 1
    # The lowest common ancestor; a parent's number is below that of its children.
    home = -1
    for n, (line, good) in enumerate(zip(lines, dense, strict=True)):
        if good or lead[n] or article[line.element] and not line.outside:
            at = line.element
            home = at if home < 0 else home
            while at != home:
                at, home = (elements[at].parent, home) if at > home else (at, elements[home].parent)
    while elements[home].tag and elements[home].tag not in BLOCKS or elements[home].tag in HEADINGS or elements[home].tag in ("p", "pre"):
        home = elements[home].parent
    held = np.flatnonzero(dense)
    first, last = int(held[0]), int(held[-1])

    def within(at: int) -> bool:
        while at > home:
            at = elements[at].parent
        return at == home

    kept = []
    for n, line in enumerate(lines):
        if line.outside or against[n] and not dense[n]:
            continue
        # Short paragraphs around the dense regions are the article's too; bare text there is not.
        around = is_paragraph(line, elements) or first <= n <= last and not is_menu(line)
        if dense[n] or lead[n] or article[line.element] or around and within(line.element):
            kept.append(line)
    return kept


def extract(page: str | None) -> str:
    """The main text of a page: its blocks in order, joined by line ends; empty if there is none."""
    parser = Lines()
    parser.feed(page or "")
    parser.close()
    return "\n".join(x.text for x in main_lines(parser))


def extract_pages(df: DataFrame, id_col: str = "page_id", text_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: the id, the columns in `keep`, text and n_chars (code points).

    Each whole page is parsed on its own, so hot or null ids change nothing. A null or empty page, or
    one without main text, has an empty text. An unclosed page is read to its end. Other columns are
    not looked at.
    """
    ship(df.sparkSession)
    rows = pick(df, id=id_col, page=text_col, **{f"k{i}": c for i, c in enumerate(keep)})
    others = [f"k{i}" for i in range(len(keep))]
    schema = ", ".join(f"{c} {kind(rows, c)}" for c in ["id", *others]) + ", text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page) for page in strings(batch.column("page"))]
            columns = [batch.column(c) for c in ["id", *others]]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", *others, "text", "n_chars"])

    out = rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    for temporary, name in zip(others, keep, strict=True):
        out = out.withColumnRenamed(temporary, name)
    return out
