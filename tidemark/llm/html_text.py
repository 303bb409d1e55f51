"""Operator 7: main text of web pages, from streaming parser events and text-to-tag ratios.

Method. The standard library's parser streams a page's events; each block of text becomes a line, with its number of tags.
Elements that never hold main text (menus, footers, sidebars, scripts, styles; headers outside articles; hidden ones and some
roles) are left out with all they hold. So are elements whose class or id is one of NAMES (adverts, reader comments, notices) or, but for
paragraphs and headings, consists of words of TELLING and of layout (PLAIN); not outermost article and main elements nor, on a page without
these, elements with most of the page's text. A name with a word of TELLING and others (``tasting-menu``) says nothing by itself: such an
element goes if most of its text is links or in lines under the threshold. A form goes unless it holds an article or main element or most of the text of
its region. Over the rest, the ratio of text to tags by line is smoothed with a Gaussian and a threshold clusters the lines into content and other.

The regions are all outermost article and main elements with content, or else the deepest element that holds nearly all of it.
Within them, lines of a cluster and those beside one, however short, are returned, but for mostly linked lines under the
threshold: LINKS of them in a row, by their own ratios, are a list of links and left out. From outside them come lines
that reach the threshold by themselves (without article and main), and headings at most NEAR lines before a returned line with
what lies between. All are joined in page order.

Cases. A null or empty page has an empty text. Malformed and cut-off pages are parsed as far as they go, unknown declarations count as
comments, and elements may be nested to any depth. Repeated rows each keep their row. Kept columns named like the result's (text, n_chars)
are left out. One task handles a page at a time, in time near its length; pages are neither shuffled nor cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.shared import without

#: Fixed values of the markup language, and of names that pages use for what isn't main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset("aside button canvas dialog footer head iframe input label menu nav noscript object option script select style svg template textarea title".split())
CONTAINERS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus"
    " footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices outbrain paywall popup promo promoted promotion"
    " related responses search share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar widget".split()
)
TELLING = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr masthead menu"
    " nav navbar navigation newsletter outbrain paywall popup promo promoted promotion sidebar sponsor sponsored subscribe subscription taboola toolbar widget".split()
)
#: Words of layout, which leave a name's meaning to its other words, and words that say it whatever else the name has.
PLAIN = frozenset(
    "area article articles bar block blog body bottom box btn button buttons card cards col column container content desktop details feed fixed form frame global grid group header heading"
    " icon icons info inner item items label large layout left level line link links list main message mobile module notice outer overlay page panel part plugin policy post posts primary reader"
    " readers right row secondary section share signup site slot small social stories sub sticky story text thread tile title top unit user users view wide wrap wrapper zone".split()
)
DECIDING = frozenset("comment comments disqus outbrain taboola".split())
ROLES = frozenset("banner navigation complementary contentinfo search alert dialog menu form".split())

SIGMA, SHARE, COVER, NEAR, LINKS = 1.5, 0.5, 0.85, 3, 3


class _Element:
    """An open or closed element; what holds for all within it is inherited when it opens."""

    __slots__ = ("tag", "left_out", "parent", "place", "depth", "outer", "in_header", "named", "linked", "heading", "block", "form", "holds")

    def __init__(self, tag: str, parent: _Element | None, place: int, left_out: bool = False, named: str = ""):
        self.tag, self.parent, self.place, self.left_out, self.named = tag, parent, place, left_out, named
        self.depth = parent.depth + 1 if parent else 0
        self.outer = parent.outer if parent and parent.outer else self if tag in CONTAINERS else None  # the outermost article or main
        self.block = self if tag in BLOCKS or not parent else parent.block  # the innermost block
        self.form = self if tag == "form" else parent.form if parent else None
        self.holds = False  # a form that an article or main element is in
        self.in_header = tag == "header" or bool(parent and parent.in_header)
        self.linked = tag == "a" or bool(parent and parent.linked)
        self.heading = tag in HEADINGS or bool(parent and parent.heading)


class Lines(HTMLParser):
    """Lines of a page: (text, tags, element, linked characters). ``elements`` are in the order in which they open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.top = _Element("", None, 0)
        self.elements = [self.root]
        self.open: dict[str, int] = {}
        self.lines: list[tuple[str, int, _Element, int]] = []
        self.held: list[str] = []
        self.tags, self.within, self.n_linked = 1, self.root, 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i, report)

    def end_line(self) -> None:
        text = " ".join("".join(self.held).split())
        if text:
            self.lines.append((text, self.tags, self.within, self.n_linked))
            self.tags = 1
        self.held, self.n_linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if not self.top.left_out:
            self.tags += 1
        if tag in BLOCKS:
            self.end_line()
            self._close_open(tag)
        elif tag == "br":
            self.held.append(" ")
        if tag in VOID:
            return
        top = self.top
        in_article = top.outer is not None
        of_header = top.in_header and tag in BLOCKS and tag not in HEADINGS and tag not in ("div", "hgroup", "section")
        left_out = top.left_out or tag in NEVER or tag == "header" and not in_article or of_header or self._hidden(tag, attrs)
        named = "" if tag in CONTAINERS and not in_article else "form" if tag == "form" else self._named(tag, attrs)
        if tag in CONTAINERS:
            form = top.form
            while form is not None and not form.holds:
                form.holds, form = True, form.parent.form
        self.top = _Element(tag, top, len(self.elements), left_out, named)
        self.elements.append(self.top)
        self.open[tag] = self.open.get(tag, 0) + 1

    @staticmethod
    def _hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        own = lambda role: role == "form" and tag == "form"
        return any(name == "hidden" and not value or value and (name == "role" and value.lower() in ROLES and not own(value.lower()) or name == "aria-hidden" and value.lower() == "true") for name, value in attrs)

    @staticmethod
    def _named(tag: str, attrs: list[tuple[str, str | None]]) -> str:
        """Whether a class or id says that the element isn't main text: "sure", "maybe" or ""."""
        if tag in ("html", "body"):
            return ""
        names = [x for name, value in attrs if value and name in ("class", "id") for x in value.lower().split()]
        if any(x in NAMES for x in names):
            return "sure"
        if tag == "p" or tag in HEADINGS:
            return ""
        said = ""
        for name in names:
            words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
            if not TELLING.isdisjoint(words):
                if not DECIDING.isdisjoint(words) or all(w in TELLING or w in NAMES or w in PLAIN or any(c.isdigit() for c in w) for w in words):
                    return "sure"
                said = "maybe"
        return said

    def _pop(self, upto: _Element) -> None:
        """Closes all that is open within ``upto``."""
        while self.top is not upto:
            self.open[self.top.tag] -= 1
            self.top = self.top.parent

    def _close_open(self, tag: str) -> None:
        """A block ends an open paragraph; an item or cell ends the one before it."""
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
        block = self.top.block
        if block is not self.root and (block.tag == "p" or block.tag in ends):
            self._pop(block.parent)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if not self.top.left_out:
            self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        if self.open.get(tag):
            at = self.top
            while at.tag != tag:
                at = at.parent
            self._pop(at.parent)

    def handle_data(self, data: str) -> None:
        top = self.top
        if top.left_out:
            return
        if not self.held:
            self.within = top
        self.held.append(data)
        if top.linked:
            self.n_linked += len(data.strip())


def content(ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which lines are content: those whose smoothed ratio, and those whose own, is a share of the mean or above."""
    reach = int(3 * SIGMA)
    kernel = np.exp(-np.square(np.arange(-reach, reach + 1)) / (2 * SIGMA * SIGMA))
    smooth = np.convolve(ratios, kernel / kernel.sum(), "full")[reach : reach + len(ratios)]
    own = ratios >= SHARE * smooth.mean()
    return own | (smooth >= SHARE * smooth.mean()), own


def _masses(page: Lines, lines: list, which: list[bool]) -> list[int]:
    """Characters within each element, over the lines that count."""
    mass = [0] * len(page.elements)
    for (text, _, element, _), ok in zip(lines, which):
        if ok:
            mass[element.place] += len(text)
    for e in page.elements[:0:-1]:  # parents open before what they hold
        mass[e.parent.place] += mass[e.place]
    return mass


def _within(page: Lines, which: list[bool]) -> list[bool]:
    """Of each element, whether it or one around it is among ``which``."""
    out = which[:1]
    for e in page.elements[1:]:
        out.append(which[e.place] or out[e.parent.place])
    return out


def _without_named(page: Lines) -> list:
    """Lines but those in elements left out by name, and in forms."""
    lines = page.lines
    doubtful = {e.named for e in page.elements} - {""}
    if not lines or not doubtful:
        return lines
    mass = _masses(page, lines, [True] * len(lines))
    told = mass
    if "maybe" in doubtful:
        _, own = content(np.array([len(x[0]) for x in lines]) / np.array([x[1] for x in lines]))
        told = _masses(page, lines, [bool(o) and 2 * x[3] < len(x[0]) for o, x in zip(own, lines)])
    articles = any(x[2].outer for x in lines)
    named = []
    for e in page.elements:
        if e.named == "form":
            region = mass[e.outer.place] if e.outer else mass[0]
            named.append(not e.holds and 2 * mass[e.place] <= region)
        elif e.named == "maybe":
            named.append(2 * told[e.place] < mass[e.place])
        else:
            named.append(e.named == "sure" and (articles or 2 * mass[e.place] <= mass[0]))
    out = _within(page, named)
    return [x for x in lines if not out[x[2].place]]


def parsed(html: str) -> Lines:
    """The lines of a page, as far as its markup can be read."""
    page = Lines()
    try:
        page.feed(html)
        page.close()
    except AssertionError:  # the parser's own, at markup that it doesn't know
        pass
    page.end_line()
    return page


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = parsed(html)
    lines = _without_named(page)
    if not lines:
        return ""
    sizes = np.array([len(x[0]) for x in lines])
    good, own = (x.tolist() for x in content(sizes / np.array([x[1] for x in lines])))
    mass = _masses(page, lines, good)
    outer = [x[2].outer for x in lines]
    if any(o and mass[o.place] for o in outer):
        inside = [bool(o and mass[o.place]) for o in outer]
        lone = False
    else:
        holds = [e for e in page.elements if mass[e.place] and mass[e.place] >= COVER * mass[0] and (e.tag in BLOCKS and e.tag != "p" and e.tag not in HEADINGS or e is page.root)]
        region = max(holds, key=lambda e: e.depth)
        within = _within(page, [e is region for e in page.elements])
        inside = [within[x[2].place] for x in lines]
        lone = True
    heading = [x[2].heading for x in lines]
    links = [2 * x[3] >= len(x[0]) and not o and not h for x, o, h in zip(lines, own, heading)]
    keep = [i or lone and o and 2 * x[3] < len(x[0]) for i, o, x in zip(inside, own, lines)]
    start = 0
    for k in range(1, len(lines) + 1):  # lists of links
        if k == len(lines) or links[k] != links[start]:
            if links[start] and k - start >= LINKS:
                keep[start:k] = [False] * (k - start)
            start = k
    for k in [k for k in range(len(lines)) if heading[k] and not keep[k]][::-1]:
        upto = next((j for j in range(k + 1, min(k + 1 + NEAR, len(lines))) if keep[j]), k)
        keep[k:upto] = [not x for x in links[k:upto]]
    return "\n\n".join(x[0] for x, ok in zip(lines, keep) if ok)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        kept = [batch.column(c) for c in batch.schema.names if c != "html"]
        names = [c for c in batch.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])


def extract_main_text(pages: DataFrame, keep: list[str]) -> DataFrame:
    """pages(html, ...) to its columns ``keep``, ``text`` and ``n_chars``."""
    keep = without(keep, "text", "n_chars", "html")
    types = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep)
    return pages.select(*keep, "html").mapInArrow(_extract, f"{types}text string, n_chars long")
