"""Main text of HTML pages.

The standard library's streaming parser gives the events.  Text is gathered
into blocks (one line each); markup that is never content - menus, page
headers and footers, sidebars, forms, scripts, adverts, notices, reader
comments - is left out as the events go by.  Each line has a text-to-tag
ratio, damped by its share of link text; the ratios are smoothed by a
Gaussian along the page and split into two clusters by a threshold.  The
regions above it name the page's content containers: the articles or mains
they are in, or else the nearest block that holds all of them.  All lines of
these containers are the main text, so short lines between long ones stay.
Where the clusters are not clearly apart, every line is content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGMA = 1.0            # of the Gaussian, in lines
LINK_SHARE = 0.5       # a line with a larger share of link text is a menu
APART = 2.0            # clusters whose mean ratios differ by less than this factor are one

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr math mfrac mi mn mo mrow ms msqrt mstyle msub msup mtext".split())
DROPPED = frozenset("nav footer aside form script style noscript template iframe svg canvas object button select option "
                    "textarea input fieldset dialog menu head title audio video applet map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                  "toolbar".split())
# Words of class and id names of blocks that are not content.
NAMES = frozenset("ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion "
                  "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside rail widget widgets "
                  "footer foot masthead topbar cookie cookies consent gdpr notice notices notification alert popup modal overlay "
                  "newsletter subscribe subscription signup login share sharing social related recommended "
                  "comment comments commentlist disqus replies reply respond reader readers pagination pager toolbar skip "
                  "copyright disclaimer".split())
# Of these, names of blocks made of links and short labels.
LINKED = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs share sharing social pagination pager toolbar skip "
                   "widget widgets rail side aside".split())
DENSE = 120            # characters of a line without links that no block of links and labels holds
HOLDERS = ("article", "main")
CONTAINERS = frozenset("article main section div td body html center".split())
# Elements whose open element of the same group ends where a new one begins.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_BLOCK_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
                          "ol p pre section table ul".split())
_STOPS_AT = frozenset("ul ol dl table div article section main body td th blockquote".split())


# "no-sidebar", "content-with-sidebar", "side-by-side" and the like describe
# a page or its layout; "page-sidebar" only if the word comes first.
_ABOUT = frozenset("no has with without not is by".split())
# Last parts that say how a thing is shown, not what it is: "comment-list".
_SHOWN = frozenset("area areas box boxes container wrapper wrap holder block blocks bar bars item items link links button buttons "
                   "list lists panel group inner outer left right top bottom form posts articles icon icons text unit slot "
                   "primary secondary mobile desktop".split())
COMMENTS = frozenset("comment comments reply replies disqus".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Blocks after an article that can hold articles of their own.
LATER = COMMENTS | frozenset("commentlist respond readers related recommended".split())
# What a head can hold; elements whose text is never read; elements that stay
# dropped, closed or not; elements that need no end tag.
_IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
_RAW = frozenset("script style".split())
_NEVER = frozenset("script style textarea title select option".split())
_ENDS_ALONE = frozenset("p li dt dd tr td th option".split())


def _names(value: str | None) -> set[str]:
    """Class or id names that say what the element itself is: whole names,
    and their last part that is more than a way of showing it."""
    found: set[str] = set()
    for name in (value or "").lower().replace("_", "-").split():
        parts = [p for p in name.split("-") if p]
        if not parts or parts[0] == "page" or not _ABOUT.isdisjoint(parts):
            continue
        while len(parts) > 1 and (parts[-1] in _SHOWN or parts[-1].isdigit()):
            parts.pop()
        found.update((name, parts[-1]))
    return found


class _Drop:
    """An element that is left out as it is opened, and what else encloses it."""

    __slots__ = ("n", "tag", "names", "outer", "element", "main")

    def __init__(self, n: int, tag: str, names: set[str], outer: _Drop | None, element: _Open):
        self.n, self.tag, self.names, self.outer, self.element = n, tag, names, outer, element
        self.main = False                       # holds a main element

    def unclosed(self) -> bool:
        """No end tag of its own, or one that an enclosing element lacks in turn."""
        o: _Open | None = self.element if self.tag not in _ENDS_ALONE else None
        while o is not None and o.closed:
            o = o.same
        return o is not None


class _Open:
    """An open element: its container, outermost and innermost holder, the
    innermost dropped element around it, and the next one of its tag."""

    __slots__ = ("tag", "container", "holder", "inner", "drop", "same", "closed")

    def __init__(self, tag: str, container: int, holder: int, inner: int, drop: _Drop | None,
                 same: _Open | None = None):
        self.tag, self.container, self.holder, self.inner, self.drop = tag, container, holder, inner, drop
        self.same, self.closed = same, False


_ROOT = _Open("", 0, 0, 0, None)


class _Page(HTMLParser):
    """Collects lines: their parts (text, in a link or not, and the dropped
    element around it; None for a tag), container, holder, innermost holder.
    What is dropped in the end is known when the page has been read."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = []
        self.parents: dict[int, int] = {0: 0}          # of containers
        self.last: dict[str, _Open | None] = {}        # innermost open element of each tag
        self.lines: list[tuple[list, int, int, int]] = []
        self.parts: list[tuple[str | None, bool, _Drop | None]] = []
        self.links = 0
        self.n = 0
        self.drops: list[_Drop] = []

    def _at(self) -> _Open:
        return self.open[-1] if self.open else _ROOT

    def flush(self) -> None:
        if self.parts:
            at = self._at()
            self.lines.append((self.parts, at.container, at.holder, at.inner))
        self.parts = []

    def _pop_to(self, i: int) -> None:
        for o in reversed(self.open[i:]):
            self.links -= o.tag == "a"
            self.last[o.tag] = o.same
        del self.open[i:]

    def _end_head(self, tag: str) -> None:
        """Close a head that is left open, at the first thing it cannot hold."""
        if tag == "body":
            for i, o in enumerate(self.open):
                if o.tag == "head":
                    self._pop_to(i)
                    break
        elif self.open and self.open[-1].tag == "head" and tag not in _IN_HEAD:
            self.flush()
            self._pop_to(len(self.open) - 1)

    def _of_id(self, tag: str, attrs: list, unwanted: frozenset) -> frozenset:
        """Those of the names that an id can drop the element for: ids of
        headings, and of sections of an article, name their topic; a main
        can also hold what follows its article."""
        section = tag == "section" or any(k == "class" and "section" in (v or "").lower().split() for k, v in attrs)
        if tag in _HEADINGS or section and self.last.get("article"):
            return frozenset()
        return unwanted & LATER if section and self.last.get("main") else unwanted

    def _dropped(self, tag: str, attrs: list, holder: int) -> set[str] | None:
        """None: not dropped; else the names it is dropped for, if any."""
        if tag in DROPPED or (tag == "header" and not holder):
            return set()
        if tag in ("html", "body", "main"):
            return None
        unwanted = COMMENTS if tag == "article" and not holder else NAMES
        for k, v in attrs:
            if k == "role" and (v or "").lower() in ROLES or k == "hidden" or k == "aria-hidden" and v == "true":
                return set()
            if k in ("class", "id"):
                found = _names(v) & (unwanted if k == "class" else self._of_id(tag, attrs, unwanted))
                if found:
                    return found
            if k == "style" and "display:none" in (v or "").replace(" ", "").lower():
                return set()
        return None

    def handle_starttag(self, tag, attrs):
        self._end_head(tag)
        self.parts.append((None, False, self._at().drop))
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        ends = CLOSES.get(tag, set()) | ({"p"} if tag in _BLOCK_ENDS_P else set())
        if ends:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].tag in ends:
                    self._pop_to(i)
                    break
                if self.open[i].tag in _STOPS_AT:
                    break
        at = self._at()
        o = _Open(tag, at.container, at.holder, at.inner, at.drop, self.last.get(tag))
        names = self._dropped(tag, attrs, at.holder)
        if tag not in INLINE:
            self.n += 1
            if tag in CONTAINERS:
                o.container = self.n
                self.parents[self.n] = at.container
            if tag in HOLDERS:
                o.holder, o.inner = at.holder or self.n, self.n
        if tag == "main" and at.drop:
            at.drop.main = True
        if names is not None:
            o.drop = _Drop(self.n, tag, names, at.drop, o)
            self.drops.append(o.drop)
        self.links += tag == "a"
        self.last[tag] = o
        self.open.append(o)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.parts.append((None, False, self._at().drop))
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self.open[i].closed = True
                self._pop_to(i)
                return
            if tag in INLINE and self.open[i].tag not in INLINE:
                return

    def handle_data(self, data):
        if data.strip():
            self._end_head("")
        if self._at().tag not in _RAW:
            self.parts.append((data, self.links > 0, self._at().drop))


def _resolve(page: _Page) -> Callable[[_Drop | None, int], bool]:
    """Whether text is left out, by the innermost dropped element around it
    and its innermost holder.

    A form, a block left unclosed, or a block dropped by its name that holds
    the page's article (a main, or more text in articles than is left of the
    page, and no less than other dropped blocks hold) does not drop an article or main inside it (``lets``).  On a page without other articles it drops nothing at all
    if it holds more text than is left (``whole``).  Inside an article, a
    block with the name of a menu or the like that holds a line of ``DENSE``
    characters without links drops nothing either."""
    left = held = 0
    for parts, _, holder, _ in page.lines:
        size = sum(len(d.strip()) for d, _, drop in parts if d and drop is None)
        left += size
        held += size if holder else 0
    lets: set[_Drop] = set()
    wraps: set[_Drop] = set()               # those by name
    # text by innermost holder, from the innermost dropped elements outwards
    texts: dict[_Drop, dict[int, int]] = {d: {} for d in page.drops}
    for parts, _, _, inner in page.lines:
        for data, _, drop in parts:
            if data and drop and inner > drop.n:
                texts[drop][inner] = texts[drop].get(inner, 0) + len(data.strip())
    told = sum(sum(texts[d].values()) for d in page.drops if not d.names & LATER)
    for d in reversed(page.drops):
        if d.tag in _NEVER:
            continue
        late = bool(d.names & LATER)
        own = sum(texts[d].values())
        if d.tag == "form" or d.unclosed():
            if not (late and held):
                lets.add(d)
        elif d.names and d.tag not in HOLDERS and (d.main or own > left and 2 * own >= told and not (late and left)):
            lets.add(d)
            wraps.add(d)
        if d in lets and d.outer:
            d.outer.main |= d.main
            for inner, size in texts[d].items():
                if inner > d.outer.n:
                    texts[d.outer][inner] = texts[d.outer].get(inner, 0) + size
    # an element is passed if it and all around it let articles through
    passed: set[_Drop | None] = {None}
    for d in page.drops:
        if d in lets and d.outer in passed:
            passed.add(d)
    within: dict[_Drop, dict[int, int]] = {d: {} for d in passed if d}
    for parts, _, _, inner in page.lines:
        for data, _, drop in parts:
            if data and drop in within:
                size = len(data.strip())
                within[drop][inner] = within[drop].get(inner, 0) + size
                if inner > drop.n:
                    left += size
                    held += size
    whole: set[_Drop] = set()
    if not held:
        for d in reversed(page.drops):
            if d in within:
                if d not in wraps and sum(within[d].values()) > left and not (d.names & LATER and left):
                    whole.add(d)
                for inner, size in within[d].items() if d.outer else ():
                    within[d.outer][inner] = within[d.outer].get(inner, 0) + size
    # inside an article a name alone does not make a paragraph a menu
    for parts, _, holder, _ in page.lines:
        drop = next((d for _, _, d in parts if d), None)
        if holder and drop and drop.names and drop.names <= LINKED and drop.n > holder and drop not in whole:
            free = sum(len(data.strip()) for data, linked, _ in parts if data and not linked)
            if free >= DENSE and free >= sum(len(data.strip()) for data, _, _ in parts if data) * LINK_SHARE:
                whole.add(drop)
    # the nearest element, from each outwards, that is not whole
    nearest: dict[_Drop | None, _Drop | None] = {None: None}
    for d in page.drops:
        nearest[d] = nearest[d.outer] if d in whole else d

    def out(drop: _Drop | None, inner: int) -> bool:
        drop = nearest[drop]
        return drop is not None and (inner <= drop.n or drop not in passed)
    return out


def _lines(page: _Page) -> list[tuple[str, int, int, int, int]]:
    """Lines that are left: text, tags met before and in it (those of dropped
    elements aside), link characters, container, holder."""
    out = _resolve(page)
    lines, tags = [], 0
    for parts, container, holder, inner in page.lines:
        kept, link = [], 0
        for data, linked, drop in parts:
            if out(drop, inner):
                continue
            if data is None:
                tags += 1
            else:
                kept.append(data)
                link += len(data.strip()) if linked else 0
        text = " ".join("".join(kept).split())
        if text:
            lines.append((text, tags, link, container, holder))
            tags = 0
    return lines


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the ends see only what is there."""
    reach = int(3 * sigma) + 1
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(values, kernel)[reach:-reach] / np.convolve(np.ones(len(values)), kernel)[reach:-reach]


def threshold(values: np.ndarray) -> float:
    """Border of two clusters (two means, from the extremes on) of logarithms;
    -1 where they are not clearly apart."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        below, above = values[values <= cut], values[values > cut]
        if not len(above) or not len(below):
            return cut if len(above) else -1.0
        new = float(below.mean()), float(above.mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high - low >= np.log(APART) else -1.0


def _common(parents: dict[int, int], containers: set[int]) -> int:
    """The innermost container around all of ``containers``; a container has
    a higher number than those around it."""
    left = set(containers)
    while len(left) > 1:
        last = max(left)
        left.remove(last)
        left.add(parents[last])
    return left.pop()


def main_text(html: str | None) -> str:
    """Main text of one page; "" for null, empty or text-free pages."""
    if not html:
        return ""
    page = _Page()
    page.feed(html)
    page.close()
    page.flush()
    lines = _lines(page)
    if not lines:
        return ""
    size = np.array([len(t) for t, *_ in lines], dtype=float)
    link = np.array([x[2] for x in lines]) / size
    ratio = size / (1.0 + np.array([x[1] for x in lines])) * (1.0 - np.minimum(link, 1.0))
    menu = link > LINK_SHARE
    # long lines would drown the others: the clusters are those of the logarithm
    score = smooth(np.log1p(ratio))
    content = (score > threshold(score)) & ~menu
    holders = [x[4] for x in lines]
    if any(holders):
        # the page marks its articles: content regions are looked for inside them
        inside = np.array([h != 0 for h in holders])
        if (content & inside).any():
            content &= inside
        else:
            content = inside & ~menu
    if not content.any():
        content = ~menu
    homes = {x[4] for x, c in zip(lines, content) if c}
    if any(holders):
        # in a marked article every line is its text
        return " ".join(x[0] for x in lines if x[4] in homes and x[4])
    # elsewhere link lists are menus
    home = _common(page.parents, {x[3] for x, c in zip(lines, content) if c})
    inside: dict[int, bool] = {home: True, 0: home == 0}
    for c in sorted(page.parents):
        inside.setdefault(c, inside.get(page.parents[c], False))
    return " ".join(x[0] for x, m in zip(lines, menu) if inside[x[3]] and not m)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.

    Null and empty html: empty text, 0.  Repeated rows: one result each.
    Empty table: no rows.  Broken markup is read as far as it goes; nothing
    is cut off by length.  Other columns are not read."""
    src = pages.select("page_id", "url", html)
    out = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return src.mapInArrow(run, f"{out}, text string, n_chars long")
