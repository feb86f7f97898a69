"""Main text of web pages from the standard library's streaming parser.

Parser events are cut into lines, a line being the text between two block boundaries. Each line has a ratio of text to tags
(Weninger, Hsu and Han, "CETR", 2010); the ratios are smoothed with a Gaussian and split in two clusters, and the lines of the
upper one, outside what their elements say is no content (menus, headers, footers, sidebars, notices, adverts, forms, comments),
weigh the elements of the page. From the root the extraction goes down while one child holds most of that weight; where it
passes an article, or else a main element, that is the region. All lines of the region that no such element holds are the text.

Defined results: a null, empty or text-free html gives an empty text; broken markup never fails: an unfinished tag or comment at
the end is dropped, unclosed elements end with their parent; white space is what ``str.split`` takes for it; repeated rows are
extracted each by itself; an empty table gives an empty result. Pages are independent: nothing is shuffled.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input".split())
#: Their text is never shown, or no text of a page.
HIDDEN = frozenset("script style noscript template svg math iframe object canvas audio video title select option button textarea datalist".split())
#: In them a tag may close itself.
FOREIGN = frozenset("svg math".split())
NO_CONTENT = frozenset("nav header footer aside form menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words of class or id that name what is no content.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promotion banner banners nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar sidebar aside footer "
    "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login social share sharing sharebar related recommended recommendations comment comments disqus "
    "respond replies commentlist widget widgets toolbar pagination pager copyright search searchform form alert skip".split()
)
_TALK = frozenset("comment comments disqus commentlist replies".split())
_WHOLE = frozenset("html body article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTAINERS = frozenset("html body div section main article table tbody tr td center".split())
#: Start tags that end an open element of the second set, up to the third.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
}
SIGMA, MAJORITY = 1.0, 0.6
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _named(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """(by role or hiding, by class or id) that an element is no content."""
    hard = soft = False
    for k, v in attrs:
        if k == "role":
            hard |= (v or "").lower() in ROLES
        elif k == "hidden" or (k == "aria-hidden" and v == "true"):
            hard = True
        elif k in ("class", "id") and v:
            for name in v.split():
                w = [x.lower() for x in _WORDS.findall(name)]
                if w and w[0] in ("has", "no", "with", "without", "is"):
                    continue
                soft |= any(x in (_TALK if tag in _WHOLE else NAMES) for x in w)
    return hard, soft


class Lines(HTMLParser):
    """Elements and lines of a page. Where the open elements of each tag lie in the stack is kept, so a tag costs no walk through it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.hard, self.soft, self.holds = [-1], [""], [False], [False], [False]
        self.stack = [0]
        self.open: dict[str, list[int]] = defaultdict(list)  # places in the stack by tag
        self.solid, self.walls = [0], [0]  # places of what is not inline; of those but paragraphs
        self.mute = self.foreign = 0
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, characters in links, element
        self.part: list[str] = []
        self.tags = self.linked = self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.part).split())
        if text:
            self.lines.append((text, self.tags, self.linked, self.stack[-1] if self.tag[self.stack[-1]] not in INLINE else self._block()))
        self.part, self.tags, self.linked = [], 0, 0

    def _block(self) -> int:
        return self.stack[self.solid[-1]]

    def _push(self, e: int, tag: str) -> None:
        k = len(self.stack)
        self.stack.append(e)
        self.open[tag].append(k)
        if tag not in INLINE:
            self.solid.append(k)
            if tag != "p":
                self.walls.append(k)
        self.mute += tag in HIDDEN
        self.foreign += tag in FOREIGN
        self.links += tag == "a"

    def _cut(self, at: int) -> None:
        """Closes the stack down to a length."""
        for e in self.stack[at:]:
            tag = self.tag[e]
            self.open[tag].pop()
            self.mute -= tag in HIDDEN
            self.foreign -= tag in FOREIGN
            self.links -= tag == "a"
        del self.stack[at:]
        for places in (self.solid, self.walls):
            while places[-1] >= at:
                places.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in ("br", "hr"):
            self.part.append(" ")
        if tag not in INLINE and tag not in VOID and tag not in HIDDEN:
            self.flush()
            self.tags = 1
            self._implied(tag)
        if tag in VOID:
            return
        hard, soft = _named(tag, attrs)
        e = len(self.tag)
        self.parent.append(self.stack[-1])
        self.tag.append(tag)
        self.hard.append(hard or tag in NO_CONTENT)
        self.soft.append(soft)
        self.holds.append(False)
        if tag in ("article", "main"):
            for x in reversed(self.stack):
                if self.holds[x]:  # and so do all around it
                    break
                self.holds[x] = True
        self._push(e, tag)

    def _implied(self, tag: str) -> None:
        close, stop = _ENDS.get(tag, ((), ()))
        last = lambda tags: max((p[-1] for t in tags if (p := self.open.get(t))), default=0)
        end = last(stop - close) if close else self.walls[-1]
        at = last(close)
        if at > end:
            self._cut(at)
            return
        p = self.open["p"]
        if (k := bisect_right(p, end)) < len(p):
            self._cut(p[k])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        foreign = self.foreign > 0
        self.handle_starttag(tag, attrs)
        if foreign and tag not in VOID and self.tag[self.stack[-1]] == tag:
            self._cut(len(self.stack) - 1)
        elif tag in HIDDEN:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        inline = tag in INLINE or tag in HIDDEN
        if not inline:
            self.flush()
        places = self.open.get(tag)
        if places and (not inline or places[-1] >= self.solid[-1] or (tag in HIDDEN and self.mute)):
            self._cut(places[-1])

    def handle_data(self, data: str) -> None:
        if not self.mute:
            self.part.append(data)
            if self.links:
                self.linked += len(data)

    def read(self, page: str) -> None:
        self.feed(page)
        left = self.rawdata
        if left and not self.mute and not re.match(r"<[a-zA-Z/!?]", left):  # no unfinished tag
            self.handle_data(entities.unescape(left))
        self.flush()


def smooth(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, round(2 * sigma))
    k = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma * sigma))
    weight = np.convolve(np.ones(len(x)), k)[reach : reach + len(x)]
    return np.convolve(x, k)[reach : reach + len(x)] / weight


def upper_cluster(x: np.ndarray) -> np.ndarray:
    """Which values are in the upper of two clusters; all where they don't differ."""
    low, high = x.min(), x.max()
    if high - low <= 1e-9 * max(1.0, abs(high)):  # rounding tells them apart at most
        return np.ones(len(x), dtype=bool)
    before = None
    while True:
        up = x > (low + high) / 2
        if before is not None and np.array_equal(up, before):
            return up
        low, high, before = x[~up].mean(), x[up].mean(), up


def main_text(page: str | None) -> str:
    p = Lines()
    p.read(page or "")
    if not p.lines:
        return ""
    n = len(p.tag)
    off, heading = [False] * n, [False] * n  # heading: within the header of an article, where headings count
    inside = [False] * n
    for e in range(1, n):
        up, tag = p.parent[e], p.tag[e]
        inside[e] = inside[up] or tag in ("article", "main")
        own = p.hard[e] or (p.soft[e] and not p.holds[e])
        heading[e] = heading[up] or (tag == "header" and inside[up] and not off[up])
        off[e] = (off[up] or own) and not (heading[up] and tag in _HEADINGS)
    ratio = np.array([len(t) / max(1, tags) for t, tags, _, _ in p.lines])
    content = upper_cluster(smooth(ratio))
    open_ = np.array([not off[e] for _, _, _, e in p.lines])
    plain = np.array([2 * linked < len(t) for t, _, linked, _ in p.lines])
    length = np.array([len(t) for t, _, _, _ in p.lines])
    weight = length * (open_ & content & plain)
    if not weight.any():
        weight = length * (open_ & plain)
    if not weight.any():
        weight = length * open_
    mass = [0] * n
    for (_, _, _, e), w in zip(p.lines, weight.tolist(), strict=True):
        mass[e] += w
    for e in range(n - 1, 0, -1):
        mass[p.parent[e]] += mass[e]
    if not mass[0]:
        return ""
    children: list[list[int]] = [[] for _ in range(n)]
    for e in range(1, n):
        children[p.parent[e]].append(e)
    path = [0]
    while kids := [c for c in children[path[-1]] if mass[c] >= MAJORITY * mass[path[-1]] and (p.tag[c] in _CONTAINERS or p.holds[c] or p.tag[c] in INLINE)]:
        path.append(kids[0])
    while p.tag[path[-1]] in INLINE:
        path.pop()
    region = next((e for t in ("article", "main") for e in path if p.tag[e] == t), path[-1])
    within = [False] * n
    within[region] = True
    for e in range(region + 1, n):
        within[e] = within[e] or within[p.parent[e]]
    return " ".join(t for t, _, _, e in p.lines if within[e] and not off[e])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, its code points."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches):
            text = [main_text(x) for x in b["h"]]
            yield pd.DataFrame({"i": b["i"].array, "u": b["u"].array, "text": text, "n_chars": [len(t) for t in text]})

    src = pages.select(F.col(id_col).alias("i"), F.col(url_col).alias("u"), F.col(html_col).alias("h"))
    kind, url_kind = (src.schema[c].dataType.simpleString() for c in ("i", "u"))
    return src.mapInPandas(run, f"i {kind}, u {url_kind}, text string, n_chars long").withColumnsRenamed({"i": id_col, "u": url_col})
