"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's streaming parser turns a page into lines: the text between two block
tags, with its number of tags and its characters inside links.  Lines of menus, headers,
footers, sidebars, notices, adverts, forms and comments are known by element, role or class
and have ratio 0, as have lines that are mostly links.  The ratios of text to tags are
smoothed with a Gaussian and lines above ``DEVIATIONS`` standard deviations are the content
cluster.  A region (an article or main element, else the nearest section) that holds a line
of the cluster is content, and all its lines that are no boilerplate are kept, short ones too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import small_batches

# Fixed values of the HTML standard: elements by what they do to the text flow.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript iframe object svg math canvas audio video head title select textarea button datalist".split())
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title head html".split())     # end no head
BOILER_TAGS = frozenset("nav aside footer form menu dialog search".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
REGIONS = frozenset("article main".split())
SECTIONS = frozenset("body div section td blockquote".split())
# Words that start a part of the class or id of boilerplate, and such that are the whole part.
BOILER_STARTS = ("advert", "banner", "breadcrumb", "consent", "cookie", "copyright", "disqus", "footer", "gdpr", "menu", "navbar", "navigation", "newsletter",
                 "notice", "pagination", "popup", "promo", "sidebar", "sponsor", "subscri", "toolbar", "widget", "masthead", "signup", "login")
BOILER_WORDS = frozenset("ad ads adv nav share sharing social related recommended modal overlay topbar header aside alert search form skip".split())
COMMENTS = re.compile("comment(s|er|ers|list|form|box|section|area|block|body|text|thread)?|disqus.*|replies|respond")
# Inside an article or main a class names boilerplate only if each part of it is such a word, a word for a place or shape, or a number.
BOILER_IN_REGION = re.compile("adverts?|advertisements?|advertising|banners?|breadcrumbs?|consent|cookies?|copyright|footers?|gdpr|menus?|navbar|navigation|"
                              "newsletters?|notices?|pagination|popups?|promos?|promotions?|sidebars?|sponsor(s|ed)?|subscri(be|ption)|toolbars?|widgets?|masthead|signup|login")
PLACES = re.compile("[a-z]?[0-9]+|area|articles?|bar|block|body|bottom|box|btn|buttons?|card|col|container|content|fixed|form|global|grid|group|header|icons?|inline|inner|"
                    "items?|left|links?|list|main|page|panel|posts?|right|row|section|site|slot|sticky|stories|story|title|top|unit|wrap|wrapper")
DEVIATIONS = 0.6
KERNEL = np.exp(-0.5 * (np.arange(-2, 3) / 1.0) ** 2)
_PARTS = re.compile("[a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Lines(HTMLParser):
    """Collects (text, tags, link characters, boilerplate, region, section, doubt) of each line.

    Doubt: inside of a region, by a class that holds a word of boilerplate beside others (``notice-period``)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, int, int, bool]] = []
        self.open: list[tuple[str, bool, bool, bool, int, int, bool, bool]] = []   # tag, silent, boiler, comment, region, section, link, doubt
        self.number = Counter()                 # open elements by tag
        self.blocks: list[int] = []             # where in ``open`` the blocks are
        self.silent = self.boiler = self.comment = self.link = self.doubt = False
        self.region = self.section = 0          # 0: outside of any
        self.count = 0
        self.text: list[str] = []
        self.tags = self.linked = 0

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, self.tags, self.linked, self.boiler, self.region, self.section, self.doubt))
            self.tags = 0
        self.text, self.linked = [], 0

    def _kind(self, tag: str, attrs: list) -> tuple[bool, bool, bool]:
        """Whether the element is boilerplate, whether it holds comments, and whether there is doubt."""
        boiler, comment, doubt = tag in BOILER_TAGS or (tag == "header" and not self.region), False, False
        for name, value in attrs:
            if name in ("hidden", "inert") or name == "aria-hidden" and value == "true":
                boiler = True
            elif not value:
                continue
            elif name == "role":
                boiler |= value.strip().lower() in BOILER_ROLES
            elif name == "style":
                boiler |= "display:none" in value.replace(" ", "").lower()
            elif name in ("class", "id") and tag not in ("html", "body"):
                for word in value.lower().split():
                    parts = _PARTS.findall(word)
                    if any(map(COMMENTS.fullmatch, parts)):
                        boiler = comment = True
                    elif tag not in REGIONS and any(p in BOILER_WORDS or p.startswith(BOILER_STARTS) for p in parts):
                        sure = not self.region or all(p in BOILER_WORDS or BOILER_IN_REGION.fullmatch(p) or PLACES.fullmatch(p) for p in parts)
                        boiler, doubt = boiler or sure, doubt or not sure
        return boiler, comment, doubt

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag == "body":
            self._end_head()
        elif self.silent and self.open[-1][0] == "head" and tag not in HEAD_TAGS:
            self._end_head()
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag == "p" or tag == "li":           # an open one of the same list or flow ends here
            if self.blocks and self.open[self.blocks[-1]][0] == tag:
                self._close(self.blocks[-1])
        self.number[tag] += 1
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((tag, self.silent, self.boiler, self.comment, self.region, self.section, self.link, self.doubt))
        boiler, comment, doubt = self._kind(tag, attrs) if attrs or tag in BOILER_TAGS or tag == "header" else (False, False, False)
        self.silent |= tag in SILENT
        self.comment |= comment
        self.doubt |= doubt
        self.link |= tag == "a"
        if tag in REGIONS or tag in SECTIONS:
            self.count += 1
            self.section = self.count
            if tag in REGIONS:
                if not self.region:
                    self.region = self.count
                    self.boiler &= self.comment         # an article ends menus and adverts that were left open
        self.boiler |= boiler

    def _end_head(self) -> None:
        """The end tag of a head may be left out: the body, or what may not stand in a head, ends it."""
        for i, x in enumerate(self.open) if self.number["head"] else ():
            if x[0] == "head":
                self._close(i)
                break

    def _close(self, at: int) -> None:
        _, self.silent, self.boiler, self.comment, self.region, self.section, self.link, self.doubt = self.open[at]
        self.number.subtract(x[0] for x in self.open[at:])
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()
        del self.open[at:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1) if self.number[tag] else ():
            if self.open[i][0] == tag:
                self._close(i)
                break

    def handle_data(self, data: str) -> None:
        if self.silent and self.open[-1][0] == "head" and not data.isspace():
            self._end_head()
        if not self.silent:
            self.text.append(data)
            if self.link:
                self.linked += len(data)


def lines_of(html: str) -> list[tuple[str, int, int, bool, int, int, bool]]:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.lines


def ratios(lines: list[tuple]) -> np.ndarray:
    """Smoothed text-to-tag ratio of each line; a doubtful line counts half."""
    raw = np.array([0.0 if boiler or linked > 0.6 * len(text) else len(text) / max(tags, 1) / (1 + doubt)
                    for text, tags, linked, boiler, _, _, doubt in lines])
    weight = np.convolve(np.ones(len(raw)), KERNEL, "same") if len(raw) >= len(KERNEL) else None
    if weight is None:
        padded = np.convolve(np.r_[np.zeros(2), raw, np.zeros(2)], KERNEL, "valid")
        return padded / np.convolve(np.r_[np.zeros(2), np.ones(len(raw)), np.zeros(2)], KERNEL, "valid")
    return np.convolve(raw, KERNEL, "same") / weight


def main_text(html: str | None) -> str:
    """The main text of one page: its lines joined by two line feeds; empty if there is none."""
    lines = lines_of(html or "")
    if not lines:
        return ""
    smooth = ratios(lines)
    limit = DEVIATIONS * smooth.std()
    content = [s > 0 and s >= limit and not x[3] for s, x in zip(smooth, lines)]
    regions = {x[4] for x, c in zip(lines, content) if c and x[4]}
    if not regions:                             # a region whose lines are all short
        regions = {x[4] for x in lines if x[4] and not x[3]}
    if regions:
        kept = [x[0] for x, c in zip(lines, content) if x[4] in regions and not x[3] and (c or not x[6])]
    else:
        sections = {x[5] for x, c in zip(lines, content) if c}
        kept = [x[0] for x in lines if x[5] in sections and not x[3] and x[2] <= 0.6 * len(x[0])]
    return "\n\n".join(kept)


def extract(pages: DataFrame, *, html: str = "html", into: str = "text") -> DataFrame:
    """All rows with the page's main text in column ``into`` (never null).

    Null and empty pages give the empty text; so do pages of which nothing is content.  Any
    length goes through whole; repeated rows give equal texts.  An existing column ``into``
    is replaced, other columns stay.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([main_text(h) for h in b], dtype=object)

    return pages.withColumn(into, run(F.col(html)))
