"""Main text of web pages.

Method: the standard library's streaming parser turns a page into events; events fill *lines*, one for each block of
text, with the number of its characters, tags and link characters. The text-to-tag ratio of every line is smoothed with
a Gaussian over its neighbours; lines at or above one standard deviation of the smoothed ratios form the content
cluster. Content lines vote for the container around them, and the winning region is written whole, so that a short
paragraph or a heading inside an article stays although its own ratio is small.

What the page itself marks as something else (navigation, page headers and footers, asides, notices, adverts, forms,
comments, hidden parts) never joins a region; scripts, styles and the like are no text at all.

A page is handled in memory by one task, with state in proportion to the page; nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CONTAINER = frozenset(("article", "main", "section", "div", "body", "td", "center", "blockquote"))
#: Elements that a new one of the same group ends.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: Elements that bound the search for such an open sibling.
SCOPES = frozenset("ul ol dl table menu div section article main body".split())
NO_TEXT = frozenset("""script style noscript template iframe object embed canvas audio video svg select option optgroup datalist textarea button head title
noframes applet map""".split())
BOILERPLATE = frozenset(("nav", "footer", "aside", "dialog", "menu", "search", "fieldset", "label"))
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "form", "status"))
#: Words of a class or id that mark boilerplate, alone or as a part between hyphens and underscores.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising adsbygoogle adbox sponsor sponsored sponsors promo promos promotion banner cookie cookies consent gdpr alert alerts notice
notices disclaimer popup modal overlay newsletter subscribe subscription signup login sidebar sidebars sidenav aside widget widgets rail nav navbar topnav navigation menu menus submenu breadcrumb breadcrumbs
pagination pager footer comment comments commentlist disqus respond replies share sharing social related recommended recommendations trending toolbar skip masthead topbar""".split())
#: Marks only as a whole name, outside of an article.
PAGE_HEADERS = frozenset(("header", "site-header", "page-header", "top-header", "global-header", "siteheader", "pageheader"))
#: A name with one of these parts speaks of the layout around it, as does one that names content and its wrapping.
LAYOUT = frozenset(("with", "has", "no", "without", "layout", "enabled", "disabled"))
CONTENT, WRAPPING = frozenset(("content", "main", "body", "article", "page")), frozenset(("wrap", "wrapper", "container", "outer", "inner"))
TEXT_NAMES = frozenset("""article article-body article-content article-text articlebody post post-content post-body entry entry-content story story-body hentry content main
main-content page-content body-content text-content""".split())

SIGMA = 1.0
#: Share of the best article that another one of the page must reach to be written too, and share of a page's text that marked articles must hold.
ALSO, ENOUGH = 0.5, 0.3

PLAIN, IN_FORM, MARKED = 0, 1, 2


class _Line:
    __slots__ = ("chars", "heading", "level", "links", "place", "tags", "text")

    def __init__(self, text, tags, links, level, place, heading):
        self.text, self.tags, self.links, self.level, self.place, self.heading = text, tags, links, level, place, heading
        self.chars = len(text)


def _names(attrs: dict) -> list[str]:
    return f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()


def _marked(names: list[str]) -> bool:
    for name in names:
        parts = re.split(r"[-_]+", name)
        if name in MARKS or (MARKS.intersection(parts) and not LAYOUT.intersection(parts) and not (CONTENT.intersection(parts) and WRAPPING.intersection(parts))):
            return True
    return False


class PageLines(HTMLParser):
    """Lines of a page, and the containers (parent, kind) that they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.parents, self.kinds = [-1], [""]
        self.stack: list[tuple] = []      # (tag, place, level, without text, in an article, heading) before the element
        self.open: Counter = Counter()
        self.place, self.level, self.mute, self.article, self.heading = 0, PLAIN, False, False, False
        self.links_open = self.tags = self.link_chars = 0
        self.parts: list[str] = []

    def page(self, html: str) -> list[_Line]:
        self.feed_all(html)
        self.flush()
        return self.lines

    def feed_all(self, html: str) -> None:
        cut = html.rfind("<")
        if cut >= 0 and (html[cut + 1 : cut + 2].isalpha() or html[cut + 1 : cut + 2] == "/") and ">" not in html[cut:]:
            html = html[:cut]             # a tag that never ends is no text
        try:
            self.feed(html)
            self.close()
        except AssertionError:            # a declaration that the parser does not know: its first mark is text
            rest = self.rawdata
            self.rawdata = ""
            self.handle_data(rest[:2])
            if len(rest) > 2:
                self.feed_all(rest[2:])

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(_Line(text, self.tags, self.link_chars, self.level, self.place, self.heading))
            self.tags = 0
        self.parts, self.link_chars = [], 0

    def handle_data(self, data: str) -> None:
        if not self.mute:
            self.parts.append(data)
            if self.links_open:
                self.link_chars += len(data.strip())

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)      # a slash ends no element in HTML

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            if self.open["p"]:
                self.pop_to("p")
            for sibling in SIBLINGS.get(tag, ()):
                if self.open[sibling]:
                    self.pop_sibling(sibling)
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        self.stack.append((tag, self.place, self.level, self.mute, self.article, self.heading))
        self.open[tag] += 1
        if tag == "a":
            self.links_open += 1
        if tag == "body":                     # an open head ends here
            self.mute = False
        if tag in NO_TEXT:
            self.parts.append(" " if tag in ("button", "select", "textarea") else "")
            self.mute = True
        if not attrs and tag not in CONTAINER and tag not in BOILERPLATE and tag not in HEADINGS and tag not in ("form", "header"):
            return
        given = dict(attrs)
        names = _names(given) if attrs else []
        role = (given.get("role") or "").lower() if attrs else ""
        if tag in BOILERPLATE or (tag not in ("html", "body", "main") and (role in ROLES or _hidden(given) or _marked(names))):
            self.flush()
            self.level = MARKED
        elif not self.article and (tag == "header" or PAGE_HEADERS.intersection(names)):
            self.flush()
            self.level = MARKED
        elif tag == "form":
            self.level = max(self.level, IN_FORM)
        if tag in CONTAINER or role in ("main", "article"):
            kind = ""
            if tag == "article" or role == "article":
                kind = "article"
            elif tag == "main" or role == "main":
                kind = "main"
            elif given.get("itemprop") == "articleBody" or TEXT_NAMES.intersection(names):
                kind = "named"
            elif tag in ("body", "td"):
                kind = "page"
            if kind in ("article", "main"):
                self.article = True
                if self.level == IN_FORM:     # the form is the page's wrapper
                    self.level = PLAIN
            self.parents.append(self.place)
            self.kinds.append(kind)
            self.place = len(self.parents) - 1
        if tag in HEADINGS:
            self.heading = True

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            if not self.open[tag]:
                self.flush()
        if self.open[tag]:
            self.pop_to(tag)
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1

    def pop(self) -> str:
        tag = self.stack[-1][0]
        # what the element marked holds for text up to its end
        if tag in BLOCK or tag in CONTAINER or self.stack[-1][2] != self.level:
            self.flush()
        _, self.place, self.level, self.mute, self.article, self.heading = self.stack.pop()
        self.open[tag] -= 1
        if tag == "a":
            self.links_open -= 1
        return tag

    def pop_to(self, tag: str) -> None:
        while self.pop() != tag:
            pass

    def pop_sibling(self, tag: str) -> None:
        for entry in reversed(self.stack):
            if entry[0] == tag:
                self.pop_to(tag)
                return
            if entry[0] in SCOPES:
                return


def _hidden(attrs: dict) -> bool:
    style = (attrs.get("style") or "").lower().replace(" ", "")
    return "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or "display:none" in style or "visibility:hidden" in style


def smoothed(ratios: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian of two standard deviations to each side; at the ends the weights inside the page count as one."""
    reach = math.ceil(2 * sigma)
    kernel = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratios)):
        at = range(max(0, i - reach), min(len(ratios), i + reach + 1))
        weights = [kernel[j - i + reach] for j in at]
        out.append(sum(ratios[j] * w for j, w in zip(at, weights)) / sum(weights))
    return out


def content_lines(lines: list[_Line], sigma: float = SIGMA) -> list[bool]:
    """Cluster of each line: smoothed text-to-tag ratio at or above the standard deviation of all, and mostly no links."""
    if not lines:
        return []
    flat = smoothed([line.chars / max(1, line.tags) for line in lines], sigma)
    mean = sum(flat) / len(flat)
    level = math.sqrt(sum((x - mean) ** 2 for x in flat) / len(flat))
    return [x >= level and 2 * line.links <= line.chars for x, line in zip(flat, lines)]


def _inside(places: list[int], roots: set[int]) -> list[bool]:
    """Whether each container is one of ``roots`` or inside one; parents come before children."""
    inside: list[bool] = []
    for i, parent in enumerate(places):
        inside.append(i in roots or (parent >= 0 and inside[parent]))
    return inside


def _region(parser: PageLines, lines: list[_Line], content: list[bool]) -> list[_Line]:
    parents, kinds = parser.parents, parser.kinds
    own, voted = defaultdict(int), defaultdict(int)
    for line, is_content in zip(lines, content):
        own[line.place] += line.chars
        voted[line.place] += line.chars if is_content else 0
    mass, votes = [0] * len(parents), [0] * len(parents)
    for i in range(len(parents) - 1, -1, -1):
        mass[i] += own[i]
        votes[i] += voted[i]
        if parents[i] >= 0:
            mass[parents[i]] += mass[i]
            votes[parents[i]] += votes[i]
    for kind in ("article", "main", "named"):
        nested = _inside(parents, {i for i, k in enumerate(kinds) if k == kind})
        tops = [i for i, k in enumerate(kinds) if k == kind and mass[i] and not (parents[i] >= 0 and nested[parents[i]])]
        best = max(tops, key=lambda i: (votes[i], mass[i], -i), default=None)
        if best is not None and mass[best] >= ENOUGH * mass[0]:
            chosen = {i for i in tops if i == best or votes[i] >= ALSO * max(1, votes[best])}
            inside = _inside(parents, chosen)
            return [line for line in lines if inside[line.place]]
    # no marked article: content lines vote for their container, half for the one around it, and so on
    score = defaultdict(float)
    for place, chars in voted.items():
        share = float(chars)
        while place >= 0 and share >= 1:
            score[place] += share
            place, share = parents[place], share / 2
    if not any(voted.values()):
        return [line for line in lines if 2 * line.links <= line.chars]
    best = max(score, key=lambda i: (score[i], -i))
    inside = _inside(parents, {best})
    mine = [i for i, line in enumerate(lines) if inside[line.place]]
    if kinds[best] in ("page", "") and parents[best] <= 0:
        # the page itself: from the first content line, with the headings right before it, to the last
        found = [i for i in mine if content[i]]
        start = mine.index(found[0])
        while start and lines[mine[start - 1]].heading:
            start -= 1
        mine = [i for i in mine[start:] if i <= found[-1]]
    return [lines[i] for i in mine if content[i] or 2 * lines[i].links <= lines[i].chars]


def main_text(html: str | None) -> str:
    """The main text of one page; blocks joined by line breaks."""
    if not html:
        return ""
    parser = PageLines()
    found = parser.page(html)
    for level in (PLAIN, IN_FORM):
        lines = [line for line in found if line.level <= level]
        if lines:
            return "\n".join(line.text for line in _region(parser, lines, content_lines(lines)))
    return ""


@F.pandas_udf(T.StringType())
def _main_text(html: pd.Series) -> pd.Series:
    return html.map(main_text)


def extract_text(pages: DataFrame, html_col: str = "html", out: str = "text", size_out: str = "n_chars") -> DataFrame:
    """``pages`` with the main text of ``html_col`` and its number of code points (long).

    Defined results: a null or empty page, or one with nothing but boilerplate, has the empty text; a page
    without markup is its own text, a block; markup that is cut off or wrong is read as far as it goes;
    repeated rows are read alike; existing columns ``out`` and ``size_out`` are replaced, all others kept.
    """
    return pages.withColumn(out, _main_text(F.col(f"`{html_col}`"))).withColumn(size_out, F.length(F.col(f"`{out}`")).cast("long"))
