"""HTML extraction: parser events become lines, and smoothed text-to-tag ratios select the content region."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import query, table

# deviation of the Gaussian, in lines, and the share of the clustered text that the region must hold
SIGMA = 2.0
REGION_SHARE = 0.9
# words in elements named as something else than the article that may be an article, where the rest of the page has none
ARTICLE_WORDS = 25

# Element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNREAD = frozenset("script style noscript template head title svg math iframe object embed canvas audio video textarea map input".split())
# elements that hold what stands beside the text, unless somebody forgot to close them
ASIDE = frozenset("select button nav footer aside menu dialog option datalist label".split())
CONTAINERS = frozenset("html body main article section div td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# a word of class, id or role that marks the text of others: advertisers, the site's own notices, readers
OTHERS = frozenset(
    "ad ads adv advert advertisement advertising advertorial adbox adsense adslot sponsor sponsored sponsors promo promotion promoted cookie cookies consent gdpr "
    "comment comments commentlist reply replies respond disqus".split())
# words that may as well name the frame of the article or its title: the element is left out unless its text says otherwise
TITLES = frozenset("header masthead topbar banner".split())
MARKS = TITLES | frozenset(
    "notice notices notification alert sidebar aside rail menu menus nav navbar navigation breadcrumb breadcrumbs footer "
    "share sharing social related recommended newsletter subscribe subscription signup login "
    "popup modal overlay widget toolbar pagination pager skip contentinfo complementary search form".split())
# a name that starts with these says what stands beside the text
BESIDE = frozenset("has no with without".split())
# an element that starts here closes these open ones
CLOSES = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"}), "body": frozenset({"head"}),
}
STOPS = frozenset("ul ol dl table article section div main body td".split())


class Line(NamedTuple):
    text: str
    tags: int
    item: bool  # a list item of links only
    linked: bool  # mostly links
    number: int  # place in the page
    heading: bool
    container: int | None  # the innermost one
    mark: int | None  # the innermost one
    aside: bool


class Container:
    """An element that may be the region: its lines are those from `first` up to `end`."""

    def __init__(self, parent: int | None, tag: str, first: int):
        self.parent, self.tag, self.first, self.end = parent, tag, first, None

    def __contains__(self, line: Line) -> bool:
        return self.first <= line.number < self.end


class Open(NamedTuple):
    """An open element, with what holds for everything in it."""
    tag: str
    unread: bool
    aside: bool
    mark: int | None
    container: int | None
    block: int  # place of the innermost element that is not inline, this one or one around it


def _words(names: str) -> set[str]:
    """The words of the names in an attribute, but of those that say what stands beside the text."""
    split = [re.split(r"[^a-z]+", re.sub(r"\d+", "", name)) for name in names.split()]
    return {w for words in split if words[0] not in BESIDE for w in words}


class Lines(HTMLParser):
    """Collects the lines of a page, its containers and its marked elements, in time that grows with the page.

    Text in elements for others makes lines of its own. `places` knows where elements of a name are open, so no
    tag walks through all that nobody closed.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = []
        self.places: dict[str, list[int]] = {}
        self.headings = 0
        self.lines: list[Line] = []
        self.containers: list[Container] = []
        self.marks: list[tuple[int | None, bool]] = []  # the mark around it, whether all its words may name a title
        self._start()

    def _start(self):
        self.texts, self.linked, self.tags = ([], []), [0, 0], 0

    def read(self, html: str) -> Lines:
        # an unclosed tag at the end is text; so said, the parser need not look for its end at each of its "<"
        whole = html.rfind(">") + 1
        self.feed(html[:whole] + html[whole:].replace("<", "&lt;"))
        self.close()
        self.end_line()
        self._close(0)
        return self

    def end_line(self):
        for aside, parts in enumerate(self.texts):
            words = "".join(parts).split()
            if words:
                text, top = " ".join(words), self.open[-1] if self.open else None
                linked = self.linked[aside] >= 0.8 * len(text)
                self.lines.append(Line(
                    text, self.tags, linked and bool(self.places.get("li")), linked, len(self.lines), self.headings > 0,
                    top and top.container, top and top.mark, bool(aside)))
        self._start()

    def _last(self, tags) -> int:
        """Place of the innermost open element of these names; -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _close(self, at: int):
        while len(self.open) > at:
            gone = self.open.pop()
            self.places[gone.tag].pop()
            self.headings -= gone.tag in HEADINGS
            if gone.tag in CONTAINERS:
                self.containers[gone.container].end = len(self.lines)

    def _names(self, tag: str, attrs: list) -> tuple[bool, bool, set]:
        """Whether an element is never read, whether it is for others, and its marks."""
        if tag in ("html", "body"):
            return False, False, set()
        unread, names = tag in UNREAD, set()
        for name, value in attrs:
            value = (value or "").lower()
            if name in ("class", "id", "role"):
                names |= _words(value)
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                unread = True
        marks = names & MARKS
        if tag == "form" or tag == "header" and self._last(("article", "main")) < 0:
            marks.add(tag)
        return unread, tag in ASIDE or not OTHERS.isdisjoint(names), marks

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.end_line()
        if tag in ("article", "main"):  # an article does not stand in a menu or a footer that nobody closed
            while self.open and (self.open[-1].unread or self.open[-1].aside or self.open[-1].mark is not None) and not self.places.get("article"):
                self._close(len(self.open) - 1)
        closes = CLOSES.get(tag, frozenset()) if tag in INLINE or tag in CLOSES else frozenset({"p"})
        if (at := self._last(closes)) >= 0 and at >= self._last(STOPS):
            self._close(at)
        self.tags += 1
        if tag not in VOID:
            above = self.open[-1] if self.open else Open("", False, False, None, None, -1)
            unread, aside, marks = self._names(tag, attrs)
            mark, container, place = above.mark, above.container, len(self.open)
            if marks:
                self.marks.append((mark, marks <= TITLES))
                mark = len(self.marks) - 1
            if tag in CONTAINERS:
                self.containers.append(Container(container, tag, len(self.lines)))
                container = len(self.containers) - 1
            block = above.block if tag in INLINE else place
            self.open.append(Open(tag, above.unread or unread, above.aside or aside, mark, container, block))
            self.places.setdefault(tag, []).append(place)
            self.headings += tag in HEADINGS

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.end_line()
        self.tags += 1
        at = self._last((tag,))
        if at >= 0 and (tag not in INLINE or at > self.open[-1].block):
            self._close(at)

    def handle_data(self, data):
        if not (self.open and self.open[-1].unread):
            aside = bool(self.open) and self.open[-1].aside
            self.texts[aside].append(data)
            if self.places.get("a"):
                self.linked[aside] += len(data.strip())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over the neighbouring lines; the ends repeat."""
    reach = max(1, int(round(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def clustered(lines: list[Line]) -> np.ndarray:
    """Which lines are content: smoothed characters for each tag of at least their deviation."""
    ratios = smoothed(np.array([len(x.text) / max(1, x.tags) for x in lines]))
    return ratios >= min(ratios.std(), ratios.max())


def region(page: Lines, lines: list[Line], content: np.ndarray) -> Container | None:
    """The container of the content: the text of the lines above the threshold votes.

    The region is the outermost article or main element that holds the wanted share of the cluster's text,
    else the innermost other container that does.
    """
    votes, total = [0] * len(page.containers), 0
    for line, is_content in zip(lines, content):
        if is_content:
            total += len(line.text)
            if line.container is not None:
                votes[line.container] += len(line.text)
    _add_up(votes, [c.parent for c in page.containers])
    # without a vote of its own a container is not looked at, even if nothing votes
    held = [c for c, n in zip(page.containers, votes) if n and n >= REGION_SHARE * total]
    named = [c for c in held if c.tag in ("article", "main")]
    articles = [c for c in named if c.tag == "article"] or named
    if articles:
        return articles[0]
    return held[-1] if held else None


def _add_up(votes: list[int], parents: list[int | None]) -> None:
    """Adds to every element what the elements inside it have; those come after it."""
    for i in range(len(votes) - 1, -1, -1):
        if parents[i] is not None:
            votes[parents[i]] += votes[i]


def _beside(lines: list[Line]) -> list[Line]:
    """The lines that are not for others. Those count too if the rest has no line in the cluster of the page and they have an article's words."""
    rest = [x for x in lines if not x.aside]
    if sum(len(x.text.split()) for x in lines if x.aside and not x.linked) < ARTICLE_WORDS:
        return rest
    plain = [x for x in lines if not x.item]
    return rest if any(is_content and not x.aside and not x.linked for x, is_content in zip(plain, clustered(plain))) else lines


def _read(page: Lines) -> list[Line]:
    """The lines that no mark excludes. A marked element stays if it holds most of the clustered text, and titles in it stay anyway."""
    lines, total = _beside(page.lines), 0
    plain, votes = [x for x in lines if not x.item], [0] * len(page.marks)
    if any(x.mark is not None for x in plain):
        for line, is_content in zip(plain, clustered(plain)):
            if is_content and not line.linked:
                total += len(line.text)
                if line.mark is not None:
                    votes[line.mark] += len(line.text)
    _add_up(votes, [parent for parent, _ in page.marks])
    # of each mark: whether it or one around it excludes, and whether all that do may name a title
    verdicts = []
    for (parent, titles), n in zip(page.marks, votes):
        against, titled = verdicts[parent] if parent is not None else (False, True)
        verdicts.append((True, titled and titles) if 2 * n <= total else (against, titled))
    return [x for x in lines if x.mark is None or not verdicts[x.mark][0] or x.heading and verdicts[x.mark][1]]


def main_text(html: str | None) -> str:
    """The article of a page as one line of text; empty for a null, empty or textless page.

    Elements whose tag or name says that their text is not the article's are read only where the rest of the
    page has no line in the cluster; names that may as well belong to a frame of the article exclude an element
    that does not hold most of the clustered text. Scripts, styles, heads and hidden elements are never read.
    Of the rest, every line of the content region is kept, however short. Where no article or main element is
    the region, so is every line of the cluster outside it that is not mostly links, and all other lines of the
    widest container around the region whose lines are all content, headings or the region's.
    List items that are links only stay inside the region.
    """
    page = Lines().read(html or "")
    lines = _read(page)
    voting = [x for x in lines if not x.item] or lines
    if not voting:
        return ""
    content = clustered(voting)
    chosen = region(page, voting, content)
    if chosen is not None and chosen.tag in ("article", "main"):
        return " ".join(x.text for x in lines if x in chosen)
    cluster = {x.number for x, is_content in zip(voting, content) if is_content and not x.linked}
    if chosen is not None:
        strange = np.zeros(len(page.lines) + 1, np.int64)  # lines before each place that stop the widening
        strange[[x.number + 1 for x in lines if x.number not in cluster and not x.heading]] = 1
        strange = strange.cumsum()
        within = lambda c: strange[c.end] - strange[c.first]
        while chosen.parent is not None:
            wider = page.containers[chosen.parent]
            if wider.tag in ("html", "body") or within(wider) > within(chosen):
                break
            chosen = wider
    whole = chosen is not None and chosen.tag not in ("html", "body")
    at = [i for i, x in enumerate(lines) if x.number in cluster]
    between = range(at[0], at[-1] + 1) if at else range(len(lines))
    inside = lambda x: chosen is None or x in chosen
    return " ".join(
        x.text for i, x in enumerate(lines)
        if x.number in cluster or inside(x) and (not x.item or whole or i in between or len(voting) == len(lines)))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(data.decode("utf-8", "replace") if data else "") for data in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """Main text of every row of `pages` (page_id, url, html): page_id, url, text. Other columns are not read; repeated rows stay."""
    plain = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("binary"))
    return plain.mapInArrow(_extracted, "page_id long, url string, text string")


@query("op2_html")
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
