"""Main text of web pages by text-to-tag ratios.

A streaming parser (html.parser of the standard library) turns a page into lines, one per block of text, with its
characters and the tags that led to it. The logarithm of a line's characters by tag is its ratio; text inside links counts
for nothing in it, but in an article. What an element says of its lines is a prior that the ratio is multiplied by: 1 for
lines of an article or main element, less for lines beside one, and next to nothing for headers, footers, sidebars, forms,
notices, adverts and comments (elements, roles, and words of classes and ids). Text in menus counts as links do.
Ratios are smoothed by a Gaussian along the page and weighed by the prior again; lines that have a ratio
and reach a share of the spread of all levels, and a least level, form clusters. A cluster within an article grows to all of that article. One in a run of lines
outside of articles grows over its neighbours of the run up to lines that are mostly links; where the page has an article,
it does not grow.

Words of classes and ids say nothing of html, body, main and article; in an article, and of paragraphs and headings, only
whole classes that name adverts and the like do. A heading in the header of an article is the article's.

Each page is worked on where it is read; a task holds one page's lines at a time, and nothing is shuffled.

Defined results: null and empty pages, and pages without a main text, have an empty text; broken markup is read as far as it
makes sense: elements left open end with the element around them, a head also where content begins, an end tag without a start is ignored, and so is a tag that
the page breaks off in; scripts, images, fields and whatever else is not shown as text interrupt no line, unless they are
blocks; rows that repeat are each extracted; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import read
from tripmill.llm.shingles import chunks

SIGMA, REACH = 1.0, 3  # of the Gaussian, in lines
SHARE, LEAST = 0.5, 0.05  # of the standard deviation of all levels, and the level, that a line must reach
ROWS_AT_ONCE = 512

# Names of HTML.
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
    "legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template iframe object svg math canvas audio video head title select textarea button".split())
FURNITURE = set("header footer aside form dialog fieldset".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
TEXTS = HEADINGS | set("p pre blockquote li dd dt td th figcaption".split())  # judged by few words only
MENUS, MENU_ROLES = {"nav", "menu"}, set("navigation menu menubar toolbar".split())
FURNITURE_ROLES = set("banner contentinfo complementary search form dialog alert alertdialog".split())
# Words in classes and ids; reader comments and boxes beside the text may hold articles of their own.
FURNITURE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies dialog footer gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notification overlay pagination pager paywall popup promo promotion search share sharing signup skip social "
    "sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
ASIDE_WORDS = set("comment comments discussion disqus related recommended replies reply responses sidebar teaser".split())
ADVERT_WORDS = set("ad ads adv advert adverts advertisement advertising breadcrumb breadcrumbs pagination sponsor sponsored".split())
STATES = set("has with without no".split())  # classes that begin so tell what an element has beside its text
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEAD_CONTENT = set("base basefont bgsound link meta noframes noscript script style template title".split())
SCOPES = set("ul ol dl table div section article main aside nav body".split())

CUT_OFF = re.compile(r"<!--.*\Z|<[A-Za-z/!?][^>]*\Z", re.DOTALL)  # a tag or comment that the page ends in
PARTS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
PLAIN, ARTICLE, BOX, SIDE, NONE, HEADER, MENU = range(7)  # lines of an element: BOX is furniture, SIDE also for articles in it, HEADER that of an article
PRIORS = {PLAIN: 1.0, ARTICLE: 1.0, BOX: 0.05, HEADER: 0.05, SIDE: 0.02, MENU: 0.6}
BESIDE = 0.6  # prior of plain lines where the page has an article


def names_in(given: dict[str, str], outer: int) -> set[str]:
    """Words of classes and ids; within an article only whole classes, as parts of names and ids there speak of content."""
    classes = given.get("class", "").split()
    if outer == ARTICLE:
        return {name.lower() for name in classes}
    parts = [PARTS.split(name.strip("-_")) for name in (*classes, given.get("id", ""))]
    return {part.lower() for name in parts if name[0].lower() not in STATES for part in name}


def kind_of(tag: str, attributes: list[tuple[str, str | None]], outer: int = PLAIN) -> int:
    if tag in SILENT:
        return NONE
    given = {name: value or "" for name, value in attributes}
    if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower():
        return NONE
    role = given.get("role", "").lower()
    content = tag in ("article", "main") or role in ("main", "article")
    judged = not content and tag not in ("body", "html") and ("class" in given or "id" in given)
    names = names_in(given, outer) if judged else set()
    if tag in TEXTS:
        names &= ADVERT_WORDS
    if tag == "aside" or names & ASIDE_WORDS:
        return SIDE
    if tag == "header" and outer == ARTICLE:
        return HEADER
    if tag in FURNITURE or role in FURNITURE_ROLES:
        return BOX
    if content:
        return ARTICLE
    if tag in MENUS or role in MENU_ROLES:
        return MENU
    return BOX if names & FURNITURE_WORDS else PLAIN


def inside(outer: int, kind: int) -> int:
    """The kind of an element within another: nothing is seen in silent ones, and boxes of comments keep all they hold."""
    for strong in (NONE, SIDE):
        if strong in (outer, kind):
            return strong
    return outer if kind == PLAIN else kind


class Lines(HTMLParser):
    """Blocks of text of one page: text, characters, those outside links, tags, kind and the number of the region."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int]] = []  # tag, kind of its lines, region
        self.links, self.regions = 0, 0
        self.parts: list[str] = []
        self.plain, self.tags = 0, 0
        self.lines: list[tuple[str, int, int, int, int, int]] = []

    def here(self) -> tuple[int, int]:
        return self.stack[-1][1:] if self.stack else (PLAIN, 0)

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            kind, region = self.here()
            self.lines.append((text, len(text), self.plain, self.tags, kind, region))
            self.tags = 0
        self.parts, self.plain = [], 0

    def close_to(self, depth: int) -> None:
        del self.stack[depth:]

    def end_head(self, tag: str | None = None) -> None:
        """</head> may be left out: the head ends where a body, text or an element begins that may not stand in it."""
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == "head":
                return self.close_to(depth)
            if tag != "body":
                return None

    def end_implied(self, tag: str) -> None:
        """Ends an open paragraph, item or cell where a block begins that it cannot hold."""
        if self.stack and self.stack[-1][0] == "p" or tag in IMPLIED:
            ends = IMPLIED.get(tag, {"p"}) | {"p"}
            for depth in range(len(self.stack) - 1, -1, -1):
                if self.stack[depth][0] in ends:
                    return self.close_to(depth)
                if self.stack[depth][0] in SCOPES:
                    return None

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_CONTENT:
            self.end_head(tag)
        outer, region = self.here()
        shown = outer != NONE and tag not in SILENT
        if shown and tag in BLOCKS:
            self.end_line()
            self.links = 0
            self.end_implied(tag)
            outer, region = self.here()
        self.tags += shown
        if tag in VOID:
            return
        kind = inside(outer, kind_of(tag, attrs, outer))
        if outer == HEADER and tag in HEADINGS and kind != NONE:
            kind, region = next((k, r) for _, k, r in reversed(self.stack) if k == ARTICLE)
        elif kind != outer or tag in ("article", "main") and outer == PLAIN:
            self.regions += 1
            region = self.regions
        self.stack.append((tag, kind, region))
        if tag == "a":
            self.links += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        before = self.here()
        if before[0] != NONE:
            self.tags += 1
            if tag in BLOCKS:
                self.end_line()
        if tag == "a":
            self.links = max(0, self.links - 1)
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                own = self.stack[depth][1]
                if own not in (NONE, before[0]):
                    self.end_line()
                self.close_to(depth)
                if before[0] == NONE and tag in BLOCKS and self.here()[0] != NONE:
                    self.end_line()  # a block that is not shown parts the text around it
                if before[0] in (BOX, SIDE, MENU) and self.here()[0] == PLAIN and tag in BLOCKS:
                    # What follows furniture is another region than what came before it.
                    self.regions += 1
                    self.stack = [(t, k, self.regions if k == PLAIN else r) for t, k, r in self.stack]
                return

    def handle_data(self, data):
        if data.strip():
            self.end_head()
        if self.here()[0] != NONE:
            self.parts.append(data)
            if not self.links and self.here()[0] != MENU:
                self.plain += len(data.strip())


def smoothed(values: np.ndarray) -> np.ndarray:
    weights = np.array([math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-REACH, REACH + 1)])
    middle = slice(REACH, REACH + len(values))
    return np.convolve(values, weights)[middle] / np.convolve(np.ones(len(values)), weights)[middle]  # pages have no lines beyond their ends


def ratios(chars: np.ndarray, plain: np.ndarray, tags: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Logarithms of characters by tag."""
    return np.log1p(np.where(kinds == ARTICLE, chars, plain) / np.maximum(tags, 1))


def priors(kinds: np.ndarray) -> np.ndarray:
    values = np.array([PRIORS[kind] for kind in kinds])
    return np.where((kinds == PLAIN) & (kinds == ARTICLE).any(), BESIDE, values)


def grown(clusters: np.ndarray, kinds: np.ndarray, regions: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The lines that clusters grow to."""
    article = kinds == ARTICLE
    if article.any():
        return clusters | article & np.isin(regions, regions[clusters & article])
    chosen = clusters & ~linked
    for region in np.unique(regions[chosen & (kinds == PLAIN)]):
        run = np.flatnonzero((regions == region) & (kinds == PLAIN))
        at = np.flatnonzero(chosen[run])
        first, last = at[0], at[-1]
        while first > 0 and not linked[run[first - 1]]:
            first -= 1
        while last + 1 < len(run) and not linked[run[last + 1]]:
            last += 1
        chosen[run[first : last + 1]] = True
    return chosen


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.rawdata = CUT_OFF.sub("", page.rawdata)
    page.close()
    page.end_line()
    if not page.lines:
        return ""
    chars, plain, tags, kinds, regions = np.array([line[1:] for line in page.lines]).T
    prior = priors(kinds)
    ratio = ratios(chars, plain, tags, kinds)
    levels = prior * smoothed(prior * ratio)
    clusters = (ratio > 0) & (levels >= max(LEAST, SHARE * levels.std()))
    chosen = grown(clusters, kinds, regions, 2 * plain < chars)
    return "\n".join(line[0] for line, take in zip(page.lines, chosen, strict=True) if take)


TEXTS_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
            ids, urls, pages = (column.to_pylist() for column in batch.slice(begin, ROWS_AT_ONCE).columns)
            for a, b in chunks([len(page or "") for page in pages]):
                columns = ids[a:b], urls[a:b], [main_text(page) for page in pages[a:b]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, TEXTS_SCHEMA, strict=True)], schema=TEXTS_SCHEMA)


def page_texts(pages: DataFrame, *, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    texts = rows.mapInArrow(extract, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(read(spark, sf_dir, "pages"))
