"""Main text of web pages by text-to-tag ratios over the events of the standard library's HTML parser.

The parser's events are taken one by one: block elements end a line, and a line has its text, the number of tags in it and the elements
it is in. The characters of a line over its tags give a ratio; ratios are smoothed by a Gaussian along the page, and lines whose smoothed
ratio reaches half the deviation of all ratios are the content cluster. Content regions are then the element that holds most of that
cluster's text: an element of the page takes all its lines, so that short lines of an article stay; where only the page itself does, the
lines from the first to the last of the cluster are the region. Lines in menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments, which are known by element, role or class name, count for the ratios but are never content, nor are
lines that are mostly links outside of paragraphs.

White space inside a block is one space (a <br> too, which ends no block), blocks are trimmed and joined by two line feeds.

Defined results: null, empty and text-free pages have an empty text; a page without markup is one block; elements that are never closed
end with the page, stray end tags are ignored; repeated pages give repeated rows; an empty table gives an empty result; further columns
are ignored. Pages of any length are taken whole, in time linear in their length but for the parser's own work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._shared import slices

# Names of HTML elements by the part they play.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNSEEN = frozenset("applet area audio canvas embed head iframe map math meter noembed noframes noscript object progress rp rt script style svg template title video".split())
ASIDE = frozenset("aside button datalist dialog fieldset footer form input label legend menu nav optgroup option search select textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
# Parts of class names and ids of what is not the article.
OTHER = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense alert banner billboard breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer footers gdpr header leaderboard login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination "
    "paywall popup promo promos promoted promotion recommended recommendations related replies reply respond rail search share sharing sidebar sidebars signup "
    "skip social sponsor sponsored sponsors subscribe subscription toc toolbar topbar".split()
)
#: "article-header" is the article's own, "has-sidebar" only tells that the page has one.
OWN, TELLS = frozenset("article content entry main post story".split()), frozenset("has no with without".split())
#: Headings that open the readers' comments or links to other pages.
AFTER = re.compile(r"\s*(\d+\s+)?(comments?|responses|replies|leave a (comment|reply)|related (articles|posts|stories)|read (more|next)|more (from|stories)\b.*|kommentare|commentaires|comentarios)\s*(\(\d+\))?\s*:?\s*", re.IGNORECASE)
_PARTS = re.compile(r"[A-Za-z][a-z]*|\d+")
#: An open element of the first is closed by a start of the second, up to the third.
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
_BEGUN = re.compile(r"<(?=[A-Za-z/!?])")
_SCOPE = frozenset("table ul ol dl body html select".split())


def is_other(names: str) -> bool:
    """Whether a class or id attribute names something beside the article."""
    for name in names.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        found = OTHER.intersection(parts)
        if parts[:1] == ["widget"] or found and parts[0] not in TELLS and not (found <= {"header", "banner"} and OWN.intersection(parts)):
            return True
    return False


class PageLines(HTMLParser):
    """The lines of a page. Of each: text, tags, characters in links, the element it is in, whether that is beside the article, kind of block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.first_line, self.other = ["page"], [-1], [0], [False]  # of each element
        self.stack = [0]
        self.lines: list[tuple[str, int, int, int, bool, str]] = []
        self.pieces: list[str] = []
        self.tags = self.linked = self.unseen = self.links = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            at = self.stack[-1]
            self.lines.append((text, self.tags, min(self.linked, len(text)), at, self.other[at], self.tag[at]))
            self.tags = 0
        self.pieces.clear()
        self.linked = 0

    def _pop(self, at: int) -> None:
        """Close the elements of the stack from place `at` on."""
        self._end_line()
        for element in self.stack[at:]:
            self.unseen -= self.tag[element] in UNSEEN
        del self.stack[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "a":
            self.links = 1
        block = tag in BLOCKS
        if not block and tag not in UNSEEN and tag not in ASIDE:
            if tag == "br":
                self.pieces.append(" ")
            given = dict(attrs) if attrs and tag not in VOID else {}
            if not (given and (given.get("role") in ROLES or is_other(f"{given.get('class') or ''} {given.get('id') or ''}"))):
                return
            if tag in ("b", "i", "em", "strong", "u", "small", "font", "code"):
                return  # often left open
        if tag in VOID and tag != "hr":
            return
        if block:
            self._end_line()
            self.links = 0
            for i in range(len(self.stack) - 1, 0, -1):  # ends that the page may leave out
                open_ = self.tag[self.stack[i]]
                if open_ == "p" or open_ in _CLOSED_BY.get(tag, ()) or open_ in HEADINGS and tag in HEADINGS:
                    self._pop(i)
                    break
                if open_ in _SCOPE or open_ not in ("p", "span", "a") and tag not in _CLOSED_BY:
                    break
        if tag == "hr":
            return
        above = self.stack[-1]
        given = dict(attrs)
        beside = self.other[above] or tag in ASIDE or given.get("role") in ROLES or "hidden" in given or given.get("aria-hidden") == "true"
        if tag not in ("html", "body", "main", "article"):
            beside = beside or is_other(f"{given.get('class') or ''} {given.get('id') or ''}")
        elif not beside:
            beside = any(set(_PARTS.findall((given.get(c) or "").lower())) & {"comment", "comments"} for c in ("class", "id"))
        if tag == "header" and not beside:
            beside = not any(self.tag[e] in ("article", "main", "section") for e in self.stack)
        self.tag.append(tag)
        self.parent.append(above)
        self.first_line.append(len(self.lines))
        self.other.append(beside)
        self.stack.append(len(self.tag) - 1)
        self.unseen += tag in UNSEEN

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.links = 0
        if tag == "br":
            self.pieces.append(" ")
            return
        low = max(0, len(self.stack) - 512)  # an end tag that closes nothing near is a stray one
        for i in range(len(self.stack) - 1, low, -1):
            if self.tag[self.stack[i]] == tag:
                self._pop(i)
                return
            if self.tag[self.stack[i]] in ("table", "article", "main") and tag not in ("html", "body", "article", "main", "div", "section"):
                break
        if tag in BLOCKS:
            self._end_line()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            self.pieces.append(data)
            if self.links:
                self.linked += len(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """`<![` begins no section in HTML: a comment up to the next `>`."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def read(self, html: str) -> None:
        """The whole page. After the last `>` no tag can end, so what begins one there is dropped, as the end of a page is."""
        last = html.rfind(">") + 1
        self.feed(html[:last])
        if self.rawdata.startswith("<!--"):  # a comment without an end takes the rest
            self.rawdata = ""
            return self.close()
        begun = _BEGUN.search(html, last)
        self.feed(html[last : begun.start() if begun else len(html)])
        self.close()

    def close(self) -> None:
        super().close()
        self._pop(1)
        self._end_line()


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; the ends weigh what is there."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    if len(ratios) > 2 * reach:
        return np.convolve(ratios, kernel, "same") / np.convolve(np.ones(len(ratios)), kernel, "same")
    away = np.arange(len(ratios))[:, None] - np.arange(len(ratios))
    weights = np.exp(-0.5 * (away / sigma) ** 2) * (np.abs(away) <= reach)
    return weights @ ratios / weights.sum(axis=1)


def content_cluster(ratios: np.ndarray, sigma: float = 1.0, share: float = 0.5) -> np.ndarray:
    """Which lines are content: the smoothed ratio is at least a share of the deviation of all."""
    smooth = smoothed(ratios, sigma)
    return smooth >= min(share * float(ratios.std()), float(smooth.max()))


def main_text(html: str, most: float = 0.75) -> str:
    """The article of a page. most: the share of the content's text that its element must hold."""
    page = PageLines()
    page.read(html)
    if not page.lines:
        return ""
    size = np.array([len(line[0]) for line in page.lines], float)
    tags = np.array([max(1, line[1]) for line in page.lines], float)
    other = np.array([line[4] for line in page.lines])
    for element in range(1, len(page.tag)):  # a part of the page that is opened by such a heading
        first = page.first_line[element]
        if page.tag[element] in ("section", "div") and first < len(page.lines) and page.lines[first][5] in HEADINGS and page.lines[first][3] > element and AFTER.fullmatch(page.lines[first][0]):
            inside = _within(page, element)
            other |= np.array([inside[line[3]] for line in page.lines])
    links = np.array([line[2] for line in page.lines]) > 0.5 * size
    prose = np.array([line[5] == "p" or line[5] in HEADINGS for line in page.lines])
    allowed = ~other & (~links | prose)
    chosen = content_cluster(size / tags) & allowed
    if not chosen.any():
        chosen = allowed  # pages of short lines only
        if not chosen.any():
            return ""
    held = np.zeros(len(page.tag))
    np.add.at(held, [line[3] for line in page.lines], size * chosen)
    for element in range(len(page.tag) - 1, 0, -1):  # children come after their parents
        held[page.parent[element]] += held[element]
    region, enough = 0, most * held[0]
    for element in range(1, len(page.tag)):
        if held[element] >= enough and page.parent[element] == region and (page.tag[element] not in ("p", "td", "tr", "li") and page.tag[element] not in HEADINGS):
            region = element
    inside = _within(page, region)
    kept = allowed & np.array([inside[line[3]] for line in page.lines])
    if page.tag[region] in ("page", "html", "body"):
        spots = np.flatnonzero(chosen & kept)
        first, last = int(spots[0]), int(spots[-1])
        while first and kept[first - 1] and page.lines[first - 1][5] in HEADINGS:
            first -= 1
        kept[:first] = kept[last + 1 :] = False
    return "\n\n".join(line[0] for line, keep in zip(page.lines, kept, strict=True) if keep)


def _within(page: PageLines, top: int) -> list[bool]:
    """Of each element, whether it is top or in it."""
    inside = [False] * len(page.tag)
    inside[top] = True
    for element in range(top + 1, len(page.tag)):
        inside[element] = inside[page.parent[element]]
    return inside


def extract_pages(df: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keys, text, n_chars: the main text of each page, in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, "html"):
            raw, ends = data.tobytes(), offsets.tolist()
            texts = [main_text(raw[a:b].decode("utf-8", "replace")) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [batch.column(i) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keys, "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in df.select(*keys).schema.fields}
    return df.select(*keys, F.col(html).alias("html")).mapInArrow(run, ", ".join(f"{k} {t}" for k, t in kinds.items()) + ", text string, n_chars long")
