"""Main text of web pages from the standard library's parser events, read as a stream.

A page becomes lines: the texts between block tags, each with the tags met in it. A line's text-to-tag ratio is weighted by
where it stands (0 inside menus, headers, footers, sidebars, notices, adverts, forms and comments; half under a class that
may mean such; more inside an article or main element), then smoothed by a Gaussian. Runs of lines at or above one standard
deviation are the content clusters. A cluster's lines are kept from its first to its last line that reaches the threshold
by itself, and choose a content region: the innermost container with most of them, or the article it lies in. A region's
short lines are text too, as are headings right before it; runs of link lines that the clusters leave out are menus.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockside.llm.storage import small_batches, text_slices

SIGMA, REACH = 1.0, 2  # of the Gaussian, in lines
DOUBTFUL, FAVOURED = 0.5, 3.0  # weights of a class that may mark what is no content, and of an article
MENU = 3  # link lines in a row that make a menu
_FEED = 1 << 16  # characters given to the parser at once

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    """address article aside audio blockquote body br canvas caption center col colgroup dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noframes
    object ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul video""".split()
)
CONTAINER = {"", *"html body main article section div center table tbody tr td".split()}
#: Elements whose text is never part of an article.
OUT = set(
    """head title script style noscript template iframe object svg canvas audio video nav menu footer aside form fieldset legend
    button select option optgroup textarea datalist dialog noframes""".split()
)
#: Words of classes and ids that mark what is not the article.
OUT_WORDS = set(
    """ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices notification alert popup modal overlay sidebar aside menu menus nav navigation navbar breadcrumb
    breadcrumbs pagination pager footer share sharing social related recommended recommendations subscribe subscription
    newsletter signup login search widget widgets copyright disclaimer toolbar skip""".split()
)
#: Those that mean it whatever stands beside them; of the others half the words of a class must be such, else it is doubtful.
CLEAR_WORDS = set("ad ads adv advert adverts advertisement cookie cookies gdpr consent sidebar navbar breadcrumb breadcrumbs newsletter sponsored".split())
COMMENT_WORDS = set("comment comments commentlist disqus reply replies respond discussion".split())
HEADER_WORDS = set("header masthead topbar".split())
OUT_ROLES = set("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog toolbar".split())
NOT_REALLY = {"has", "with", "no", "without"}
#: An open element of the second kind ends where one of the first begins.
ENDED_BY = {
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), ("p",)),
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",),
}
_SCOPE = set("html body article main section div td th table ul ol dl nav aside header footer form".split())


def _names(attrs: dict[str, str | None]) -> list[list[str]]:
    """The words of each class and of the id, but for such as has-sidebar."""
    found = []
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
        if words and not NOT_REALLY & set(words[:-1]):
            found.append(words)
    return found


def _meant(names: list[list[str]], marking: set[str]) -> float:
    """0 where a class says one of ``marking``, ``DOUBTFUL`` where it may, else 1."""
    weight = 1.0
    for words in names:
        share = sum(w in marking for w in words) / len(words)
        if share >= 0.5 or marking & CLEAR_WORDS & set(words):
            return 0.0
        if share:
            weight = DOUBTFUL
    return weight


class Page(HTMLParser):
    """Elements by number, with their parent; lines with the element that they stand in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.weight, self.link = [""], [-1], [1.0], [False]
        self.home = [-1]  # the outermost article or main around an element
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.open: Counter[str] = Counter()
        self.lines: list[tuple[int, str, int, bool]] = []  # element, text, tags, whether links hold the text
        self.parts, self.tags, self.at, self.plain = [], 0, None, False

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if self.at is not None and (text or not self.weight[self.at]):
            self.lines.append((self.at, text, self.tags, not self.plain))
            self.tags = 0
        self.parts, self.at, self.plain = [], None, False

    def _own_weight(self, tag: str, attrs: dict[str, str | None]) -> float:
        inside = self.home[self.stack[-1][1]] >= 0
        names, role = _names(attrs), (attrs.get("role") or "").lower()
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style") or ""):
            return 0.0
        if tag in ("html", "body", "main"):
            return 1.0
        if any(COMMENT_WORDS & {words[0], words[-1]} for words in names):
            return 0.0
        if tag == "article":
            return 1.0
        if tag in OUT or role in OUT_ROLES - ({"banner"} if inside else set()):
            return 0.0
        if not inside and tag == "header":  # an article's own header holds its title
            return 0.0
        return min(_meant(names, OUT_WORDS), 1.0 if inside else _meant(names, HEADER_WORDS))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._flush()
        self.tags += 1
        if tag in VOID:
            return
        for open_ in ENDED_BY.get(tag, ()):
            self._close(open_, within=True)
        if tag in ("article", "main"):  # neither begins inside a menu or header that was never closed
            self._close("nav")
            self._close("header")
        own, above = dict(attrs), self.stack[-1][1]
        number = len(self.parent)
        self.tag.append(tag)
        self.parent.append(above)
        self.weight.append(self.weight[above] and min(self.weight[above], self._own_weight(tag, own)))
        self.link.append(self.link[above] or tag == "a")
        home = self.home[above]
        if home < 0 and self.weight[number] and (tag in ("article", "main") or (own.get("role") or "").lower() in ("main", "article")):
            home = number
        self.home.append(home)
        self.stack.append((tag, number))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self._close(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        self.tags += 1
        if tag not in VOID:
            self._close(tag)

    def _close(self, tag: str, within: bool = False) -> None:
        """Close the innermost open ``tag`` and what it holds; ``within``: only if no element that bounds it lies between."""
        if not self.open[tag]:
            return
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.stack[k][0]
            if name == tag:
                self.open.subtract(name for name, _ in self.stack[k:])
                del self.stack[k:]
                return
            if within and name in _SCOPE:
                return

    def handle_data(self, data: str) -> None:
        element = self.stack[-1][1]
        if not self.weight[element]:
            if not self.parts and data.strip():
                self.at = element
            return
        if self.at is None or (not self.parts and not self.weight[self.at]):
            self.at = element
        self.parts.append(data)
        self.plain = self.plain or (not self.link[element] and not data.isspace())

    def read(self, html: str) -> "Page":
        for start in range(0, len(html), _FEED):
            self.feed(html[start : start + _FEED])
        self.close()
        self._flush()
        return self


def smoothed(values: np.ndarray) -> np.ndarray:
    """A Gaussian mean over neighbouring lines; at the ends over those that are there."""
    k = np.exp(-(np.arange(-REACH, REACH + 1) ** 2) / (2 * SIGMA**2))
    # "full" and a cut: a page may have fewer lines than the kernel
    mean = lambda x: np.convolve(x, k, mode="full")[REACH : REACH + len(x)]
    return mean(values) / mean(np.ones(len(values)))


def main_text(html: str | None) -> str:
    """The page's main text: its blocks in order, joined by one space; empty for null, for empty and for pages without one."""
    page = Page().read(html or "")
    weight = np.array([page.weight[e] for e, *_ in page.lines])
    usable = np.array([bool(text) for _, text, *_ in page.lines], bool) & (weight > 0)
    if not usable.any():
        return ""
    home = np.array([page.home[e] for e, *_ in page.lines])
    size = np.array([len(text) for _, text, *_ in page.lines], float)
    own = ratios(size, np.array([tags for _, _, tags, _ in page.lines])) * np.where(usable, weight, 0) * np.where(home >= 0, FAVOURED, 1)
    kept = _selected(page, usable, weight, home, own, size)
    return " ".join(line[1] for line, ok in zip(page.lines, kept) if ok)


def ratios(size: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Text-to-tag ratio of each line."""
    return size / np.maximum(tags, 1)


def _selected(page: Page, usable: np.ndarray, weight: np.ndarray, home: np.ndarray, own: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The lines that the content clusters keep, by themselves and through their regions."""
    even = smoothed(own)
    threshold = min(even.std(), even[usable].max())
    above = usable & (even >= threshold)
    strong = above & (own >= min(threshold, own[above].max()))
    cluster = np.cumsum(np.diff(above, prepend=False) & above)  # number of the run that a line above the threshold is in
    kept, held = np.zeros(len(own), bool), np.zeros(len(own), bool)
    for c in np.unique(cluster[strong]).tolist():
        lines = np.nonzero(strong & (cluster == c))[0]
        kept[lines[0] : lines[-1] + 1] |= above[lines[0] : lines[-1] + 1]
    if (home[kept] >= 0).any():  # every article that is not itself a comment or a sidebar's is text
        held |= home >= 0
    else:
        held |= _below(page, _regions(page, kept & strong, cluster, size))
    links = np.array([line[3] for line in page.lines]) & usable & (own < threshold)
    kept |= held & usable & ((weight == 1) | above) & ~_menus(links, usable)
    return kept | _headings(page, kept, usable)


def _regions(page: Page, strong: np.ndarray, cluster: np.ndarray, size: np.ndarray) -> set[int]:
    """For each cluster the innermost container with over half of its strong lines' text. A container's number is below those of what it
    holds, so the first one found from the highest number down is the innermost; nothing above it is visited."""
    found = set()
    for c in np.unique(cluster[strong]).tolist():
        total: Counter[int] = Counter()
        for k in np.nonzero(strong & (cluster == c))[0].tolist():
            total[page.lines[k][0]] += size[k]
        enough, queue = sum(total.values()) / 2, [-e for e in total]
        heapq.heapify(queue)
        while queue:
            e = -heapq.heappop(queue)
            if page.tag[e] in CONTAINER and total[e] > enough:
                found.add(e)
                break
            above = page.parent[e]
            if above not in total:
                heapq.heappush(queue, -above)
            total[above] += total[e]
    return found


def _menus(links: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """Runs of ``MENU`` or more such lines, with no other usable line in between."""
    at = np.nonzero(usable)[0]
    run = np.cumsum(np.diff(links[at], prepend=False) != 0)
    long = np.bincount(run, minlength=run.max() + 1)[run] >= MENU
    found = np.zeros(len(links), bool)
    found[at] = links[at] & long
    return found


_HEADING = re.compile("h[1-6]")


def _headings(page: Page, kept: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """Headings that stand right before a kept line."""
    found, follows = np.zeros(len(kept), bool), False
    for k in range(len(kept) - 1, -1, -1):
        if kept[k]:
            follows = True
        elif usable[k]:
            follows = found[k] = follows and _HEADING.fullmatch(page.tag[page.lines[k][0]]) is not None
    return found


def _below(page: Page, regions: set[int]) -> np.ndarray:
    """The lines inside one of the regions."""
    inside = np.zeros(len(page.parent), bool)
    for e, above in enumerate(page.parent):
        inside[e] = e in regions or (above >= 0 and inside[above])
    return inside[[e for e, *_ in page.lines]]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): one row per row of ``pages``, from its whole html.

    Null, empty and text-free pages have an empty text; broken markup is read as far as its tags go; repeated rows stay; null ids and
    urls stay null. Other columns are not read.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return small_batches(source).mapInArrow(run, "page_id long, url string, text string, n_chars long")
