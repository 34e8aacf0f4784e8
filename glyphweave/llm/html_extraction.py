"""Main text of web pages by the text-to-tag ratio of their lines.

The standard library's parser streams events. Block tags cut the page into lines; each line has its text, the number
of tags met in it, the share of it that is links, and the element it stands in. The logarithm of each line's ratio of
unlinked characters to tags is smoothed with a Gaussian kernel and split by two-means clustering: lines of the upper
cluster that are not mostly links are content lines. They decide on everything else:

* Names of classes are a weak prior. An element that is named like boilerplate is left out, unless it holds more than
  half of the page's content; then its name is not believed.
* The region of the article is the main or article element with most content, with what belongs to it (see
  ``_article``). On pages without one it is found from the body downwards: as long as one container holds most content,
  and what is beside it is no text of the same kind, the search goes on within.
* Inside the region all lines stay, short ones too, but for lists of links (three lines or more without any content),
  and, at the edges of a region that does not say what it is, lines that are mostly links.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot "
    "thead tr ul caption".split()
)
#: Block elements that hold other blocks; all others are text of the place where they stand.
HOLDERS = frozenset("body div section center table tbody tr td main article aside details fieldset form header footer nav dialog".split())
#: Elements whose text is never content.
SKIP = frozenset("script style head title noscript template nav footer aside form iframe svg button select textarea object canvas audio video menu dialog math datalist".split())
MAIN = frozenset(["article", "main"])
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - {"html", "body"}
_AWAY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form status toolbar".split())
_AWAY_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|adslot|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|side-?bar\w*|footer\w*|site-?header|page-?header|masthead|cookies?|consent|notices?|gdpr|"
    r"pop-?up\w*|modal\w*|overlay|newsletter|subscribe\w*|subscription|signup|login|share\w*|social\w*|related\w*|recommend\w*|breadcrumbs?|pagination|pager|toolbar|widget\w*|"
    r"comments?|comment-?(?:list|section|thread|area)|disqus|respond|replies|discussion|skip-?link|sr-only|visually-?hidden|copyright|disclaimer)(?:$|[\s_-])",
    re.I,
)
#: Names that say how an element is laid out (has-sidebar, no-footer), not what it is; ``hidden`` counts as a whole name only.
_STATE_NAME = re.compile(r"(?:has|have|with|no|not|without|is)[_-]", re.I)
_TALK_NAME = re.compile(r"comment|disqus|respond|replies|discussion", re.I)
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Lines(HTMLParser):
    """Parser events to lines (text, tags, linked characters, element) and elements.

    Elements are blocks, and others that say whether they are content: (element around, tag, drop, box, heading, class).
    ``drop``: -1 where text is dropped in any case, 1 if its name looks like boilerplate, 2 if like readers' talk, else 0.
    ``box``: 2 for a main element, 1 for an article, else 0. Every event takes constant time, or closes what it walks over.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.elements: list[tuple[int, str, int, int, bool, str]] = [(-1, "", 0, 0, False, "")]
        self.stack: list[list] = [["", 0, 0, False]]  # tag, element, like tags opened within, whether below a box
        self.open: Counter = Counter()
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.link: int | None = None  # depth at which a link was opened

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.linked, self.stack[-1][1]))
        self.parts.clear()
        self.tags = self.linked = 0

    def _close(self, at: int) -> None:
        self._flush()
        for entry in self.stack[at:]:
            self.open[entry[0]] -= 1
        del self.stack[at:]
        if self.link is not None and self.link > len(self.stack):
            self.link = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._flush()
            if tag in ENDS_P and self.open["p"]:
                at = len(self.stack) - 1
                while self.stack[at][0] not in BLOCK and at:
                    at -= 1
                if self.stack[at][0] == "p":
                    self._close(at)
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        values = dict(attrs)
        if tag == "a":
            self.link = len(self.stack) if "href" in values else None
        boxed = self.stack[-1][3]
        drop = self._drop(tag, values, boxed)
        box = 2 if tag == "main" or values.get("role") == "main" else 1 if tag == "article" else 0
        if tag in BLOCK or drop or box:
            self._flush()
            around = self.stack[-1][1]
            self.elements.append((around, tag, drop, box, tag in HEADING or self.elements[around][4], values.get("class") or ""))
            self.stack.append([tag, len(self.elements) - 1, 0, boxed or box > 0])
            self.open[tag] += 1
        elif self.open[tag] and self.stack[-1][0] == tag:
            self.stack[-1][2] += 1

    @staticmethod
    def _drop(tag: str, values: dict[str, str | None], boxed: bool) -> int:
        if tag == "form":
            return 1
        if tag in SKIP or tag == "header" and not boxed or "hidden" in values or values.get("aria-hidden") == "true":
            return -1
        if tag in ("html", "body", "main"):
            return 0
        if (values.get("role") or "").lower() in _AWAY_ROLES or _HIDDEN_STYLE.search(values.get("style") or ""):
            return -1
        names = [n for k in ("class", "id") for n in (values.get(k) or "").split() if n.lower() in ("hidden", "is-hidden") or _AWAY_NAME.search(n) and not _STATE_NAME.match(n)]
        return (2 if any(_TALK_NAME.search(n) for n in names) else 1) if names else 0

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.link = None
        if not self.open[tag]:
            return
        if tag not in BLOCK and self.stack[-1][0] == tag and self.stack[-1][2]:
            self.stack[-1][2] -= 1
            return
        at = len(self.stack) - 1
        while self.stack[at][0] != tag:
            if self.stack[at][0] in BLOCK and tag not in BLOCK:
                return  # a stray inline end tag does not close blocks
            at -= 1
        self._close(at)

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.link is not None and not self.elements[self.stack[-1][1]][4]:  # headings are text, linked or not
            self.linked += sum(map(len, data.split()))

    def close(self) -> None:
        super().close()
        self._flush()


def smooth(values: list[float], sigma: float) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is renormalised."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
            total += values[j] * kernel[abs(i - j)]
            weight += kernel[abs(i - j)]
        out.append(total / weight)
    return out


def threshold(values: list[float], apart: float = math.log(2)) -> float:
    """Middle between the means of two clusters (one-dimensional two-means from the extremes); the least value where
    the means are less than ``apart``, so that lines of one kind are not split."""
    low, high = min(values), max(values)
    for _ in range(50):
        mid = (low + high) / 2
        a, b = [v for v in values if v < mid], [v for v in values if v >= mid]
        new = (sum(a) / len(a) if a else low, sum(b) / len(b) if b else high)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high - low >= apart else min(values)


def _article(elements: list[tuple], boxes: set[int], best: int) -> set[int]:
    """Boxes that make up the article: the outermost main element around the best one; without any, the outermost
    article and the articles that stand in the same element; and all that is within."""
    chain = [best]
    at = elements[best][0]
    while at >= 0:
        if at in boxes:
            chain.append(at)
        at = elements[at][0]
    tops = [m for m in chain if elements[m][3] == 2][-1:] or [m for m in boxes if elements[m][0] == elements[chain[-1]][0] and elements[m][3] == 1]
    return set(tops)


def _sums(elements: list[tuple], values: dict[int, int]) -> list[int]:
    """By element, the sum of ``values`` (by element) within it; elements come after those around them."""
    out = [values.get(e, 0) for e in range(len(elements))]
    for e in range(len(elements) - 1, 0, -1):
        out[elements[e][0]] += out[e]
    return out


def _within(elements: list[tuple], tops: set[int]) -> list[bool]:
    out = [False] * len(elements)
    for e in range(len(elements)):
        out[e] = e in tops or e > 0 and out[elements[e][0]]
    return out


def _descend(elements: list[tuple], mass: list[int], direct: dict[int, int]) -> int:
    """The innermost container that holds most content, where no text of the same kind stands beside it."""
    children: dict[int, list[int]] = {}
    for e in range(1, len(elements)):
        if mass[e]:
            children.setdefault(elements[e][0], []).append(e)
    at = 0
    while True:
        own = children.get(at, [])
        if direct.get(at) or not own or any(elements[e][1] not in HOLDERS and elements[e][1] != "html" for e in own):
            return at
        best = max(own, key=lambda e: (mass[e], -e))
        like = [e for e in own if e != best and (elements[e][1], elements[e][5]) == (elements[best][1], elements[best][5])]
        if like or 10 * mass[best] < 7 * mass[at]:
            return at
        at = best


def main_text(html: str | None, sigma: float = 1.0, clustered: bool = True) -> str:
    """The article of one page, its blocks joined by newlines; empty where there is none.

    Without ``clustered``, every line counts as a content line; that is what the clusters are measured against.
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines, elements = parser.lines, parser.elements
    if not lines:
        return ""
    sizes = [len(text) - text.count(" ") for text, *_ in lines]
    links = [2 * linked > size for size, (_, _, linked, _) in zip(sizes, lines, strict=True)]
    hard = [False] * len(elements)
    for e, (around, _, drop, *_) in enumerate(elements):
        hard[e] = drop < 0 or around >= 0 and hard[around]
    shown = [i for i, x in enumerate(lines) if not hard[x[3]]]
    if not shown:
        return ""
    # logarithms, so that one very long line does not make all others look like the rest
    raw = [math.log1p((sizes[i] - min(sizes[i], lines[i][2])) / max(1, lines[i][1])) for i in shown]
    ratio = dict(zip(shown, smooth(raw, sigma), strict=True))
    cut = threshold(list(ratio.values()))
    content = [i for i in shown if not links[i] and (ratio[i] >= cut or not clustered)]

    def masses(of: list[int]) -> list[int]:
        by: dict[int, int] = {}
        for i in of:
            by[lines[i][3]] = by.get(lines[i][3], 0) + sizes[i]
        return _sums(elements, by)

    mass = masses(content)
    boxes = {e for e, x in enumerate(elements) if x[3] and not hard[e]}
    boxed = _within(elements, boxes)
    in_boxes = masses([i for i in content if boxed[lines[i][3]]])
    flagged = [False] * len(elements)
    for e, (around, _, drop, *_) in enumerate(elements):
        flagged[e] = e > 0 and flagged[around]
        if drop > 0 and not flagged[e]:  # talk is not believed to be the article where another box has content
            flagged[e] = 2 * mass[e] <= mass[0] or drop == 2 and in_boxes[0] > in_boxes[e]
    open_ = [i for i in shown if not flagged[lines[i][3]]]
    content = [i for i in content if not flagged[lines[i][3]]]
    mass, whole = masses(content), masses(open_)
    boxes = {b for b in boxes if not flagged[b] and whole[b]}
    if boxes:
        best = max(boxes, key=lambda b: (mass[b], whole[b], -b))
        region = _within(elements, _article(elements, boxes, best))
        edges = False
    else:
        direct: dict[int, int] = {}
        for i in content:
            direct[lines[i][3]] = direct.get(lines[i][3], 0) + 1
        top = _descend(elements, mass, direct)
        region = _within(elements, {top})
        edges = True
    kept = [i for i in open_ if region[lines[i][3]]]
    # lists of links: elements of three lines or more that are mostly links, without content
    by: dict[int, int] = {}
    linked: dict[int, int] = {}
    for i in kept:
        by[lines[i][3]] = by.get(lines[i][3], 0) + 1
        linked[lines[i][3]] = linked.get(lines[i][3], 0) + links[i]
    n, n_linked = _sums(elements, by), _sums(elements, linked)
    menu = [n[e] >= 3 and 10 * n_linked[e] >= 9 * n[e] and not mass[e] for e in range(len(elements))]
    for e in range(1, len(elements)):
        menu[e] = menu[e] or menu[elements[e][0]]
    left = [i for i in kept if not menu[lines[i][3]]] or kept
    if edges:
        found = [i for i in content if region[lines[i][3]]]
        first, last = (found[0], found[-1]) if found else (0, len(lines))
        left = [i for i in left if first <= i <= last or not links[i]] or left
        before = [i for i in open_ if i < left[0] and not region[lines[i][3]]]
        titles = [i for i in before if elements[lines[i][3]][1] == "h1"]
        while before and elements[lines[before[-1]][3]][4] and before[-1] not in titles:
            titles.append(before.pop())
        left = sorted({*titles, *left})
    return "\n".join(lines[i][0] for i in left)


def extract_main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), sigma: float = 1.0) -> DataFrame:
    """One row per page: the ``keep`` columns, ``text`` and ``n_chars`` (code points).

    Null or empty html and pages without content give an empty text; repeated rows stay; other columns are left
    out, so names can't clash; an empty table gives no rows. Each page is parsed alone, whatever its length, in
    streamed Arrow batches: no shuffle. Time and memory grow in proportion to a page.
    """
    own = pages.select(*keep, F.col(html).alias("__html"))
    fields = [f for f in own.schema.fields if f.name != "__html"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", text string, n_chars bigint"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), sigma) for x in batch.column("__html")]
            columns = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=[*(f.name for f in fields), "text", "n_chars"])

    return own.mapInArrow(parse, schema)
