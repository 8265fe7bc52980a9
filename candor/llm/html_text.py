"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RADIUS, SIGMA = 2, 1.0    # of the smoothing over neighbouring text nodes
THRESHOLD = 0.7           # share of the page's level, the mean logarithm of the fused ratio over its letters
PROSE = 160               # fused ratio (a sentence of 80 letters and its stop) that is selected beside blocks of any length
LINK_SHARE = 0.5          # above it a block outside the selected paths is a list of links

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
UNSEEN = frozenset("script style noscript template svg math iframe object applet audio video canvas select datalist "
                   "textarea button title map progress meter".split())
MARGIN = frozenset("nav aside footer form dialog menu fieldset search".split())
ARTICLE = frozenset("article main".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
STRUCTURE = HEADING | frozenset("li dt dd td th caption blockquote pre figcaption p".split())
WRAPPER = frozenset("ul ol dl li dt dd table thead tbody tfoot tr td th caption blockquote figure figcaption".split())
# An element of the first list ends open elements of the second, up to a border of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, set()),
}
# Words in class or id that mark what is not the article.
_MARKS = ("ad ads adbox advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
          "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
          "login nav navbar navigation menu breadcrumb breadcrumbs sidebar widget widgets related recommended "
          "recommendations share sharing social footer masthead topbar comment comments commentlist disqus reply replies "
          "respond discussion pagination pager toolbar skip")
_MARKED = frozenset(_MARKS.split())
# Words that stand beside a mark in a name and say nothing of the content.
_NEUTRAL = frozenset("area article bar blog block body bottom box button card cell center col column container content "
                     "custom desktop div entry fixed form global grid group header home icon inner item items label layout "
                     "left link links list main mobile module outer page panel post posts primary reader readers right row "
                     "secondary section site slot small sticky story text thread title top unit user users view web wrap "
                     "wrapper".split())
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PARTS = re.compile(r"[^\W\d_]{2,}")
_STATE = re.compile(r"(?:has|with|no|is|not)[-_]", re.IGNORECASE)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_UNENDED = re.compile(r"<[A-Za-z/!?]")
_STOPS = re.compile(r"[.,;:!?…。，、；：！？]")
_KERNEL = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(RADIUS + 1)]


class _Element:
    __slots__ = ("tag", "parent", "path", "depth", "out", "mark", "article", "held")

    def __init__(self, tag: str, parent, path: int, depth: int, out: bool, mark: int = 0):
        self.tag, self.parent, self.path, self.depth, self.out, self.mark = tag, parent, path, depth, out, mark
        own = tag in ARTICLE and not out
        self.article = self if own else parent.article if parent is not None else None
        self.held = 0


def _mark(names: list[str]) -> int:
    """What class and id say: 2 if a name is of marks alone, or of several; 1 if a mark stands beside a word of content."""
    best = 0
    for name in names:
        if _STATE.match(name):
            continue
        parts = _PARTS.findall(_HUMP.sub("-", name).lower())
        marks = sum(x in _MARKED for x in parts)
        if marks:
            known = all(x in _MARKED or x in _NEUTRAL for x in parts)
            best = max(best, 2 if known or marks > 1 else 1)
    return best


class _Blocks(HTMLParser):
    """Splits a page into blocks of text, each with its innermost block element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.paths: dict[tuple[int, str], int] = {}
        self.open = [_Element("", None, 0, 0, False)]
        self.elements = list(self.open)
        self.counts: Counter[str] = Counter()
        self.blocks: list[tuple[_Element, str, int]] = []
        self._text: list[str] = []
        self._linked, self._links = 0, 0

    def finish(self) -> list[tuple[_Element, str, int]]:
        if _UNENDED.match(self.rawdata):  # a tag or comment that the page's end cuts off is no text
            self.rawdata = ""
        self.close()
        self._end_block()
        return self.blocks

    def _end_block(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((self.open[-1], text, min(self._linked, len(text))))
            self._text, self._linked = [], 0

    def _margin(self, tag: str, attrs: list, above: _Element) -> tuple[bool, int]:
        """Whether element, role or style put this out of the article, and the mark of its class and id."""
        if tag in UNSEEN or tag in MARGIN or tag == "head":
            return True, 0
        if tag == "header" and not above.article:
            return True, 0
        named = []
        for key, value in attrs:
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search(value or "")):
                return True, 0
            if key == "role" and (value or "").lower() in _ROLES:
                return True, 0
            if key in ("class", "id") and value:
                named += value.split()
        return False, 0 if tag in ("html", "body", "main") else _mark(named)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br" or tag == "hr" or tag == "wbr":
            if tag == "hr":
                self._end_block()
            elif tag == "br":
                self._text.append(" ")
            return
        if tag in VOID:
            return
        if tag in INLINE:
            out, mark = self._margin(tag, attrs, self.open[-1]) if attrs else (False, 0)
            if not out and mark < 2:
                self._links += tag == "a"
                return
        self._end_block()
        ends, borders = CLOSES.get(tag, ((), ()))
        while len(self.open) > 1:
            top = self.open[-1].tag
            if top == "p" or top in ends or (top == "head" and tag not in UNSEEN):
                self._pop()
            elif ends and top not in borders and any(e.tag in ends for e in self._inside(borders)):
                self._pop()
            else:
                break
        above = self.open[-1]
        # Every article has paths of its own, so that a teaser is not judged by the article beside it.
        step = f"{tag} {len(self.elements)}" if tag in ARTICLE else tag
        path = self.paths.setdefault((above.path, step), len(self.paths) + 1)
        out, mark = self._margin(tag, attrs, above)
        self.open.append(_Element(tag, above, path, above.depth + 1, above.out or out, mark))
        self.elements.append(self.open[-1])
        self.counts[tag] += 1

    def _pop(self) -> str:
        tag = self.open.pop().tag
        self.counts[tag] -= 1
        return tag

    def _inside(self, borders: set) -> Iterator[_Element]:
        for e in reversed(self.open):
            if e.tag in borders:
                return
            yield e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # In HTML the slash of a tag means nothing, but for elements that are empty anyway.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE and self.open[-1].tag != tag:
            self._links = max(0, self._links - 1) if tag == "a" else self._links
            return
        if self.counts[tag]:
            self._end_block()
            while self._pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        self._text.append(data)
        if self._links:
            self._linked += len(data.strip())


def _ratio(text: str, linked: int) -> float:
    """One block's text outside links, times punctuation, as a logarithm."""
    return math.log1p((len(text) - linked) * (1 + len(_STOPS.findall(text))))


def _judge_clear_marks(elements: list[_Element], blocks: list[tuple[_Element, str, int]]) -> None:
    """Elements whose names are of marks alone go, unless the page's article lies in them.

    It does if the element has more text than all that no clear mark covers, and
    holds the page's title, or several sentences where no other text has one.
    """
    # Of each element: the nearest clearly marked one around it; of those: text and sentences no inner one covers.
    near = {elements[0]: elements[0]}
    for e in elements[1:]:
        near[e] = e if e.mark == 2 and not e.out else near[e.parent]
    size, prose, titles = Counter(), Counter(), Counter()
    own_size, own_prose = Counter(), Counter()
    for e, text, linked in blocks:
        sentence = _ratio(text, linked) >= math.log1p(PROSE)
        size[e] += len(text)
        prose[e] += sentence
        titles[e] += e.tag == "h1"
        own_size[near[e]] += len(text)
        own_prose[near[e]] += sentence
    for e in reversed(elements[1:]):
        for sums in (size, prose, titles):
            if e in sums:
                sums[e.parent] += sums[e]
    outside = {elements[0]: (0, 0)}
    for e in elements[1:]:
        e.out = e.out or e.parent.out
        if e.mark == 2 and not e.out:
            around = near[e.parent]
            text, sentences = outside[around][0] + own_size[around], outside[around][1] + own_prose[around]
            outside[e] = (text, sentences)
            e.out = not (size[e] > text and (titles[e] or (prose[e] > 1 and not sentences)))


def _judge_faint_marks(elements: list[_Element], blocks: list[tuple[_Element, str, int]], means: dict[int, float], cut: float) -> bool:
    """Elements with a mark among other words go if their ratio is low or they are links by half; whether any went."""
    if all(e.mark != 1 or e.out for e in elements):
        return False
    size, low, links = Counter(), Counter(), Counter()
    for e, text, linked in blocks:
        size[e] += len(text)
        links[e] += linked
        low[e] += len(text) * (_ratio(text, linked) + means[e.path] < 2 * cut)
    for e in reversed(elements[1:]):
        if e in size:
            for sums in (size, low, links):
                sums[e.parent] += sums[e]
    went = False
    for e in elements[1:]:
        e.out = e.out or e.parent.out
        if e.mark == 1 and not e.out and (2 * low[e] > size[e] or links[e] > LINK_SHARE * size[e]):
            e.out = went = True
    return went


def _selected(blocks: list[tuple[_Element, str, int]]) -> tuple[dict[int, float], float]:
    """Paths by length and punctuation, smoothed over neighbours and fused, as logarithms, and the cut for content paths."""
    totals: dict[int, list[float]] = {}
    for e, text, linked in blocks:
        t = totals.setdefault(e.path, [0, 0, 0])
        t[0] += 1
        t[1] += len(text) - linked
        t[2] += len(_STOPS.findall(text))
    series = []
    for k in (1, 2):
        ratio = [totals[e.path][k] / totals[e.path][0] for e, _, _ in blocks]
        smooth = []
        for i in range(len(ratio)):
            low, high = max(0, i - RADIUS), min(len(ratio), i + RADIUS + 1)
            near = [j for j in range(low, high) if blocks[j][0].article is blocks[i][0].article]
            weights = [_KERNEL[abs(i - j)] for j in near]
            smooth.append(sum(w * ratio[j] for w, j in zip(weights, near, strict=True)) / sum(weights))
        series.append(smooth)
    # Logarithms: the fused ratio grows with the square of a block's length, and one long block must not set the scale.
    # A path's own ratio counts as much as the smoothed one, so that a lone label is not lifted by the text beside it.
    own = {p: math.log1p(t[1] / t[0] * (1 + t[2] / t[0])) for p, t in totals.items()}
    fused = [(math.log1p(x * (1 + y)) + own[e.path]) / 2 for x, y, (e, _, _) in zip(*series, blocks, strict=True)]
    letters = [len(text) - linked for _, text, linked in blocks]
    level = sum(n * z for n, z in zip(letters, fused, strict=True)) / max(1, sum(letters))
    cut = min(THRESHOLD * level, math.log1p(PROSE))
    by_path: dict[int, list[float]] = {}
    for (e, _, _), z in zip(blocks, fused, strict=True):
        by_path.setdefault(e.path, []).append(z)
    means = {p: sum(zs) / len(zs) for p, zs in by_path.items()}
    return means, min(cut, max(means.values()))


def _flow(e: _Element) -> _Element:
    """The element whose running text a block belongs to: lists, tables, quotes and figures are part of it."""
    if e.tag in STRUCTURE:
        e = e.parent
    while e.tag in WRAPPER:
        e = e.parent
    return e


def _with_sections(blocks: list[tuple[_Element, str, int]], kept: list[bool]) -> list[bool]:
    """Headings stay or go with their section: the blocks up to the next heading of their rank or above."""
    kept, alive = list(kept), [False] * 7
    for i in reversed(range(len(blocks))):
        tag = blocks[i][0].tag
        if tag in HEADING:
            rank = int(tag[1])
            kept[i] = kept[i] and alive[rank]
            alive[rank:] = [False] * (7 - rank)
        elif kept[i]:
            alive = [True] * 7
    return kept


def main_text(html: str | None) -> str:
    """The article's text of one page: blocks in page order, joined by blanks."""
    if not html:
        return ""
    parser = _Blocks()
    parser.feed(html)
    blocks = [b for b in parser.finish() if not b[0].out]
    if any(e.mark == 2 for e in parser.elements):
        _judge_clear_marks(parser.elements, blocks)
        blocks = [b for b in blocks if not b[0].out]
    if not blocks:
        return ""
    means, cut = _selected(blocks)
    if _judge_faint_marks(parser.elements, blocks, means, cut):
        blocks = [b for b in blocks if not b[0].out]
        if not blocks:
            return ""
        means, cut = _selected(blocks)
    paths = {p for p, z in means.items() if z >= cut}
    chosen = [b for b in blocks if b[0].path in paths]
    named = sum(len(t) for e, t, _ in chosen if e.article)
    if 2 * named >= sum(len(t) for _, t, _ in chosen):
        # The page names its article: the rest of the page is no candidate.
        chosen = [b for b in chosen if b[0].article]
        blocks = [b for b in blocks if b[0].article]
    for e, _, _ in chosen:
        e.held += 1
    for e in reversed(parser.elements[1:]):
        e.parent.held += e.held
    content = scope = max((e for e in parser.elements if e.held == len(chosen)), key=lambda e: e.depth)
    above = content
    while above is not None:
        scope = above if above.tag in ARTICLE and not above.out else scope
        above = above.parent
    inside, titled = set(), set()
    for e in parser.elements:
        if e is content or e.parent in inside:
            inside.add(e)
        if e is scope or e.parent in titled:
            titled.add(e)
    flows = {_flow(e) for e, _, _ in chosen}
    kept = []
    for e, text, linked in blocks:
        if e.tag in HEADING:
            kept.append(e.path in paths or (e in titled and (e.article is None or e.article.held > 0)))
        else:
            kept.append(e.path in paths or (
                e in inside and e.tag in STRUCTURE and _flow(e) in flows and linked <= LINK_SHARE * len(text)))
    if any(k and b[0].tag not in HEADING for k, b in zip(kept, blocks, strict=True)):
        kept = _with_sections(blocks, kept)
    return " ".join(t for (_, t, _), k in zip(blocks, kept, strict=True) if k)


@F.pandas_udf(T.StringType())
def _main_texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in pages:
        yield pd.Series([main_text(h) for h in part], dtype=object)


def extracted(html: Column) -> Column:
    return _main_texts(html)


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row, from the whole html.

    A page falls into blocks at block elements; unclosed and misnested tags are
    ended as browsers end them. Each block counts for its path of block elements
    from the root (inline elements are no part of it). Paths are scored by text
    outside links and by punctuation per block, smoothed over neighbouring blocks
    of the same article, and multiplied. A path is selected by the logarithm of
    that, meant with the unsmoothed one: at least ``THRESHOLD`` of the mean over the page's letters, or as much as
    a sentence has. Each ``article`` and ``main`` has its own paths; if such
    elements hold half of the selected text, blocks outside them are no
    candidates. Within the smallest element around all selected blocks,
    paragraphs, list items, cells and quotes that run in the same element as
    selected text stay whatever their ratio, unless they are links by half.
    Headings stay or go with their section. Menus, headers, footers, sidebars and
    forms told by element or role, scripts, styles and hidden elements never
    count. A class or id is evidence only: one made of marks (``comment-list``)
    puts an element out unless it holds more text than all unmarked elements and
    the page's title, or the only sentences; one with a word of content beside
    the mark (``related-work``) puts it out if its ratio is below the cut or it
    is links by half. Character references are decoded; white space in
    a block, whatever its kind, becomes one blank. Null or empty html, or a page
    without text, gives an empty text. Rows are judged one by one, repeats alike;
    other columns are not read.
    """
    return (pages.select("page_id", "url", extracted(pages.html).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
