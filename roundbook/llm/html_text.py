"""Main text of web pages by line-block distribution.

Markup is stripped to lines: one line per block (a paragraph, heading, list
item, table row, or run of text between line breaks), with character references
decoded and white space collapsed. Parts that are never main text (scripts,
forms, menus, headers and footers of the page, sidebars, notices, adverts,
comments of readers) become empty lines, as does the border of a marked article.

A line's length is that of its text outside links. Lengths are summed over every
window of lines between two empty ones. Text surges at the first window that
reaches the threshold and dives at the first that doesn't: a line stays if all
windows that hold it reach it, on marked and unmarked pages alike, so runs of short
lines fall out whatever their names; lines that are links alone go from both ends
of what stays. A marked article is a weight: its lines count ``MARKED`` times, and
where its surging lines weigh as much as the others', the others are left out. An
article that is only a teaser weighs less; the page is then judged as one
without marks.

No part is dropped that holds the page's longest article if no other part has one
as long as a surge, or, on pages without an article elsewhere, most of the text.
Short lines between kept lines of the same container are kept, as are a heading
right before them and all lines of an article that is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unused

#: Lines in a window, and the window sum (code points) at which text surges: the
#: defaults published with the line-block method.
WINDOW, SURGE = 3, 86
#: How often a code point within a marked article counts.
MARKED = 2

# A quote opens a value only after an equals sign; anywhere else in a tag it is an ordinary character.
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][\w:-]*)((?:[^>=]|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|$)", re.DOTALL)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|itemprop|aria-label|hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math canvas object".split())
_DROPPED = frozenset("nav footer aside form head menu dialog button select option fieldset input audio video".split()) | _RAW
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
) | (_DROPPED - frozenset("button input select option".split()))
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTAINER = frozenset("article blockquote body center div fieldset figure form html main section td".split())
_WORD = r"ads?|adverts?|advert(?:isement|ising)s?|adsense|banner|sponsor(?:ed)?|promo(?:tion)?s?|nav(?:igation|bar)?|menus?|breadcrumbs?|side-?bar|cookies?|consent|notices?|alert|popup|modal|newsletter|subscri(?:be|ption)|comments?|disqus|respond|replies|related|recommend(?:ed|ations)?|share|sharing|social|footer|masthead|page-?header|site-?header|top-?bar|pagination|pager|skip-?link|widget|login|signup|search|copyright|toolbar|hidden"
#: Names dropped as a whole: listed words alone, or beside words that say only where or in what form.
_NOISE = re.compile(rf"(?:(?:site|page|main|top|bottom)[_-]?)?(?:{_WORD})(?:[_-]?(?:{_WORD}|list|form|box|bar|links|area|section|[0-9]+))*", re.IGNORECASE)
_READERS = re.compile(r"comments?|disqus|respond|replies", re.IGNORECASE)


class Line(NamedTuple):
    text: str
    article: int  # number of the outermost marked article, 0 outside
    container: int
    own: int  # code points outside links
    heading: bool


class _Part:
    """A part that may be dropped: the part around it, and whether the amount
    of its text may keep it (menus, footers and readers' comments may be long)."""

    def __init__(self, around: int, layout: bool):
        self.around, self.layout, self.chars, self.kept = around, layout, 0, False


def _noise(name: str, attributes: str, in_main: bool) -> tuple[bool, bool]:
    """Whether an element is never main text, and whether only by its layout
    (so that it may turn out to be a wrapper of the main text)."""
    if name in _DROPPED or (name == "header" and not in_main):
        return True, name in ("form", "fieldset")
    if name in ("body", "html", *_MAIN):
        return False, False
    for m in _NAMES.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if (key == "hidden" and value.lower() != "false") or (key == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE)):
            return True, False
        if key == "role" and value.lower() in _ROLES:
            return True, value.lower() == "form"
        if key in ("class", "id"):
            listed = [v for v in value.split() if _NOISE.fullmatch(v)]
            if listed or (not in_main and value.lower() == "header"):
                return True, not any(_READERS.match(v) for v in listed)
    return False, False


def lines_of(html: str) -> list[Line]:
    """The lines of a page; dropped parts and borders of articles leave empty lines."""
    gap = ("", 0, 0, 0, 0, False)
    out: list[tuple] = []  # text, article, container, innermost part that may be dropped, code points outside links, heading
    parts: list[str] = []
    linked: list[bool] = []  # of each of these
    open_tags: list[tuple] = []  # name, what was around, lines before
    opened: Counter[str] = Counter()  # their names
    last_text = -1  # place of the last line with text
    noises = [_Part(0, False)]
    around = article, container, noise = 0, 0, 0
    marked = 0  # open articles
    longest, longest_in, free, chars = 0, 0, 0, [0]  # of articles: text, part, text of those in no part; characters so far
    numbers = lines = 0

    def end_line() -> None:
        nonlocal lines, last_text
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            own = len(_SPACE.sub(" ", unescape("".join(p for p, k in zip(parts, linked) if not k))).strip()) if any(linked) else len(text)
            parts.clear()
            linked.clear()
            if text:
                last_text = len(out)
                out.append((text, article, container, noise, own, any(opened[h] for h in _HEADINGS)))
                chars[0] += len(text)
                lines += 1

    def close() -> str:
        nonlocal article, container, noise, around, longest, longest_in, free, marked
        if open_tags[-1][0] in _HEADINGS or open_tags[-1][1][2] != noise or open_tags[-1][0] in _MAIN:
            end_line()
        name, before, lines_before, chars_before = open_tags.pop()
        opened[name] -= 1
        if before[2] != noise or name in _MAIN:
            out.append(gap[:3] + (noise, 0, False))
        if before[2] != noise:
            noises[noise].chars = chars[0] - chars_before
        if name in _MAIN:
            marked -= 1
            if chars[0] - chars_before > longest:
                longest, longest_in = chars[0] - chars_before, noise
            if not noise:
                free = max(free, chars[0] - chars_before)
        if name in _CONTAINER and lines - lines_before == 1:  # a paragraph in all but name
            line = out[last_text]
            if line[2] == container:
                out[last_text] = (*line[:2], before[1], *line[3:])
        article, container, noise = around = before
        return name

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if not m:
            parts.append(html[at:])
            linked.append(opened["a"] > 0)
            break
        if m.start() > at:
            parts.append(html[at : m.start()])
            linked.append(opened["a"] > 0)
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
                linked.append(opened["a"] > 0)
            continue
        name = m[2].lower()
        if name in _BLOCK:
            end_line()
        if m[1]:  # an end tag closes up to its start tag, if there is one
            if opened[name]:
                while close() != name:
                    pass
            continue
        if name in _VOID or m[3].endswith("/") and name in ("svg", "math"):
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and open_tags and open_tags[-1][0] == name:
            close()
        if name in _RAW:  # holds no markup: on to its end tag
            end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else size
            end_line()
            out.append(gap)
            continue
        if name == "a" and opened["a"]:  # links don't nest: an open one ends, unless parts opened in it
            if open_tags[-1][0] == "a":
                close()
        dropped, layout = _noise(name, m[3], marked > 0)
        if dropped or name in _MAIN:
            end_line()
            out.append(gap[:3] + (noise, 0, False))
        open_tags.append((name, around, lines, chars[0]))
        opened[name] += 1
        if dropped:
            noises.append(_Part(noise, layout))
            noise = len(noises) - 1
        if name in _CONTAINER:
            numbers += 1
            container = numbers
        if name in _MAIN:
            marked += 1
            article = article or numbers
        around = article, container, noise
    end_line()
    while open_tags:
        close()
    # Parts around the longest article stay, with what is around them, unless another stands free.
    k = longest_in if longest and free < SURGE else 0
    while k:
        noises[k].kept = True
        k = noises[k].around
    gone = _gone(noises)
    if not any(line[0] and line[1] and not gone[line[3]] for line in out):
        for part in noises[1:]:
            part.kept |= part.layout and part.chars >= SURGE and 2 * part.chars > chars[0]
        gone = _gone(noises)
    found: list[Line] = []
    for text, own, inside, k, length, heading in out:
        found.append(Line("", 0, 0, 0, False) if gone[k] or not text else Line(text, own, inside, length, heading))
    return found


def _gone(noises: list[_Part]) -> list[bool]:
    """Whether each part, or one around it, is dropped."""
    gone = [False]
    for part in noises[1:]:
        gone.append(gone[part.around] or not part.kept)
    return gone


def _stretches(lines: list[Line]) -> list[tuple[int, int]]:
    """Runs of lines between empty ones."""
    full = np.flatnonzero([bool(x.text) for x in lines])
    cuts = np.flatnonzero(np.diff(full) > 1)
    return [(int(a[0]), int(a[-1]) + 1) for a in np.split(full, cuts + 1)] if len(full) else []


def _sums(size: np.ndarray, stretches: list[tuple[int, int]]) -> list[np.ndarray]:
    """The sums of all windows of each stretch; a shorter one is a window of its own."""
    return [np.convolve(size[a:b], np.ones(min(WINDOW, b - a), np.int64), "valid") for a, b in stretches]


def surging(size: np.ndarray, stretches: list[tuple[int, int]]) -> np.ndarray:
    """Which lines all windows that hold them reach the threshold: from the line where
    text surges to the one where it dives. Where every line of a page has a window that
    doesn't, one that does is enough. The threshold is ``SURGE``, or the largest
    window sum of a page of little text."""
    sums = _sums(size, stretches)
    surge = max(1, min(SURGE, max((int(s.max()) for s in sums), default=0)))
    dives, surges = np.zeros((2, len(size)), np.int64)
    for (a, b), s in zip(stretches, sums):
        for k in range(min(WINDOW, b - a)):
            dives[a + k : a + k + len(s)] += s < surge
            surges[a + k : a + k + len(s)] += s >= surge
    kept = (surges > 0) & (dives == 0)
    return kept if kept.any() else surges > 0


def main_lines(lines: list[Line]) -> list[str]:
    """The lines of the main text, in page order.

    Lines of marked articles count ``MARKED`` times unless the other surging
    lines outweigh them.
    """
    plain = np.array([x.own for x in lines], np.int64)
    article = np.array([x.article for x in lines], np.int64)
    text = np.array([bool(x.text) for x in lines], bool)
    if not text.any():
        return []
    stretches = _stretches(lines)
    size = np.where(article > 0, MARKED * plain, plain)
    main = surging(size, stretches)
    weight = [int(size[main & ((article > 0) == own)].sum()) for own in (True, False)]
    by_article = weight[0] > 0 and weight[0] >= weight[1]
    kept = main & (article > 0) if by_article else surging(plain, stretches)
    articles = set(article[kept].tolist()) - {0} if by_article else set()
    if not by_article:
        for a, b in stretches:  # links alone, at the ends of what stays
            at = np.flatnonzero(kept[a:b]) + a
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []:
                solid = run[plain[run] > 0]
                kept[run] = (run >= solid[0]) & (run <= solid[-1]) if len(solid) else False
    # Short lines: of an article that is kept, between kept lines of their container, or heading them.
    ends: dict[int, list[int]] = {}
    for i in np.flatnonzero(kept).tolist():
        ends.setdefault(lines[i].container, [i, i])[1] = i
    for i in np.flatnonzero(text & ~kept).tolist():
        first, last = ends.get(lines[i].container, (i, i))
        kept[i] = article[i] in articles or (first < i < last and not (by_article and not article[i]))
    for i in range(len(lines) - 2, -1, -1):
        kept[i] |= lines[i].heading and text[i] and kept[i + 1] and not (by_article and not article[i])
    return [x.text for x, k in zip(lines, kept) if k and x.text]


def extract(html: str | None) -> str:
    """Main text of a page; blocks joined by an empty line."""
    return "\n\n".join(main_lines(lines_of(html))) if html else ""


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with one more column at the end, ``_text`` (or with further underscores,
    if there is a column of that name). Null, empty and textless pages give an empty
    text; repeated rows and other columns stay as they are."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([extract(h) for h in htmls], dtype=object)

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return pages.select("*", F.pandas_udf(of, "string")(F.col(html)).alias(unused(pages, "_text")))
