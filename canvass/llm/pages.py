"""Operator 8: main text of web pages.

The standard library's streaming parser turns a page into lines, one for each block of text.  A line's
text-to-tag ratio, smoothed by a Gaussian over its neighbours, is split into two clusters; the lines of the
higher cluster vote for the element that holds the article.  The article or main element around it is taken
whole; without one, the ancestor that holds all lines of the higher cluster.  Its lines, without boilerplate
elements inside, are the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._words import in_batches

# Element names of HTML, and words that name boilerplate in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var br wbr img".split())
DROPPED = frozenset("script style noscript template head title button select textarea option iframe object svg canvas math audio video".split())
MARKED = frozenset("nav footer aside dialog menu".split())
IN_HEAD = frozenset("base link meta title style script noscript template".split())
WHOLE = frozenset("html body article main".split())
BOILERPLATE = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr banner notice alert popup modal overlay "
    "newsletter subscribe subscription paywall sidebar side aside rail menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer copyright legal "
    "share sharing social related recommended recommendations comment comments commentlist reply replies respond disqus discussion widget search login signup complementary contentinfo dialog".split()
)
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
#: Words that, as part of a class name, mark what never is the article, however dense it is.
NOTICES = frozenset("cookie cookies consent gdpr notice notices popup newsletter comment comments".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote ul ol dl figure figcaption address tr th caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMED_LISTS = frozenset("ul ol dl tr figure".split())
CLOSED_BY_BLOCK = frozenset({"p"})
CLOSED_BY_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEPT_APART = frozenset("ul ol dl table tbody thead tfoot tr select".split())

SIGMA, REACH = 1.0, 2
ENOUGH = 0.7
FEED = 65_536

_TOKEN = re.compile(r"[a-z0-9]+")
_COMMENT_ID = re.compile(r"(comment|reply)[-_]?\d*")
_RIGHTS = re.compile(r"(©|\(c\)|copyright\b)", re.IGNORECASE)


def boilerplate(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> str:
    """'gone' with all it holds; 'marked' and 'likely' unless it holds the article, 'likely' also unless it
    holds most of the dense text; else ''.

    Class and id count as whole names, not on headings and blocks of text; a word of a class name is a likely mark,
    one of a notice or of comments a mark.  An article that is named a comment is one.
    """
    given = {k: (v or "").lower() for k, v in reversed(attrs) if k in ("class", "id", "role", "hidden")}
    if tag in DROPPED or "hidden" in given and tag not in WHOLE:
        return "gone"
    if tag == "article" and (not COMMENTS.isdisjoint(given.get("class", "").split()) or _COMMENT_ID.fullmatch(given.get("id", "").strip())):
        return "marked"
    if tag in WHOLE:
        return ""
    if tag in MARKED or tag == "header" and not inside_article:
        return "marked"
    words = BOILERPLATE - {"header"} if inside_article else BOILERPLATE  # an article's own header is text
    classes = given.get("class", "").split()
    named = not words.isdisjoint(classes) or given.get("id", "").strip() in words
    if tag in INLINE:
        return "gone" if tag == "a" and named or not BOILERPLATE.isdisjoint(given.get("role", "").split()) else ""
    text_block = tag in TEXT_BLOCKS and tag not in NAMED_LISTS
    tokens = frozenset() if text_block else frozenset(_TOKEN.findall(" ".join(classes)))
    if not BOILERPLATE.isdisjoint(given.get("role", "").split()) or named and not text_block or not NOTICES.isdisjoint(tokens):
        return "marked"
    if tag == "form" or not words.isdisjoint(tokens):
        return "likely"
    return ""


class Line(NamedTuple):
    text: str
    tags: int
    held_by: int  # number of its innermost container
    linked: int  # characters in links
    heading: bool
    marks: int  # number of the innermost marked element around it


class Open(NamedTuple):
    """An element that is open."""

    tag: str
    number: int
    gone: bool  # it or one around it is dropped
    held_by: int  # number of the innermost container, itself included
    marks: int  # number of the innermost marked element, itself included


class Lines(HTMLParser):
    """Collects a line for each block of text, with the containers and marked elements around it.

    Elements have numbers in order of their beginning; containers and marked elements are trees of such numbers,
    so a page of any depth takes time in proportion to its length.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[Open] = []
        self.blocks: list[int] = []  # places of elements in the stack that are not inline
        self.count: Counter[str] = Counter()  # of open elements by tag
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.made = self.linked = self.headings = 0
        self.above: dict[int, int] = {}  # container around a container
        self.marked_above: dict[int, int] = {}  # marked element around a marked one
        self.whole: dict[int, int] = {}  # article and main elements, with the innermost marked one around them
        self.likely: set[int] = set()

    def read(self, html: str) -> None:
        """Feed in pieces; what follows the last > holds no tag, so its < are text, but for a comment that never ends."""
        end = html.rfind(">") + 1
        for i in range(0, end, FEED):
            self.feed(html[i : min(i + FEED, end)])
        if self.rawdata.startswith("<!--"):
            self.rawdata = ""  # it goes on to the end of the page
        else:
            self.feed(html[end:].partition("<!--")[0].replace("<", "&lt;"))
        self.close()
        self.end_line()

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.stack[-1] if self.stack else Open("", 0, False, 0, 0)
            self.lines.append(Line(text, self.tags, top.held_by, self.linked, self.headings > 0, top.marks))
        self.parts, self.tags, self.linked = [], 0, 0

    def leave_head(self) -> None:
        """The end tag of head may be left out: what cannot stand in it closes it."""
        if self.stack and self.stack[-1].tag == "head":
            self.close_to(len(self.stack) - 1)

    def close_to(self, place: int) -> None:
        if self.blocks and self.blocks[-1] >= place:
            self.end_line()
            while self.blocks and self.blocks[-1] >= place:
                self.blocks.pop()
        for x in self.stack[place:]:
            self.count[x.tag] -= 1
            self.headings -= x.tag in HEADINGS
        del self.stack[place:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self.leave_head()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in INLINE and tag in VOID:
            return
        if tag not in INLINE:
            self.end_line()
            # Whether an open p, or an open element of the same kind, ends here: up to the next element that keeps it open.
            for place in reversed(self.blocks):
                own = self.stack[place].tag
                if own in CLOSED_BY_BLOCK or own in CLOSED_BY_OWN.get(tag, ()):
                    self.close_to(place)
                    break
                if own in KEPT_APART or tag not in CLOSED_BY_OWN or not self.open_to_close(tag):
                    break
            self.tags += 1
        if tag in VOID:
            return
        above = self.stack[-1] if self.stack else Open("", 0, False, 0, 0)
        kind = boilerplate(tag, attrs, self.count["article"] + self.count["main"] > 0)
        self.made += 1
        if tag in ("article", "main") and not above.gone and not kind:
            self.whole[self.made] = above.marks
        if kind == "likely":
            self.likely.add(self.made)
        held_by, marks = above.held_by, above.marks
        if tag not in INLINE and tag not in TEXT_BLOCKS:
            self.above[self.made], held_by = held_by, self.made
        if kind in ("marked", "likely"):
            self.marked_above[self.made], marks = marks, self.made
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(Open(tag, self.made, above.gone or kind == "gone", held_by, marks))
        self.count[tag] += 1
        self.headings += tag in HEADINGS

    def open_to_close(self, tag: str) -> bool:
        """Whether anything is open that a start of ``tag`` may end."""
        return any(self.count[t] for t in CLOSED_BY_OWN[tag]) or self.count["p"] > 0

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1].tag == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if not self.count[tag]:
            return
        place = len(self.stack) - 1
        while self.stack[place].tag != tag:
            place -= 1
        self.close_to(place)

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self.leave_head()
        if not (self.stack and self.stack[-1].gone):
            self.parts.append(data)
            if self.count["a"]:
                self.linked += len(data.strip())


def smoothed(ratios: list[float]) -> list[float]:
    kernel = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-REACH, REACH + 1)]
    out = []
    for i in range(len(ratios)):
        near = [(k, ratios[j]) for k, j in zip(kernel, range(i - REACH, i + REACH + 1), strict=True) if 0 <= j < len(ratios)]
        out.append(sum(k * r for k, r in near) / sum(k for k, _ in near))
    return out


def threshold(values: list[float]) -> float:
    """Midpoint of two cluster centres; the smallest value where there is only one cluster."""
    low, high = min(values), max(values)
    for _ in range(20):
        cut = (low + high) / 2
        under, over = [v for v in values if v <= cut], [v for v in values if v > cut]
        if not over:
            return low
        new = (sum(under) / len(under), sum(over) / len(over))
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _gathered(own: dict[int, int], above: dict[int, int]) -> dict[int, int]:
    """Sums of ``own`` over each element and all below it; an element's number is larger than that above it."""
    total = dict(own)
    for n in sorted({*above, *own}, reverse=True):
        if n and total.get(n):
            total[above.get(n, 0)] = total.get(above.get(n, 0), 0) + total[n]
    return total


def _chain(n: int, above: dict[int, int]) -> list[int]:
    """n and what is above it, innermost first, 0 last."""
    out = [n]
    while n:
        n = above.get(n, 0)
        out.append(n)
    return out


def _inside(above: dict[int, int], tops: set[int]) -> dict[int, int]:
    """For each element the outermost of ``tops`` that it is or is in; 0 for none."""
    found = {0: 0}
    for n in sorted(above):
        found[n] = found[above[n]] or (n if n in tops else 0)
    return found


def outside_boilerplate(parser: Lines) -> list[Line]:
    """The lines under no marked element, but for those marked elements that hold the article: the article or
    main element with most text, one outside marked elements if there is such a one."""
    lines, above = parser.lines, parser.above
    letters: dict[int, int] = {}
    for line in lines:
        letters[line.held_by] = letters.get(line.held_by, 0) + len(line.text)
    size = _gathered(letters, above)
    best = max((n for n in parser.whole if size.get(n)), key=lambda n: (not parser.whole[n], size[n], -n), default=0)
    kept = set(_chain(parser.whole[best], parser.marked_above)) if best else {0}
    within = _inside(above, {best} if best else set())

    def free(allowed: set[int]) -> dict[int, bool]:
        """For each marked element whether it and all around it are allowed."""
        found = {0: True}
        for n in sorted(parser.marked_above):
            found[n] = n in allowed and found[parser.marked_above[n]]
        return found

    clear, maybe = free(kept), free(kept | parser.likely)
    found = [line for line in lines if (not best or within[line.held_by]) and maybe[line.marks]]
    if not all(clear[line.marks] for line in found):
        values = smoothed([len(line.text) / max(1, line.tags) for line in found])
        cut = threshold(values)
        held: dict[int, int] = {}
        for line, v in zip(found, values, strict=True):
            if v >= cut:
                held[line.marks] = held.get(line.marks, 0) + len(line.text)
        total = sum(held.values())
        clear = free(kept | {n for n, letters in _gathered(held, parser.marked_above).items() if letters >= ENOUGH * total})
    return [line for line in lines if clear[line.marks]]


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.read(html or "")
    lines, above = outside_boilerplate(parser), parser.above
    if not lines:
        return ""
    values = smoothed([len(line.text) / max(1, line.tags) for line in lines])
    cut = threshold(values)
    chosen = [v >= cut for v in values]
    depth = {0: 0}
    for n in sorted(above):
        depth[n] = depth[above[n]] + 1
    own: dict[int, int] = {}
    for line, is_chosen in zip(lines, chosen, strict=True):
        if is_chosen:
            own[line.held_by] = own.get(line.held_by, 0) + len(line.text)
    total = sum(own.values())
    votes = _gathered(own, above)
    # The innermost container with most of the selected text.
    region = max((n for n, size in votes.items() if size >= ENOUGH * total), key=lambda n: (depth[n], n))
    path = _chain(region, above)[::-1]  # from 0 to the region
    outer = _inside(above, set(parser.whole))
    if outer[region]:
        # Each outermost article or main element that holds selected text is text as a whole.
        taken = {outer[line.held_by] for line, is_chosen in zip(lines, chosen, strict=True) if is_chosen} - {0}
        return "\n".join(line.text for line in lines if outer[line.held_by] in taken)
    # Without one: the ancestor that holds all selected lines, links aside, and the headings before them.
    for i in range(len(lines) - 2, -1, -1):
        chosen[i] = chosen[i] or lines[i].heading and chosen[i + 1]
    # How far down the path an element's own path goes along with it.
    along = {0: 0}
    for n in sorted(above):
        along[n] = depth[n] if depth[n] < len(path) and path[depth[n]] == n else along[above[n]]
    place = min([depth[region], *(along[line.held_by] for line, is_chosen in zip(lines, chosen, strict=True) if is_chosen and 2 * line.linked <= len(line.text))])
    held = [i for i, line in enumerate(lines) if along[line.held_by] >= place]
    if place and len(held) == 1 and path[place] == lines[held[0]].held_by:
        place -= 1  # a container of a single block gives way to its parent
        held = [i for i, line in enumerate(lines) if along[line.held_by] >= place]
    # Containers of links that stand beside the voted one are no part of it.
    in_region, top = _inside(above, {region}), _inside(above, {n for n in above if above[n] == path[place]})
    beside = {i: top[lines[i].held_by] for i in held if not in_region[lines[i].held_by] and region and lines[i].held_by != path[place]}
    size: dict[int, int] = {}
    for i, n in beside.items():
        size[n] = size.get(n, 0) + len(lines[i].text) - 2 * lines[i].linked
    kept = [lines[i].text for i in held if i not in beside or size[beside[i]] >= 0]
    while len(kept) > 1 and _RIGHTS.match(kept[-1]):
        kept.pop()  # the page's last line, where no footer holds it
    return "\n".join(kept)


def text_of(html: Column) -> Column:
    """Main text of whole pages; '' for null and empty html, and where nothing is left."""

    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return F.pandas_udf(extract, "string")(html)


def report(pages: DataFrame) -> DataFrame:
    """The contract's rows, one for each row of ``pages``; repeated rows give the same text, no rows none.

    Style sheets are not read: text that only a style hides is text, while elements with ``hidden`` are not.
    """
    found = in_batches(pages).select("page_id", "url", text_of(F.col("html")).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
