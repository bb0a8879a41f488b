"""Main text of HTML pages by the distribution of text over lines.

Markup is stripped into lines: a block element or line break ends a line. Elements that say by their name, role, class
or id that they are menus, adverts, forms and the like are set apart, unless they hold nearly all of the text; an `article` or `main`
in them counts again. Other lines weigh as many characters as they have outside links; a line that is mostly links weighs nothing.
The weights are summed over a window of `WINDOW` lines. Text surges where the sum rises above the threshold, back to where it last
was 0, and dives where it falls to 0. The main text is what lies between, but for longer runs of links. An `article` or `main`
is text from its first line with weight to its last, links between included; fewer than `WINDOW` lines of links in a row, as headlines are, weigh too, and so do
links with some text beside them, as references are. The lines outside keep their weights, so a page whose articles are
teasers gives its body as well, unless the marked elements hold most of the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

WINDOW = 3
SURGE = 80  # characters in a window; half of the fullest window, if that is less

_words = lambda text: frozenset(text.split())
VOID = _words("area base br col embed hr img input link meta param source track wbr")
INLINE = _words(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter q s samp small span strike "
    "strong sub sup time tt u var wbr object math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder "
    "mover munderover mmultiscripts mtable mtr mtd mstyle mpadded mphantom menclose merror semantics annotation annotation-xml"
)
RAW = _words("script style noscript template iframe svg title textarea select canvas noframes noembed xmp annotation annotation-xml")
APART = _words("head nav footer aside form button dialog menu fieldset")  # never main text
MARKED = _words("article main")
SIGNS = _words(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner cookie cookies consent gdpr notice popup "
    "overlay modal newsletter subscribe subscription signup login sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer comment comments commentlist disqus reply replies respond share sharing social related recommended widget toolbar "
    "pagination pager masthead topbar copyright disclaimer alert complementary contentinfo search"
)
#: A class, id or role is a sign if each of its parts is a sign, or a place before or a part after one: site-footer, share-buttons.
PLACES = _words("site page main global top bottom left right primary secondary mobile desktop post entry article blog wp c l o js")
PIECES = _words(
    "left right top bottom primary secondary main box bar list item items link links button buttons icon icons block area section "
    "container wrapper wrap inner outer panel content form field input posts articles stories media slot unit group row col text title "
    "heading body card cards tabs toggle message info policy inline"
)
LEADING = _words("sidebar footer nav navbar breadcrumb breadcrumbs cookie cookies advert advertisement masthead topbar pagination")  # of a class
STATES = _words("open opened active visible shown enabled disabled collapsed expanded closed hidden fixed layout free")
MODIFIERS = _words("has no non not with without is hide")
TALK = _words("comment comments commentlist disqus reply replies respond")
#: Words that an article may use for its own sections and boxes.
OWN = _words("alert notice disclaimer copyright search banner overlay modal menu promo promotion widget toolbar popup")
#: A class, id or role that ends with one of these is a sign, whatever it begins with: reader-comments, google-ads.
ENDING = TALK | _words("ad ads advert adverts advertisement advertising sponsored newsletter cookie cookies social sharing related recommended")
ADVERTS = re.compile(r"(?:ads?|adverts?)(?:sense|banner|" + "|".join(sorted(PIECES)) + r")$")
HEADINGS = _words("h1 h2 h3 h4 h5 h6")
BY_SIGN, BY_NAME, NEVER = 1, 2, 3  # why an element is apart: only the first two may hold an article or be the text of a page
UNCLOSED = ("nav", "header", "form")
#: Elements that a start tag of one of a group ends, up to the element that may hold them.
ENDS = {name: (group, _words(holder)) for group, holder in (
    (_words("li"), "ul ol menu dir"), (_words("dt dd"), "dl"), (_words("td th"), "tr table"), (_words("tr"), "table tbody thead tfoot"),
    (_words("option"), "select datalist optgroup"),
) for name in group}
LISTS = ("ul", "ol", "menu", "dir")
NESTED = 1 / 10  # of all text must stand outside what is set apart, if no article does

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_REST = re.compile(r"(?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+>")
_SIGN = re.compile(r"(?<![a-zA-Z-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@lru_cache(1 << 14)
def _sign(name: str, kind: str) -> str:
    """The word by which a class, id or role is a sign; empty if it is none."""
    parts = _PARTS.findall(_CAMEL.sub(" ", name).lower())
    whole = "".join(parts)
    if whole in SIGNS or whole == "header":
        return whole
    if any(ADVERTS.match(part) for part in parts):
        return "ads"
    last = [part for part in parts if part not in PIECES and not part.isdigit() and len(part) > 1]
    if last and last[-1] in ENDING and MODIFIERS.isdisjoint(parts) and parts[-1] not in STATES:
        return last[-1]
    at = 0
    while at < len(parts) - 1 and parts[at] in PLACES:
        at += 1
    rest = parts[at:]
    if not rest or not (rest[0] in SIGNS or rest[0] == "header") or rest[-1] in STATES or not MODIFIERS.isdisjoint(rest):
        return ""
    if (kind == "class" and rest[0] in LEADING) or all(p in SIGNS or p in PIECES or p.isdigit() or len(p) == 1 for p in rest[1:]):
        return rest[0]
    return ""


def _signs(attributes: str, marked: bool) -> set[str]:
    """The signs of an element. In an article, an id is the address of a section and says less than a class."""
    out = set()
    for m in _SIGN.finditer(attributes):
        kind = m[1].lower()
        for name in (m[2] or m[3] or m[4] or "").split():
            sign = _sign(name, kind)
            if sign and not (marked and (sign in OWN or (kind == "id" and sign not in LEADING and sign not in TALK))):
                out.add(sign)
    return out


class _Lines:
    """The lines of a page: text, characters outside links, whether in a marked element, why they are apart (0: not)."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool, int]] = []
        self.parts: list[str] = []
        self.free = 0
        self.open: list[tuple[str, int, bool]] = []  # block elements: name, apart, marked (of it or one around it)
        self.count: Counter[str] = Counter()  # of open elements by name
        self.link = False

    def text(self, raw: str) -> None:
        if self.open and self.open[-1][1] == NEVER:
            return
        text = html.unescape(raw)
        self.parts.append(text)
        if not self.link:
            self.free += len(text.strip())

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                apart, marked = self.open[-1][1:] if self.open else (0, False)
                self.lines.append((text, self.free, marked, apart))
            self.parts, self.free = [], 0

    def start(self, name: str, attributes: str) -> None:
        if name in INLINE:
            self.link |= name == "a"
            return
        self.flush()
        if name in VOID:
            return
        self.link = False
        if self.open and self.open[-1][0] == "p":  # no block stands in a paragraph
            self._pop()
        if name in ENDS:
            group, holders = ENDS[name]
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in group:
                    while len(self.open) > i:
                        self._pop()
                    break
                if self.open[i][0] in holders or i < len(self.open) - 8:
                    break
        elif self.open and self.open[-1][0] == "li" and self.open[-1][1] and not any(self.count[x] for x in LISTS):
            self._pop()  # a list item outside of a list that was never closed
        if name in MARKED:  # a menu, header or form that was never closed does not hold the article
            while any(self.count[x] for x in UNCLOSED):
                self._pop()
        apart, marked = self.open[-1][1:] if self.open else (0, False)
        if name in MARKED:
            signs = _signs(attributes, False) if attributes else set()
            apart = NEVER if apart == NEVER or not signs.isdisjoint(TALK) else 0
        elif apart != NEVER and name not in ("html", "body"):
            signs = _signs(attributes, marked) if attributes and name not in HEADINGS else set()
            if name == "head" or not signs.isdisjoint(TALK) or (attributes and _HIDDEN.search(attributes)):
                apart = NEVER
            elif not apart:
                header = not marked and (name == "header" or "header" in signs)  # in an article it holds the headline
                apart = BY_NAME if name in APART or name == "header" and header else BY_SIGN if header or signs - {"header"} else 0
        self.open.append((name, apart, not apart and (marked or name in MARKED)))
        self.count[name] += 1

    def _pop(self) -> None:
        self.count[self.open.pop()[0]] -= 1

    def end(self, name: str) -> None:
        if name in INLINE:
            self.link &= name != "a"
            return
        self.flush()
        while self.count[name]:
            if self.open[-1][0] == name:
                self._pop()
                return
            self._pop()


def lines(page: str) -> list[tuple[str, int, bool, int]]:
    """The lines of a page in order: (text, characters outside links, in a marked element, apart)."""
    out, at, quoted, ended = _Lines(), 0, True, set()
    while (tag := page.find("<", at)) >= 0:
        if tag > at:
            out.text(page[at:tag])
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        m = _NAME.match(page, tag)
        if m is None:
            if page[tag + 1 : tag + 2] in ("!", "?", "/"):
                end = page.find(">", tag)
                at = end + 1 if end >= 0 else len(page)
            else:
                out.text("<")
                at = tag + 1
            continue
        rest = _REST.match(page, m.end()) if quoted else None
        if rest is None:
            quoted = False  # a quote that never ends: from here on the next bracket ends a tag
            end = page.find(">", m.end())
            at = end + 1 if end >= 0 else len(page)
        else:
            at = rest.end()
        name = m[2].lower()
        if m[1]:
            out.end(name)
        elif name in RAW:
            if name not in ended:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                if close:
                    at = close.end()
                else:
                    ended.add(name)  # never closed from here on
                    at = len(page) if name in ("script", "style") else at
            if name not in INLINE:
                out.flush()
        else:
            out.start(name, page[m.end() : at - 1])
    out.text(page[at:])
    out.flush()
    return out.lines


def _weights(all_lines: list[tuple[str, int, bool]]) -> list[int]:
    """What each line weighs; in marked elements short runs of links weigh as text, and so do links with some text."""
    out, run = [], 0  # run: lines of links up to here
    for i, (text, free, marked) in enumerate(all_lines):
        out.append(free if (10 if marked else 2) * free >= len(text) else 0)
        run = run + 1 if marked and not out[-1] else 0
        following = all_lines[i + 1] if i + 1 < len(all_lines) else ("", 0, False)
        if 0 < run < WINDOW and not (following[2] and 10 * following[1] < len(following[0])):
            out[i + 1 - run :] = [len(t) for t, _, _ in all_lines[i + 1 - run : i + 1]]
    return out


def main_text(page: str | None) -> str:
    """The main text; empty if there is none. What is set apart counts if an article is in it, or if it holds nearly all of the text."""
    all_lines = lines(page) if page else []
    weight = [0, 0, 0]
    for text, free, marked, apart in all_lines:
        if apart < NEVER and 2 * free >= len(text):
            weight[apart] += free
        if marked and not apart:
            return _text([line[:3] for line in all_lines if not line[3]]) or _text([line[:3] for line in all_lines if line[3] <= BY_NAME])
    level = next((k for k in (0, BY_SIGN) if sum(weight[: k + 1]) > NESTED * sum(weight)), BY_NAME)
    for most in range(level, NEVER):
        if text := _text([line[:3] for line in all_lines if line[3] <= most]):
            return text
    return ""


def _text(all_lines: list[tuple[str, int, bool]]) -> str:
    """The lines between surges and dives, joined by spaces."""
    weight = _weights(all_lines)
    of_marked = sum(w for w, line in zip(weight, all_lines) if line[2])
    if 2 * of_marked >= sum(weight) > 0:  # what stands outside are notices
        all_lines, weight = [line for line in all_lines if line[2]], [w for w, line in zip(weight, all_lines) if line[2]]
    if not all_lines:
        return ""
    sums = np.convolve(weight, np.ones(WINDOW, np.int64))[WINDOW - 1 :].tolist()  # of a line and the next ones
    surge = min(SURGE, max(sums) / 2)
    keep, start = [], 0
    while start < len(all_lines):
        # from here to the next dive, or to the end or begin of a marked element
        marked, end = all_lines[start][2], start
        while end < len(all_lines) and (marked or sums[end] > 0) and all_lines[end][2] == marked:
            end += 1
        if any(total > (0 if marked else surge) for total in sums[start:end]):
            some = [i for i in range(start, end) if weight[i]]
            for before, i in zip([None, *some], some):
                # links between two lines of text are a part of them
                if before is not None and (marked or i - before <= WINDOW):
                    keep += [all_lines[k][0] for k in range(before + 1, i)]
                keep.append(all_lines[i][0])
        start = max(end, start + 1)
    return " ".join(keep)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(row, main_text) of every page: its columns, whatever their names, and its main text.

    Null, empty and blank html gives an empty text, repeated rows a text each, an empty table no rows. A page of any length is read
    once from its begin to its end; it must fit into a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            at = rows.type.get_field_index(html_col)
            for start in range(0, len(rows), 256):
                part = rows.slice(start, 256)
                texts = [main_text(t) for t in part.flatten()[at].to_pylist()]
                yield pa.RecordBatch.from_arrays([part, pa.array(texts, pa.string())], ["row", "main_text"])

    rows = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("row"))
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("main_text", T.StringType())]))
