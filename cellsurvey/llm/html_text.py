"""Main text of web pages by composite text density.

A page becomes a tree. Of every node the characters, tags, characters in links and link tags below it give its density, the
characters per tag adjusted for links. The node whose children have the largest sum of densities is the core of the article;
the least density on the path from the body to the core is the threshold that other parts have to reach to be taken as well.
Elements that say what they are (menus, forms, adverts, comments...) are taken out before anything is counted.

A page is one row and is handled where it lies, so the job is a narrow map over the table.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cellsurvey.llm.common import own_columns, slices

_TEXTS = "page_id bigint, url string, text string, n_chars bigint"

# a comment, a declaration, or a tag; an attribute value in quotes may hold ">"
_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

_names = lambda s: frozenset(s.split())
_VOID = _names("area base br col embed hr img input link meta param source track wbr")
_RAW = _names("script style textarea title xmp noembed noframes iframe plaintext")  # their content is no markup
_INLINE = _names("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong "
                 "sub sup time tt u var wbr br img input select option optgroup button picture source audio video canvas map object embed param")
_NO_TEXT = _names("head script style textarea title noscript template iframe object embed svg math canvas audio video map select option datalist "
                  "button input form fieldset nav menu aside footer dialog xmp noembed noframes plaintext")
_ENDS_BY = {  # an open element that ends where one of the named ones begins, and what it is not looked for beyond
    "li": (_names("li"), _names("ul ol menu")), "dt": (_names("dt dd"), _names("dl")), "dd": (_names("dt dd"), _names("dl")),
    "tr": (_names("tr td th"), _names("table")), "td": (_names("td th"), _names("tr table")), "th": (_names("td th"), _names("tr table")),
    "tbody": (_names("thead tbody tfoot tr td th caption"), _names("table")), "tfoot": (_names("thead tbody tr td th caption"), _names("table")),
    "option": (_names("option"), _names("select")), "body": (_names("head"), _names("html")),
}
_IN_HEAD = _names("html head meta title link base style script noscript template")
_P_STOPS = _names("td th caption button object table body html")
_NOISE_ROLES = _names("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist feed")
# words of class names and ids that say what an element is for
_NOISE_WORDS = _names(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside widget widgets ad ads adv advert adverts advertisement advertising "
    "sponsor sponsored sponsors promo promos promotion cookie cookies consent gdpr notice notices popup popover modal overlay newsletter subscribe "
    "subscription signup login paywall share sharing social related recommended recommendations comment comments commentlist disqus respond replies "
    "pagination pager toolbar masthead topbar skip footer footnav sitemap copyright legal banner banners alert alerts toast disclaimer hidden")
_STRONG_WORDS = _names("comment comments commentlist disqus respond replies")  # also on an article element
_STATES = _names("has have is with no open closed enabled disabled on off allow without")  # class names like "has-sidebar" tell about others
_HEADERS = _names("header heading masthead")
_PAGE_WORDS = _names("site page main global top wrapper container inner nav area outer region bar wrap fixed sticky")
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_HEADINGS = _names("h1 h2 h3 h4 h5 h6")
_TEXT_BLOCKS = _HEADINGS | _names("p blockquote pre ul ol dl table figure")


class Page:
    """The tree of a page in page order: a parent always comes before its children."""

    def __init__(self, source: str):
        self.tags: list[str] = ["html"]
        self.parents: list[int] = [-1]
        self.noise: list[bool] = [False]
        self.pieces: list[tuple[int, str | None]] = []  # (node, text), or (node, None) where a block begins or ends
        self._open, self._n_open = [0], Counter()  # the open nodes, and how many there are of each tag
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = _MARKUP.search(source, at)
            if found is None:
                self._text(source[at:])
                return
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            name = found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                self._close(name)
                continue
            self._begin(name, found[3])
            if name in _RAW:
                over = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = over.end() if over else end
                self._close(name)
            elif name in _VOID:
                self._close(name)

    def _text(self, text: str) -> None:
        self.pieces.append((self._open[-1], html.unescape(text) if "&" in text else text))

    def _pop_to(self, depth: int) -> None:
        while len(self._open) > depth:
            node = self._open.pop()
            self._n_open[self.tags[node]] -= 1
            if self.tags[node] not in _INLINE:
                self.pieces.append((node, None))

    def _end_open(self, names: frozenset[str], stops: frozenset[str]) -> None:
        if not any(self._n_open[name] for name in names):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag in names:
                self._pop_to(depth)
            elif tag in stops:
                return

    def _begin(self, name: str, attributes: str) -> None:
        if name == "html":
            return
        if name not in _INLINE:
            self._end_open(frozenset(("p",)), _P_STOPS)
            if name in _HEADINGS and self.tags[self._open[-1]] in _HEADINGS:
                self._pop_to(len(self._open) - 1)
        if name in _ENDS_BY:
            self._end_open(*_ENDS_BY[name])
        if self.tags[self._open[-1]] == "head" and name not in _IN_HEAD:
            self._pop_to(len(self._open) - 1)
        if name == "a":  # links do not nest
            self._end_open(frozenset(("a",)), _P_STOPS | _TEXT_BLOCKS)
        parent, node = self._open[-1], len(self.tags)
        self.tags.append(name)
        self.parents.append(parent)
        self.noise.append(self.noise[parent] or self._is_noise(name, attributes, parent))
        if name not in _INLINE:
            self.pieces.append((node, None))
        elif name == "br":
            self.pieces.append((node, " "))
        self._open.append(node)
        self._n_open[name] += 1

    def _close(self, name: str) -> None:
        inline = name in _INLINE
        if not self._n_open[name]:
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag == name:
                self._pop_to(depth)
                return
            if inline and tag not in _INLINE or tag in ("td", "th") and name not in ("tr", "table", "tbody", "thead", "tfoot"):
                return  # the end of an element that is not open here

    def _inside(self, node: int, names: tuple[str, ...]) -> bool:
        while node >= 0:
            if self.tags[node] in names:
                return True
            node = self.parents[node]
        return False

    def _is_noise(self, name: str, attributes: str, parent: int) -> bool:
        if name == "footer":
            return not self._inside(parent, ("blockquote", "figure"))
        if name in _NO_TEXT:
            return True
        if name == "header":
            return not self._inside(parent, ("article", "main"))
        if not attributes or name in ("body", "main"):
            return False
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        if "hidden" in values or values.get("aria-hidden") == "true" or _HIDDEN.search(values.get("style", "")):
            return True
        if values.get("role", "").lower() in _NOISE_ROLES:
            return True
        if name in _INLINE:
            return False
        for label in (values.get("class", "") + " " + values.get("id", "")).split():
            words = {w.lower() for w in _WORD.findall(label)}
            if words & _STATES and name not in ("div", "section") or "article" in words and not words & _STRONG_WORDS and "footer" not in words:
                continue
            if name == "article":
                if words & _STRONG_WORDS:
                    return True
            elif words & _NOISE_WORDS and not words & _STATES:
                return True
            elif words & _HEADERS and words <= _HEADERS | _PAGE_WORDS and not self._inside(parent, ("article", "main")):
                return name not in _HEADINGS
        return False


def _densities(page: Page, own: list[int]) -> tuple[list[float], list[float], list[int], list[int], list[int]]:
    """Composite density and sum of the children's densities of every node; characters, link characters and links below it."""
    n = len(page.tags)
    chars, tags, in_links, links = own[:], [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        if page.tags[i] == "a":
            in_links[i], links[i] = chars[i], links[i] + 1
        if not page.noise[i]:
            p = page.parents[i]
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            in_links[p] += in_links[i]
            links[p] += links[i]
    share = in_links[0] / max(chars[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        if page.noise[i] or not chars[i]:
            continue
        per_tag = chars[i] / max(tags[i], 1)
        base = math.log(chars[i] / max(chars[i] - in_links[i], 1) * in_links[i] + share * chars[i] + math.e)
        adjust = math.log(max(chars[i] / max(in_links[i], 1) * max(tags[i], 1) / max(links[i], 1), 1.0)) / math.log(max(base, math.e))
        density[i] = per_tag * adjust
        if i:
            sums[page.parents[i]] += density[i]
    return density, sums, chars, in_links, links


def main_text(source: str | None) -> str:
    """The article of a page: blocks in page order, one to a line. NULL, empty pages and pages without text give ''."""
    if not source:
        return ""
    page = Page(source)
    n = len(page.tags)
    own = [0] * n
    for node, text in page.pieces:
        if text:
            own[node] += len(text) - text.count(" ")
    density, sums, chars, in_links, links = _densities(page, own)
    for i in range(1, n):  # lists of links only are menus
        p = page.parents[i]
        if page.noise[p] or page.tags[i] in ("ul", "ol", "div") and links[i] >= 3 and in_links[i] >= 0.9 * chars[i]:
            page.noise[i] = True
    if any(page.noise):
        density, sums, chars, in_links, links = _densities(page, [0 if page.noise[i] else c for i, c in enumerate(own)])
    best = max(range(n), key=lambda i: (sums[i], chars[i], -i))
    if not chars[0]:
        return ""
    path = [best]
    while path[-1]:
        path.append(page.parents[path[-1]])
    scope = next((i for i in path if page.tags[i] == "article"), None) or next((i for i in path if page.tags[i] == "main"), None)
    if not sums[best]:
        best = scope = 0  # text without any element
    taken = [False] * n
    if scope is not None:
        taken[scope] = True
    else:
        taken[best] = True
        least = min((density[i] for i in path if page.tags[i] != "html" or len(path) == 1), default=0.0)
        on_path = set(path)
        for i in range(1, n):  # what hangs beside the path is taken if it is dense enough and made of text blocks
            p = page.parents[i]
            if p in on_path and i not in on_path and p != best and density[i] >= least and (sums[i] > 0 or page.tags[i] in _TEXT_BLOCKS or page.tags[p] not in ("body", "html")):
                taken[i] = True
    for i in range(1, n):
        taken[i] = (taken[i] or taken[page.parents[i]]) and not page.noise[i]
    if not any(taken[i] and page.tags[i] == "h1" for i in range(n)):
        first = next((i for i in range(n) if taken[i]), n)
        title = max((i for i in range(first) if page.tags[i] == "h1" and not page.noise[i] and chars[i]), default=None)
        if title is not None:
            for i in range(title, first):
                taken[i] = taken[i] or i == title or taken[page.parents[i]] and page.parents[i] >= title
    blocks, block = [], []
    for node, text in page.pieces:
        if text is None:
            if block:
                blocks.append(block)
                block = []
        elif taken[node]:
            block.append(text)
    blocks.append(block)
    return "\n".join(line for line in (" ".join("".join(b).split()) for b in blocks) if line)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 64):
        texts = [main_text(source) for source in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html); repeated rows and NULL ids are kept as they are.

    ``n_chars`` counts code points. Other columns are not read, so their names do not matter.
    """
    return own_columns(pages, "page_id", "url", "html").selectExpr("cast(page_id as bigint) page_id", "url", "html").mapInArrow(_extract, _TEXTS)
