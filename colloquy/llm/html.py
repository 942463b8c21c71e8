"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one a block, whose weight is their text length. Weights are summed over sliding windows of
lines; a run of windows with text is kept from the line where the sums surge to the line where they dive to nothing, if
it reaches the threshold; where none does, the heaviest run is kept. A shorter run stays if its paragraphs stand in an
element that holds paragraphs of a kept one.

Menus, headers, footers, sidebars, notices, adverts, forms and comments are told by density first: lines that are mostly
links weigh nothing outside of a marked article, and an element that its tag, role, class or id calls such a thing is
left out only if it is small for the text around it. One that holds more than WRAPPER times the text that no such
element holds, and that share of the largest one beside it, is a wrapper, whatever its name; so is an element in it that
holds all it does, and what else it holds is then looked at alike. An element around the page's
longest article is a wrapper too, and beside an article that has text only what has such a name is one, if it holds
WRAPPER times the threshold; what is mostly links, or reader comments, never is, unless it holds all there is.

Where a page marks an article, lines within and without are two sequences, and sums are multiplied by their side's share
of the page's text, that within counting MARKED times: a small marked card doesn't outweigh the text around it.

Class and id names count as whole names, or by the first or last part of a compound (reader-comments) unless it tells
of a state (has-sidebar) or of an article's own head (entry-header); not on paragraphs, headings and the like of an
article.

Defined results: null html is empty html; a page without text has empty text; html that is cut or badly nested is read as
far as it goes. Equal pages have equal texts; a column that has the name of the new one is replaced by it, any others
stay; an empty table gives an empty one. Each page is worked on alone, in time linear in its length and the depth of
wrappers.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW, SURGE, MARKED, WRAPPER = 3, 86, 3, 3

# Element and attribute names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|textarea|select|title"
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img".split())
ASIDE = set("nav header footer aside form button dialog menu head".split())
ASIDE_NAMES = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended share sharing social cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup login popup modal overlay comment comments respond disqus pagination pager tags toolbar copyright".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
STATES = set("has have with without no not is are show shows hide hides enable enabled disable disabled".split())
TEXT_TAGS = set("p h1 h2 h3 h4 h5 h6 blockquote li dt dd pre td th figure figcaption".split())
COMMENT_NAMES = set("comment comments respond disqus".split())
HEADS = set("entry post article story content page title".split())

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<({RAW})(?![\w-])[^>]*(?<!/)>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S | re.I)
_SHUT = re.compile(r"(?:^|[\s\"'])/$")  # <x/>, but not <a href=/>
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


PLAIN, BY_NAME, BY_TAG, COMMENTS = 0, 1, 2, 3


def named(names: list[str], among: set[str]) -> bool:
    """Whether a class or id is one of the names, or a compound that begins or ends with one and tells of no state."""
    for name in names:
        parts = [x for x in re.split("[_-]+", name) if x]
        if len(parts) > 1 and parts[0] in HEADS and parts[-1] == "header":
            continue
        if parts and parts[0] not in STATES and (parts[0] in among or parts[-1] in among):
            return True
    return False


def kind_of(tag: str, attrs: str, in_main: bool) -> tuple[int, bool]:
    """What an element's tag, role, class and id call it, and whether they mark an article."""
    found = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTR.findall(attrs)} if attrs else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    if tag in ("html", "body"):
        return PLAIN, False
    if named(names, COMMENT_NAMES) and not (in_main and tag in TEXT_TAGS):
        return COMMENTS, False
    if tag in ("article", "main") or found.get("role") == "main":
        return PLAIN, True
    if tag in ASIDE and not (tag == "header" and in_main) or found.get("role") in ASIDE_ROLES:
        return BY_TAG, False
    among = ASIDE_NAMES - {"header", "banner", "masthead"} if in_main else ASIDE_NAMES
    return BY_NAME if not (in_main and (tag == "header" or tag in TEXT_TAGS)) and named(names, among) else PLAIN, False


class Page:
    """Lines (text, characters in links, element) in page order, and elements (parent, kind, marks an article, tag)."""

    def __init__(self, page: str):
        self.lines: list[tuple[str, int, int]] = []
        self.parent, self.kind, self.marked, self.tag = [-1], [PLAIN], [False], [""]
        parts: list[str] = []
        linked = at = mains = links = 0
        stack, blocks, open_tags = [0], [0], {}  # inline elements hold no lines of their own

        def flush():
            nonlocal linked
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                self.lines.append((text, linked, blocks[-1]))
            parts.clear()
            linked = 0

        def add(text: str):
            nonlocal linked
            if text:
                parts.append(text)
                linked += len(text.strip()) if links else 0

        def close(e: int):
            nonlocal mains, links
            open_tags[self.tag[e]] -= 1
            if blocks[-1] == e:
                blocks.pop()
            mains -= self.marked[e]
            links -= self.tag[e] == "a"

        for m in _TOKEN.finditer(page):
            add(page[at : m.start()])
            at = m.end()
            tag = m[3] or m[6]
            if tag is None:
                if m[1] and m[1].lower() not in ("noscript", "svg", "math", "canvas"):
                    flush()
                continue
            tag, attrs, closing = tag.lower(), (m[4] if m[3] else m[7]) or "", bool(m[2] or m[5])
            if tag not in INLINE:
                flush()
            if closing:
                while open_tags.get(tag):
                    close(e := stack.pop())
                    if self.tag[e] == tag:
                        break
            elif tag not in VOID and not _SHUT.search(attrs):
                if tag == "body" and open_tags.get("head"):
                    while len(stack) > 1:
                        close(stack.pop())
                kind, marked = kind_of(tag, attrs, mains > 0)
                self.parent.append(stack[-1])
                self.kind.append(kind)
                self.marked.append(marked)
                self.tag.append(tag)
                stack.append(len(self.parent) - 1)
                if tag not in INLINE:
                    blocks.append(stack[-1])
                open_tags[tag] = open_tags.get(tag, 0) + 1
                mains, links = mains + marked, links + (tag == "a")
        add(page[at:])
        flush()

    def summed(self, own: list[int], barrier: list[bool] | None = None) -> list[int]:
        """Sums over each element and what is in it; what is behind a barrier counts for the barrier only."""
        out = list(own)
        for e in range(len(out) - 1, 0, -1):
            if not (barrier and barrier[e]):
                out[self.parent[e]] += out[e]
        return out

    def article(self) -> int:
        """The longest marked element that no comments or asides hold, or 0."""
        own = [0] * len(self.parent)
        for text, _, e in self.lines:
            own[e] += len(text)
        size = self.summed(own)
        aside = [False] * len(self.parent)
        for e in range(1, len(aside)):
            aside[e] = aside[self.parent[e]] or self.kind[e] != PLAIN
        # an article within something called an aside counts if no other does
        marked = [e for e in range(len(aside)) if self.marked[e]]
        free = [e for e in marked if not aside[e]] or marked
        return max(free, key=lambda e: (size[e], -e), default=0)

    def left_out(self, main: int, kinds: tuple[int, ...]) -> list[bool]:
        """Whether each line is none of the article's."""
        n = len(self.parent)
        own, own_links = [0] * n, [0] * n
        for text, linked, e in self.lines:
            own[e] += len(text)
            own_links[e] += linked
        size, links = self.summed(own), self.summed(own_links)
        called = [k in kinds for k in self.kind]
        inside = [False] * n
        for e in range(1, n):
            inside[e] = bool(main) and (e == main or inside[self.parent[e]])
        e = main
        while e > 0:  # around the article
            called[e], e = False, self.parent[e]
        while True:
            # text that nothing called an aside holds, on the whole and within the article
            bare = self.summed(own, called)
            shut, wrapper = [False] * n, [0] * n
            wide = {}
            for e in range(1, n):
                up = self.parent[e]
                shut[e] = shut[up] or called[e]
                if called[e] and not shut[up] and self.kind[e] != COMMENTS and 2 * links[e] <= size[e] and self.wraps(e, size[e], bare, main, inside[e]):
                    wide[e] = size[e]
            most = max(wide.values(), default=0)
            opened = []
            for e in range(1, n):
                up = wrapper[e] = wrapper[self.parent[e]]
                if called[e] and (WRAPPER * wide.get(e, 0) > most or up and size[e] == size[up] and self.kind[e] != COMMENTS):
                    wrapper[e] = e
                    opened.append(e)
            if not opened:
                return [shut[e] for _, _, e in self.lines]
            for e in opened:
                called[e] = False

    def wraps(self, e: int, size: int, bare: list[int], main: int, inside: bool) -> bool:
        """Whether what is called an aside holds so much that it is a wrapper; beside an article with text only long ones
        are, and by their names only."""
        if not main or inside or not bare[main]:
            return size > WRAPPER * bare[main if inside else 0]
        return self.kind[e] == BY_NAME and size > WRAPPER * max(SURGE, bare[0])


def distribution(weights: list[int], window: int = WINDOW) -> list[int]:
    """Sums of `window` weights from each line on."""
    sums, total = [0] * len(weights), 0
    for i in range(len(weights) - 1, -1, -1):
        total += weights[i] - (weights[i + window] if i + window < len(weights) else 0)
        sums[i] = total
    return sums


def runs(weights: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, highest sum) of each run of windows with text; surge and dive are its first and last such line."""
    sums, found, first = distribution(weights, window), [], None
    for i, s in enumerate([*sums, 0]):
        if s and first is None:
            first = i
        elif not s and first is not None:
            a = next(k for k in range(first, i) if weights[k])
            b = next(k for k in range(i - 1, first - 1, -1) if weights[k])
            found.append((a, b + 1, max(sums[first:i])))
            first = None
    return found


def extract(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of one page."""
    page = Page(page or "")
    lines, main = page.lines, page.article()
    for kinds in ((BY_NAME, BY_TAG, COMMENTS), (BY_TAG, COMMENTS), (COMMENTS,), ()):  # rather all there is than nothing
        aside = page.left_out(main, kinds)
        if not all(aside):
            break
    within = [False] * len(page.parent)
    for e in range(1, len(within)):
        within[e] = page.marked[e] or within[page.parent[e]]
    sides: list[list[int]] = [[], []]
    weights = [0] * len(lines)
    for i, (text, linked, e) in enumerate(lines):
        if not within[e] or not aside[i]:
            sides[within[e]].append(i)
            weights[i] = 0 if not within[e] and (aside[i] or 2 * linked > len(text)) else len(text)
    mass = [sum(weights[i] for i in side) * (MARKED if k else 1) for k, side in enumerate(sides)]
    every = [(k, [i for i in side[a:b] if weights[i]], high * mass[k] / sum(mass)) for k, side in enumerate(sides) for a, b, high in runs([weights[i] for i in side], window)]
    kept = [r for r in every if r[2] >= surge] or ([max(every, key=lambda r: r[2] * (MARKED if r[0] else 1))] if every else [])
    box = lambda i: page.parent[lines[i][2]] if page.tag[lines[i][2]] in TEXT_TAGS else None
    boxes = {(k, box(i)) for k, run, _ in kept for i in run} - {(0, None), (1, None)}
    kept = [i for k, run, high in every for i in run if (k, run, high) in kept or (k, box(i)) in boxes]
    return " ".join(lines[i][0] for i in sorted(kept))


def main_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Add a column with each page's main text."""
    from pyspark.sql import types as T

    pages = pages.drop(*[c for c in (out,) if c != html])
    schema = T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())])

    def work(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                yield part.append_column(out, pa.array([extract(x) for x in part.column(html).to_pylist()], pa.string()))

    return pages.mapInArrow(work, schema)


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_text(pages).selectExpr("page_id", "url", "text", "cast(length(text) as long) AS n_chars")
