"""Main text of web pages by composite text density.

A page becomes a tree of elements. Elements that hold no article by what they are (menus, page headers and footers,
sidebars, notices, adverts, forms, scripts, reader comments) are cut off first. For each node of the rest the density is its
characters per tag, lowered where the characters stand in links; the sum of its children's densities says how much of an
article it holds together. The node with the greatest sum leads: the lowest density on its way up to the body is the
threshold, and below each node that reaches it the subtree with the greatest sum is taken. A subtree inside an article
or main element is widened to that element.

Elements that only a class or id tells to be unwanted may hold the article all the same. The densities decide: with each
such element taken by itself, the one that holds the greatest sum of all, if any, stays with those around it, and all
others go. Readers' comments lead only where nothing else has text, and what lies apart from an article (or main) element
goes.

Pages are read in one sweep that looks ahead no character twice, however broken the markup is.

Defined cases: a null, empty or textless page gives an empty text; broken and unclosed markup is closed the way
browsers do for the usual cases; nesting may be of any depth and a page of any length, in time that grows with its length;
repeated rows are extracted each. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul caption".split()
)
#: An opening tag ends an open element of these kinds, unless one of the barriers lies between.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
ENDS |= {"tr": ("tr", "td", "th"), "option": ("option",), "body": ("head",)}
BARRIER = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "td": ("table",), "th": ("table",)}
BARRIER |= {"tr": ("table",), "option": ("select",), "body": ()}
CLOSE_P = BLOCK - {"body", "head", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
P_BARRIER = frozenset("button table td th caption html".split())
DROP = frozenset(
    "head script style noscript template nav footer aside form button select textarea iframe object svg canvas dialog "
    "menu".split()
)
DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr notice alert popup modal "
    "overlay newsletter subscribe signup login search share sharing social related recommended pagination pager comment "
    "comments respond disqus widget toolbar".split()
)
COMMENT_NAMES = frozenset("comment comments respond disqus".split())
ARTICLE_DROP_NAMES = frozenset("comment comments ad advert sponsored promo".split())
#: Words that may stand beside such a name in a class ("main-nav"); beside any other ("has-sidebar") it names something else.
BESIDE = frozenset("site main global top bottom left right primary secondary bar list area body container wrapper links".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
KEEP = frozenset("html body main".split())

NAME_END, SPECIAL = re.compile(r"[\s/>]"), re.compile("[>\"']")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")
PARTS = re.compile(r"[^\W_]+")


def _named(token: str, names: frozenset[str]) -> bool:
    """Whether a class or id is one of the names as a whole, beside numbers and words of place at most."""
    parts = [p.strip("0123456789") for p in PARTS.findall(token) if not p[0].isdigit()]
    return any(p in names for p in parts) and all(p in names or p in BESIDE for p in parts)


class Tree:
    """Elements in page order (a parent comes before its children) and the page's texts with the breaks between blocks."""

    def __init__(self, page: str):
        self.tag, self.parent, self.dropped = ["#root"], [-1], [False]
        self._by_name: dict[int, bool] = {}  # elements told by a class or id: whether they hold readers' comments
        self.events: list[tuple[int, str | None]] = []
        #: Open elements; of each name, and of all blocks, the places among them.
        self._open, self._places, self._blocks = [0], {}, [0]
        self._read(page)
        if self._by_name:
            self._drop_by_name()

    def _push(self, name: str, attributes: str) -> int:
        node, up = len(self.tag), self._open[-1]
        self.tag.append(name)
        self.parent.append(up)
        self.dropped.append(self.dropped[up] or self._unwanted(name, attributes))
        if attributes and not self.dropped[node] and name not in KEEP:
            comments = self._named(name, attributes)
            if comments is not None:
                self._by_name[node] = comments
        self._places.setdefault(name, []).append(len(self._open))
        if name in BLOCK:
            self._blocks.append(len(self._open))
        self._open.append(node)
        return node

    def _pop(self) -> None:
        node = self._open.pop()
        self._places[self.tag[node]].pop()
        if self.tag[node] in BLOCK:
            self._blocks.pop()
            self.events.append((node, None))

    def _last(self, names: tuple[str, ...] | frozenset) -> int:
        """The place of the innermost open element of these names; 0 if there is none."""
        return max((self._places[x][-1] for x in names if self._places.get(x)), default=0)

    def _unwanted(self, name: str, attributes: str) -> bool:
        inside = self._places.get("article") or self._places.get("main")
        if name in DROP or name == "header" and not inside:
            return True
        if name in KEEP or not attributes:
            return False
        return any(
            kind.lower() == "role" and not DROP_ROLES.isdisjoint(WORD.findall((a or b or c).lower()))
            for kind, a, b, c in ATTRIBUTE.findall(attributes)
        )

    def _named(self, name: str, attributes: str) -> bool | None:
        """Whether an element that its class or id tells to be unwanted holds readers' comments; else None."""
        inside = self._places.get("article") or self._places.get("main")
        names = ARTICLE_DROP_NAMES if name == "article" else DROP_NAMES - {"header"} if inside else DROP_NAMES
        tokens = [
            t for kind, a, b, c in ATTRIBUTE.findall(attributes) if kind.lower() != "role" for t in (a or b or c).lower().split()
        ]
        if not any(_named(t, names) for t in tokens):
            return None
        return any(_named(t, COMMENT_NAMES) for t in tokens)

    def _drop_by_name(self) -> None:
        """Keep the element told by its name that the densities choose, if any, and those around it; drop the others."""
        n = len(self.tag)
        chars = [0] * n
        for node, text in self.events:
            if text and not self.dropped[node]:
                chars[node] += len(text) - text.count(" ") - text.count("\n")
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
        kind = next((t for t in ("article", "main") if any(c and x == t for c, x in zip(chars, self.tag))), None)
        within = [False] * n
        for i in range(1, n):
            within[i] = within[self.parent[i]] or self.tag[i] == kind
        told = [0] * n  # characters in elements of that kind
        for i in range(n - 1, 0, -1):
            told[i] = chars[i] if within[i] else told[i]
            if not (within[i] and within[self.parent[i]]):
                told[self.parent[i]] += told[i]
        for i in range(1, n):
            up = self.parent[i]
            self.dropped[i] |= self.dropped[up] or i in self._by_name and not within[up] and told[0] > told[i]

        left = {i: comments for i, comments in self._by_name.items() if not self.dropped[i]}
        _, total, own = _measured(self, left)
        part, comments = [0] * n, [False] * n  # the innermost such element around each node; whether comments are around it
        best: dict[int, tuple[bool, float, int]] = {}
        for i in range(n):
            up = self.parent[i]
            part[i] = i if i in left else part[up] if i else 0
            comments[i] = i > 0 and comments[up] or left.get(i, False)
            if not self.dropped[i] and own[i]:
                size = (not comments[i], total[i], own[i])
                best[part[i]] = max(best.get(part[i], size), size)
        leads = max(best, key=best.__getitem__, default=0)
        stay = set()
        while leads:
            stay.add(leads)
            leads = part[self.parent[leads]]
        for i in range(1, n):
            self.dropped[i] |= self.dropped[self.parent[i]] or i in left and i not in stay

    def _up_to(self, names: tuple[str, ...] | frozenset, barrier: tuple[str, ...] | frozenset) -> None:
        """End the innermost open element of these names, unless a barrier is further in."""
        place = self._last(names)
        if place > self._last(barrier):
            while len(self._open) > place:
                self._pop()

    def _end(self, name: str) -> None:
        place = self._last((name,))
        if not place or name not in BLOCK and self._blocks[-1] > place:
            return  # an inline end tag does not end blocks
        while len(self._open) > place:
            self._pop()

    def _text(self, raw: str) -> None:
        if raw:
            self.events.append((self._open[-1], html.unescape(raw) if "&" in raw else raw))

    def _read(self, page: str) -> None:
        at, tags = 0, _Tags(page)
        for start, stop, name, attributes, is_end in tags:
            self._text(page[at:start])
            at = stop
            if name is None:
                if page.startswith("<![CDATA[", start):
                    self._text(page[start + 9 : stop].removesuffix("]]>"))
                continue
            if is_end:
                if name == "br":
                    self._text(" ")
                elif name != "body" and name != "html":
                    self._end(name)
                continue
            if name in CLOSE_P and self._places.get("p"):
                self._up_to(("p",), P_BARRIER)
            if name in ENDS:
                self._up_to(ENDS[name], BARRIER[name])
            if name in VOID:
                if name == "hr":
                    self.events.append((self._open[-1], None))
                elif name == "br":
                    self._text(" ")
                continue
            node = self._push(name, attributes)
            if name in BLOCK:
                self.events.append((node, None))
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}[^>]*>?", re.I).search(page, at)
                if name == "textarea" or name == "title":
                    self._text(page[at : end.start() if end else len(page)])
                at = tags.at = end.end() if end else len(page)
                self._pop()
        self._text(page[at:])
        while len(self._open) > 1:
            self._pop()


class _Tags:
    """The tags, comments and declarations of a page: (start, stop, name or None, attributes, whether it ends an element).

    A tag ends at the first ``>`` outside quotes; a ``<`` without one is text. What was found ahead is remembered: the next
    character that may end a name, the next that matters in attributes, and for each quote where its tag ends.
    """

    def __init__(self, page: str):
        self.page, self.at = page, 0
        self._next = {NAME_END: -1, SPECIAL: -1}
        self._last = {c: page.rfind(c) for c in "\"'>"}
        self._stops: dict[int, int] = {}

    def __iter__(self):
        page = self.page
        while (start := page.find("<", self.at)) >= 0:
            self.at = start + 1
            is_end = page.startswith("/", start + 1)
            first = page[start + 1 + is_end : start + 2 + is_end]
            if first.isascii() and first.isalpha():
                stop = self._ahead(NAME_END, start + 1 + is_end)
                end = self._stop(stop)
                if end >= 0:
                    self.at = end + 1
                    yield start, end + 1, page[start + 1 + is_end : stop].lower(), page[stop:end], is_end
            elif first and first in "!?" and not is_end:
                self.at = self._declared(start)
                yield start, self.at, None, "", False

    def _ahead(self, what: re.Pattern, at: int) -> int:
        """Where such a character comes next; callers only move on."""
        if self._next[what] < at:
            found = what.search(self.page, at)
            self._next[what] = found.start() if found else len(self.page)
        return self._next[what]

    def _stop(self, at: int) -> int:
        """The ``>`` that ends a tag whose attributes begin here; -1 if none does."""
        if at > self._last[">"]:
            return -1
        at, passed = self._ahead(SPECIAL, at), []
        while at < len(self.page) and self.page[at] != ">":
            if at in self._stops:
                at = self._stops[at]
                break
            passed.append(at)
            if at >= self._last[self.page[at]]:  # a quote that nothing closes
                at = -1
                break
            found = SPECIAL.search(self.page, self.page.find(self.page[at], at + 1) + 1)
            at = found.start() if found else len(self.page)
        stop = -1 if at >= len(self.page) else at
        self._stops.update(dict.fromkeys(passed, stop))
        return stop

    def _declared(self, start: int) -> int:
        page = self.page
        for opens, closes in (("<!--", ("-->", "--!>")), ("<![CDATA[", ("]]>",))):
            if page.startswith(opens, start):
                ends = [(e, c) for c in closes if (e := page.find(c, start + len(opens))) >= 0]
                return min(ends)[0] + len(min(ends)[1]) if ends else len(page)
        end = page.find(">", start)
        return end + 1 if end >= 0 else len(page)


def _measured(tree: Tree, apart: dict[int, bool] | frozenset = frozenset()) -> tuple[list[float], list[float], list[int]]:
    """Density, sum of the children's densities, and characters of every node; elements ``apart`` count for none around
    them."""
    n = len(tree.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[tree.parent[i]] or tree.tag[i] == "a"
    for node, text in tree.events:
        if text and not tree.dropped[node]:
            size = len(text) - text.count(" ") - text.count("\n")
            chars[node] += size
            links[node] += size * in_link[node]
    all_chars, all_links = sum(chars), sum(links)
    for i in range(n - 1, 0, -1):
        if not tree.dropped[i] and i not in apart:
            up = tree.parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (tree.tag[i] == "a")
    density, total = [0.0] * n, [0.0] * n
    share = all_links / max(all_chars, 1)
    for i in range(n):
        c, lc, t, lt = chars[i], links[i], max(tags[i], 1), max(link_tags[i], 1)
        if c and not tree.dropped[i]:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            adjusted = math.log(max(c / max(lc, 1) * t / lt, 1.0)) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else 0.0
            # a body without links leaves the plain characters per tag
            density[i] = c / t * (adjusted if all_links else 1.0)
    for i in range(1, n):
        if i not in apart:
            total[tree.parent[i]] += density[i]
    return density, total, chars


def _selected(tree: Tree) -> list[bool]:
    """Which nodes belong to the main text."""
    n = len(tree.tag)
    density, total, chars = _measured(tree)
    if not chars[0]:
        return [False] * n
    lead = list(range(n))  # of each subtree, the node with the greatest sum
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        if not tree.dropped[i] and chars[i] and total[lead[i]] > total[lead[up]]:
            lead[up] = lead[i]
    threshold, i = math.inf, lead[0]
    while i >= 0:
        if tree.tag[i] not in ("#root", "html") or i == lead[0]:
            threshold = min(threshold, density[i])
        i = tree.parent[i]
    around = [-1] * n  # the outermost article, else main, that holds a node
    for i in range(1, n):
        up = around[tree.parent[i]]
        own = tree.tag[i] == "article" or tree.tag[i] == "main"
        around[i] = i if own and (up < 0 or tree.tag[up] == "main" and tree.tag[i] == "article") else up
    chosen, reached = [False] * n, [False] * n
    for i in range(n):
        ok = not tree.dropped[i] and chars[i] and density[i] >= threshold
        reached[i] = bool(ok) and (i == 0 or reached[tree.parent[i]] or tree.tag[tree.parent[i]] in ("#root", "html"))
        if reached[i]:
            best = lead[i]
            chosen[around[best] if around[best] >= 0 else best] = True
    if not any(chosen):
        chosen[around[lead[0]] if around[lead[0]] >= 0 else lead[0]] = True
    for i in range(1, n):
        chosen[i] = not tree.dropped[i] and (chosen[i] or chosen[tree.parent[i]])
    return chosen


def main_text(page: str | None) -> str:
    """The blocks of the main text, one per line, white space inside a block made single spaces."""
    if not page:
        return ""
    tree = Tree(page)
    chosen = _selected(tree)
    blocks: list[str] = []
    run: list[str] = []
    for node, text in tree.events:
        if text is None:
            if run:
                blocks.append(" ".join("".join(run).split()))
                run = []
        elif chosen[node]:
            run.append(text)
    if run:
        blocks.append(" ".join("".join(run).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, id_col: str = "page_id", page: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: ``page_id``, the columns of ``keep``, ``text`` and ``n_chars``."""
    chosen = pages.select(F.col(id_col).alias("page_id"), *keep, F.col(page).cast("string").alias("html"))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
        arrays = [*batch.columns[:-1], pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], "text", "n_chars"])

    return map_slices(chosen, step, ", ".join([*kept, "text string", "n_chars bigint"]))
