"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over a host's block structure:
elements, text slots, optional groups and repeated groups.  Each page is a
token stream whose repeats are folded first (``x x x`` becomes ``x+``); the
wrapper and the page are then aligned element by element.  What both have is
aligned further inside, a differing text turns a fixed text into a slot, what
only one side has becomes an optional group, and a group that one side
repeats is folded on the other side as well.

Wrappers are aligned page by page inside a partition, and the partitions'
wrappers with each other, so what is shuffled is one wrapper per partition
and host, never a page.  With a host's wrapper the text slots are classed
as article or surroundings: for pages that mark an article by the elements
around them, for the host's other pages by whether the text is the same on
every page that has it.  Copies of a page count as one page.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import map_rows, stored

BROADCAST_BYTES = 32 << 20   # wrappers that are broadcast, at most
FIXED_CHARS = 200            # longer texts are compared by a hash
FIXED_PAGES = 3              # distinct pages that must agree on a text to call it fixed
PERIOD = 6                   # elements in a repeated group, at most

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|object|canvas|math|textarea|select|button|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>|<[!?][^>]*>", re.S | re.I)
_MARK = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose start ends an open paragraph or a sibling of their kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "body": {"head"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
AROUND_TAGS = frozenset("nav header footer aside form head menu dialog fieldset".split())
AROUND = frozenset("nav navbar navigation menu header masthead footer sidebar aside banner cookie cookies consent notice alert ad ads advert "
                   "adverts advertisement sponsor sponsored promo promotion share sharing social related recommended comment comments reply "
                   "replies respond disqus subscribe newsletter signup login search breadcrumb breadcrumbs pagination pager copyright legal "
                   "widget popup modal overlay toolbar teaser complementary contentinfo".split())
ARTICLE = frozenset("article main story post entry content".split())


def _marks(attributes: str) -> tuple[str, ...]:
    """The words of class, id and role that say what an element is for."""
    found = {p for m in _MARK.finditer(attributes) for p in _PART.split((m[1] or m[2] or m[3] or "").lower())}
    return tuple(sorted(found & (AROUND | ARTICLE)))


def parse(page: str) -> list:
    """The page's blocks: [name, marks, children], texts as strings inside.

    Inline elements are transparent unless their marks set them apart;
    unclosed elements end where HTML ends them.
    """
    root: list = ["", (), []]
    stack = [root]
    at = 0
    text: list[str] = []

    def flush():
        if text:
            words = entities.unescape("".join(text)).split()
            text.clear()
            if words:
                stack[-1][2].append(" ".join(words))

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            if m[1] is None or m[1].lower() not in ("script", "style"):
                text.append(" ")
            continue
        name = name.lower()
        if m[2]:
            if name in INLINE and not any(e[0] == name for e in stack):
                if name == "br":
                    text.append(" ")
                continue
            if any(e[0] == name for e in stack):
                flush()
                while stack[-1][0] != name:
                    stack.pop()
                stack.pop()
            continue
        marks = _marks(m[4]) if "=" in m[4] else ()
        if name in INLINE:
            if name == "br":
                text.append(" ")
            if name in VOID or not any(x in AROUND for x in marks):
                continue
        flush()
        if name not in INLINE and any(e[0] == "p" for e in stack):
            while stack[-1][0] != "p":
                stack.pop()
            stack.pop()
        if name in ENDS:
            stop = SCOPE.get(name, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in stop:
                    break
                if stack[i][0] in ENDS[name]:
                    del stack[i:]
                    break
        node = [name, marks, []]
        stack[-1][2].append(node)
        if name not in VOID and not m[4].endswith("/"):
            stack.append(node)
    if at < len(page):
        rest = page[at:]
        text.append(rest if "<" not in rest else re.sub(r"<[a-zA-Z/!?][^>]*\Z", "", rest))
    flush()
    return root


# Expressions are lists, so that they travel as JSON:
#   ["t", fixed text or null, pages]           a text slot; the least hashes of
#                                              its distinct pages, FIXED_PAGES at most
#   ["n", name, marks, [expressions]]          an element
#   ["r", [expressions]], ["o", [expressions]] a repeated and an optional group


def _shape(e) -> str:
    """Elements align if their shapes are equal."""
    if e[0] == "t":
        return "#"
    if e[0] == "n":
        return e[1] + "." + ".".join(e[2])
    return " ".join(_shape(x) for x in e[1])


def _deep(e) -> str:
    """Elements of a page repeat each other if also the elements in them do;
    their texts do not matter."""
    if e[0] == "t":
        return "#"
    if e[0] == "n":
        inside = [_deep(x) for x in e[3] if x[0] != "t"]
        return f"{_shape(e)}({' '.join(inside)})" if inside else _shape(e)
    return " ".join(_deep(x) for x in e[1])


def _pages(a, b):
    return a if a == b else sorted({*a, *b})[:FIXED_PAGES]


def _blend(a, b):
    """One expression for two of the same shape."""
    if a[0] == "t":
        return ["t", a[1] if a[1] is not None and a[1] == b[1] else None, _pages(a[2], b[2])]
    if a[0] == "n":
        return ["n", a[1], a[2], align(a[3], b[3])]
    return [a[0], [_blend(x, y) for x, y in zip(a[1], b[1])]]


def _same_page(a, b):
    """Like ``_blend`` for two parts of one page."""
    if a[0] == "t":
        return ["t", a[1] if a[1] == b[1] else None, _pages(a[2], b[2])]
    if a[0] == "n":
        return ["n", a[1], a[2], align(a[3], b[3], _same_page)]
    return [a[0], [_same_page(x, y) for x, y in zip(a[1], b[1])]]


def fold(items: list, blend=_same_page) -> list:
    """Adjacent repeats of up to PERIOD elements become repeated groups."""
    out = list(items)
    for period in range(1, PERIOD + 1):
        at, new = 0, []
        shapes = [_deep(e) for e in out]
        while at < len(out):
            end = at + period
            while end + period <= len(out) and shapes[at:at + period] == shapes[end:end + period]:
                end += period
            if end > at + period:
                group = out[at:at + period]
                for k in range(at + period, end, period):
                    group = [blend(_plain(x), _plain(y)) for x, y in zip(group, out[k:k + period])]
                new.append(["r", [_plain(x) for x in group]] if period > 1 or group[0][0] != "r" else group[0])
                at = end
            else:
                new.append(out[at])
                at += 1
        out = new
    return out


def _plain(e):
    """A repeat of a single element inside a repeat is that element."""
    return e[1][0] if e[0] == "r" and len(e[1]) == 1 else e


def _fixed(text: str) -> str:
    return text if len(text) <= FIXED_CHARS else "\0" + hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def expression(node, page: int = 0) -> list:
    """A parsed page as expressions with its repeats folded; ``page`` is a
    hash that tells it from other pages."""
    out = []
    for child in node[2]:
        if isinstance(child, str):
            out.append(["t", _fixed(child), [page]])
        else:
            out.append(["n", child[0], list(child[1]), expression(child, page)])
    return fold(out)


def _core(e):
    return e[1] if e[0] == "o" else [e]


def _steps(a: list, b: list) -> list[tuple[int, int]]:
    """Longest common subsequence of the shapes, as index pairs; -1 where a
    side has nothing."""
    # equal heads and tails need no table
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = 1 + best[i + 1][j + 1] if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out = [(k, k) for k in range(head)]
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            out.append((head + i, head + j))
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            out.append((head + i, -1))
            i += 1
        else:
            out.append((-1, head + j))
            j += 1
    return out + [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]


def _groups(items: list, other: list) -> list:
    """``items`` with each run that ``other`` knows as a repeated group of
    several elements folded into that group."""
    wanted = {_shape(e): len(e[1]) for o in other for e in _core(o) if e[0] == "r" and len(e[1]) > 1}
    if not wanted:
        return items
    out, at = [], 0
    while at < len(items):
        for shape, n in wanted.items():
            run = items[at:at + n]
            if len(run) == n and all(e[0] in "tnr" for e in run) and " ".join(_shape(e) for e in run) == shape:
                out.append(["r", [_plain(e) for e in run]])
                at += n
                break
        else:
            out.append(items[at])
            at += 1
    return out


def align(a: list, b: list, blend=_blend) -> list:
    """The expression that accepts what either list of expressions accepts."""
    a, b = _groups(a, b), _groups(b, a)
    out = []
    for i, j in _steps([_shape(e) for e in a], [_shape(e) for e in b]):
        if i < 0 or j < 0:
            e = a[i] if j < 0 else b[j]
            out.append(e if e[0] == "o" else ["o", [e]])
            continue
        x, y = a[i], b[j]
        optional = x[0] == "o" or y[0] == "o"
        x, y = (e[1][0] if e[0] == "o" else e for e in (x, y))
        repeated = x[0] == "r" or y[0] == "r"
        if x[0] != y[0]:
            x, y = ([e] if e[0] != "r" else e[1] for e in (x, y))
            done = [blend(_plain(p), _plain(q)) for p, q in zip(x, y)]
        else:
            done = blend(x, y)
            done = done[1] if done[0] == "r" else [done]
        e = ["r", done] if repeated else done[0]
        out.append(["o", [e]] if optional else e)
    return out


def _names(marks) -> set[str]:
    return set(marks)


def has_article(children: list) -> bool:
    """Does a parsed page mark an article?"""
    for c in children:
        if isinstance(c, str) or c[0] in AROUND_TAGS or _names(c[1]) & AROUND:
            continue
        if c[0] in ("article", "main") or _names(c[1]) & ARTICLE or has_article(c[2]):
            return True
    return False


def slots(items: list, marked: bool, inside: bool = False, out: list | None = None) -> list[bool]:
    """For each text slot of a wrapper, in order: is it article text on pages
    that mark an article, or on those that do not?"""
    out = [] if out is None else out
    for e in items:
        if e[0] == "t":
            fixed = e[1] is not None and len(e[2]) >= FIXED_PAGES
            out.append(inside if marked else not fixed)
        elif e[0] == "n":
            own = e[1] in ("article", "main") or bool(_names(e[2]) & ARTICLE)
            around = bool(_names(e[2]) & AROUND) or e[1] in AROUND_TAGS and not (e[1] == "header" and inside)
            if around:
                out.extend([False] * _count(e[3]))
            else:
                slots(e[3], marked, inside or own, out)
        else:
            slots(e[1], marked, inside, out)
    return out


def _count(items: list) -> int:
    return sum(1 if e[0] == "t" else _count(e[3] if e[0] == "n" else e[1]) for e in items)


class Wrapper:
    """A host's wrapper with its slots classed, for pages that mark an
    article and for those that do not."""

    def __init__(self, items: list):
        self.items = items
        self.classed: dict[bool, list] = {}

    def _tag(self, items: list, classes) -> list:
        out = []
        for e in items:
            if e[0] == "t":
                out.append(["t", next(classes), 0])
            elif e[0] == "n":
                out.append(["n", e[1], e[2], self._tag(e[3], classes)])
            else:
                out.append([e[0], self._tag(e[1], classes)])
        return out

    def text(self, page: list) -> list[str]:
        """Article blocks of a parsed page."""
        marked = has_article(page[2])
        if marked not in self.classed:
            self.classed[marked] = self._tag(self.items, iter(slots(self.items, marked)))
        out: list[str] = []
        self._read(self.classed[marked], page[2], out)
        return out

    def _read(self, items: list, children: list, out: list[str]) -> None:
        """Matches a page's children against the expressions and reads the
        texts that fall into article slots."""
        table: dict[str, list] = {}
        for e in items:
            for x in self._flat(e):
                # of several places for a shape in one element, article wins
                table.setdefault(_shape(x), []).append(x)
        for c in children:
            if isinstance(c, str):
                known = table.get("#", ())
                if any(x[1] for x in known):
                    out.append(c)
            else:
                known = table.get(c[0] + "." + ".".join(c[1]))
                if known:
                    self._read([y for x in known for y in x[3]], c[2], out)

    @staticmethod
    def _flat(e) -> list:
        return [e] if e[0] in "tn" else [y for x in e[1] for y in Wrapper._flat(x)]


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def _merge(key, pdf):
    import pandas as pd

    items: list | None = None
    for w in sorted(pdf["wrapper"]):
        items = json.loads(w) if items is None else align(items, json.loads(w))
    return pd.DataFrame({"host": [key[0]], "wrapper": [json.dumps(items)]})


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrapper of each host over all of its pages."""
    def emit(seen):
        # spread by content, so that a retried task gives the same rows
        return ((h, zlib.crc32(w.encode()) % 64, w) for h, w in ((h, json.dumps(w)) for h, w in seen.items()))

    def run(rows):
        seen: dict[str, list] = {}
        for host, page in rows:
            if not page:
                continue
            items = expression(parse(page), zlib.crc32(page.encode("utf-8", "surrogatepass")))
            seen[host] = align(seen[host], items) if host in seen else items
            if len(seen) > 20_000:
                yield from emit(seen)
                seen.clear()
        yield from emit(seen)

    parts = map_rows(pages.select(host_of(pages["url"]).alias("host"), "html"), run, "host string, part int, wrapper string")
    some = parts.groupBy("host", "part").applyInPandas(_merge, "host string, wrapper string")
    return some.groupBy("host").applyInPandas(_merge, "host string, wrapper string")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Null and empty pages, and those without article text, give an empty
    text.  Pages without a host in their url share one wrapper.  Repeated
    rows keep a row each, null ids stay null; a very long page is parsed whole
    by one task; an empty table gives no rows; further columns of ``pages``
    are not carried.
    """
    found = stored(infer(pages), "wrappers")
    size = found.agg(F.coalesce(F.sum(F.length("wrapper")), F.lit(0))).first()[0]
    rows = pages.select("page_id", "url", "html", host_of(pages["url"]).alias("host")).join(
        F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left").select("page_id", "url", "html", "wrapper")

    def run(batch):
        known: dict[str, Wrapper] = {}
        for page_id, url, page, wrapper in batch:
            text = ""
            if page and wrapper:
                if wrapper not in known:
                    if len(known) > 2_000:
                        known.clear()
                    known[wrapper] = Wrapper(json.loads(wrapper))
                text = "\n".join(known[wrapper].text(parse(page)))
            yield page_id, url, text, len(text)

    return map_rows(rows, run, "page_id long, url string, text string, n_chars long")
