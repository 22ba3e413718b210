"""Main-text extraction by union-free regular-expression wrappers.

Pages of one host mostly come from one template. Their token streams (tags and
texts, balanced and without inline markup) are aligned one after the other with
the host's *wrapper*, a union-free regular expression:

- ``["e", label, items]`` an element whose content is a sequence;
- ``["+", items]``        a group that occurs once or more, one after another;
- ``["?", items]``        a group that may be absent;
- ``["T", value, pages, chars, linked]`` a text: a hash of its value if it is
  the same on all pages, a slot (``None``) otherwise, with sums of its length.

A text that differs becomes a slot; content that repeats side by side becomes a
repeated group; content that only one side has becomes an optional group.
Alignment is associative enough to run in two levels: each task folds its own
pages into one wrapper a host, then the tasks' wrappers are folded, through
salted intermediate groups, so no task holds a host's pages.

The wrapper's slots are then judged once for the host. Slots in menus, headers,
footers, sidebars, notices, adverts, forms and comments (by element, role, class
or id words; class and id words do not count on html, body, main and article)
go. If a page has a main region with text (article, main, role, class), what
else lies in it stays, whether it varies or not, and everything outside goes.
Without one, link lists and texts that are the same on three or more different
pages go. One host may have pages of both kinds: each kind has a wrapper of its
own. Each page is aligned with its wrapper and gives the texts that fall on kept
slots.

Class words that may also name a part of an article (header, legal, form, search,
side) decide nothing inside a main region. Elements nested below 64 levels are taken
flat, with the regions they lie in; very long sequences are aligned by looking ahead
a bounded way. A page without body or with an unclosed head has its text like any other.

Blocks are joined by a line break in page order; white space inside a block
becomes one space; character references are decoded. Null html: empty text.
Pages without a host (null or unparsable url) are judged each alone. Equal pages and repeated rows are pages
like any others. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stage

# Fixed values of HTML: elements by kind.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
SKIPPED = frozenset("script style noscript template textarea title select button iframe svg math object canvas audio video map datalist xmp noembed noframes".split())
TEXTUAL = frozenset("p li h1 h2 h3 h4 h5 h6 dt dd tr td th blockquote pre".split())
BOILER_TAGS = frozenset("nav header footer aside form menu dialog".split())
MAIN_TAGS = frozenset("article main".split())
CLOSED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words in class and id attributes that name a region.
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored sidebar side rail aside widget widgets menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead topbar footer foot bottombar comment comments reply replies respond disqus discussion cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations pagination pager toolbar copyright legal form search".split()
)
# Those of them that also name parts of an article: inside a main region they decide nothing.
WEAK_WORDS = frozenset("header legal form search side".split())
MAIN_WORDS = frozenset("article main content post entry story articlebody".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
#: Elements below this level lie flat in their ancestor there, so no recursion over a page is deeper.
MAX_DEPTH = 64
#: Cells of an exact alignment; longer sequences are aligned by looking ahead this far.
MAX_CELLS, AHEAD = 1 << 17, 64
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"([a-z])([A-Z])")


def _label(tag: str, attrs: str) -> str:
    """The element's name, with ``-`` for a boilerplate region, ``~`` for one that is
    none inside a main region, or ``+`` for a main one."""
    if tag in ("html", "body"):  # the whole page is no region
        return tag
    if tag in MAIN_TAGS:
        mark = "+"
    else:
        mark = "~" if tag == "header" else "-" if tag in BOILER_TAGS else ""
    if attrs and not attrs.isspace():
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)}
        words = set(WORDS.findall(CAMEL.sub(r"\1 \2", f"{found.get('class', '')} {found.get('id', '')}").lower()))
        role = found.get("role", "").lower()
        named = words & BOILER_WORDS if tag not in MAIN_TAGS else set()
        if named - WEAK_WORDS or role in BOILER_ROLES or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower() or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs):
            mark = "-"
        elif named and not mark:
            mark = "~"
        elif not mark and (words & MAIN_WORDS or role == "main"):
            mark = "+"
    return tag + mark


def parse(page: str) -> tuple[list, list[str]]:
    """The page as nested items and its block texts in order. A text item is
    ``["T", value, 1, chars, linked, [index of the block]]``.

    Elements below ``MAX_DEPTH`` open no level of their own: each of their texts is an
    element ``deep`` of the last level, marked by the regions it lies in. ``head`` is
    no element: what it may hold is skipped anyway, and a page may leave its end out."""
    root: list = []
    stack: list[tuple[str, list, tuple[bool, bool]]] = [("", root, (False, False))]
    opened: Counter = Counter()
    texts: list[str] = []
    pieces: list[str] = []
    linked = [0, 0]  # depth of links, characters in links

    def flush():
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                item = ["T", zlib.crc32(text.encode("utf-8", "surrogatepass")), 1, len(text), min(linked[1], len(text)), [len(texts)]]
                if len(stack) > MAX_DEPTH + 1:
                    inside, boiler = stack[-1][2]
                    item = ["e", "deep-" if boiler else "deep+" if inside else "deep", [item]]
                stack[-1][1].append(item)
                texts.append(text)
        linked[1] = 0

    at, skip = 0, None
    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at and not skip:
            piece = page[at : m.start()]
            pieces.append(piece)
            linked[1] += len(piece.strip()) if linked[0] else 0
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag, end = tag.lower(), m["end"] or m["end2"]
        attrs = m["attrs"] if m["tag"] else m["attrs2"]
        if not end and tag in RAW:
            close = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            stop = page.find(">", close.start()) if close else -1
            at = stop + 1 if stop >= 0 else len(page)
            continue
        if skip:  # inside an element whose content is no text
            if tag == skip[0] and tag not in VOID:
                skip[1] += -1 if end else 1
                if skip[1] == 0:
                    skip = None
            if skip or end:
                continue
        if tag in SKIPPED:
            if not end and not attrs.endswith("/"):
                skip = [tag, 1]
            continue
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                linked[0] = 0 if end else 1
            continue
        flush()
        if end:
            if opened[tag]:
                while stack[-1][0] != tag:
                    opened[stack.pop()[0]] -= 1
                opened[stack.pop()[0]] -= 1
            continue
        if tag in VOID or tag == "head":
            continue
        while len(stack) > 1 and (stack[-1][0] == "p" or tag in (CLOSED_BY.get(stack[-1][0]) or ())):
            opened[stack.pop()[0]] -= 1
        label, items = _label(tag, attrs), stack[-1][1]
        if len(stack) <= MAX_DEPTH:
            items = []
            stack[-1][1].append(["e", label, items])
        stack.append((tag, items, within(label, *stack[-1][2])))
        opened[tag] += 1
    if not skip and at < len(page):
        pieces.append(page[at:])
    flush()
    return root, texts


def alike(a: list, b: list) -> bool:
    """Whether two items may be one: same kind and, for elements, same name."""
    return a[0] == b[0] and (a[0] != "e" or a[1] == b[1])


def shape(item: list) -> frozenset:
    """What kinds of content an element holds directly: text, links, elements by name."""
    kinds: set = set()
    for x in item[2]:
        for y in core(x):
            kinds.add(y[1] if y[0] == "e" else "links" if y[0] == "T" and 2 * y[4] > y[3] else "text")
    return frozenset(kinds)


def repeats(a: list, b: list) -> bool:
    """Whether two neighbours may be turns of one group: alike and, for containers,
    with content of the same kinds (one may have more)."""
    if not alike(a, b) or a[0] != "e" or a[1].rstrip("+-~") in TEXTUAL:
        return alike(a, b)
    x, y = shape(a), shape(b)
    return x == y or bool(x and y and (x <= y or y <= x))


def core(item: list) -> list:
    """The items of a group, or the item itself as a group of one."""
    return item[1] if item[0] in "+?" else [item]


def same_group(a: list, b: list) -> bool:
    return len(a) == len(b) and all(alike(x, y) for x, y in zip(a, b))


def merge(a: list, b: list) -> list:
    """One item for two alike ones."""
    if a[0] == "T":
        value = a[1] if a[1] == b[1] else None
        return ["T", value, a[2] + b[2], a[3] + b[3], a[4] + b[4], *([a[5] + b[5]] if len(a) > 5 and len(b) > 5 else [])]
    if a[0] == "e":
        return ["e", a[1], align(a[2], b[2])]
    return [a[0], align(a[1], b[1])]


def fold(items: list, longest: int = 6) -> list:
    """Items that repeat side by side become a repeated group (shortest period first)."""
    items = [["e", x[1], fold(x[2])] if x[0] == "e" else x for x in items]
    for size in range(1, longest + 1):
        out, i = [], 0
        while i < len(items):
            group, j = items[i : i + size], i + size
            if not any(x[0] == "e" for x in group):
                out.append(items[i])
                i += 1
                continue
            while j + size <= len(items) and all(repeats(x, y) for x, y in zip(group, items[j : j + size])):
                group = [merge(x, y) for x, y in zip(group, items[j : j + size])]
                j += size
            if j > i + size:
                out.append(["+", fold(group, size - 1) if size > 1 else group])
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _match(x: list, y: list) -> int:
    """How well two items go together: 0 not at all."""
    if alike(x, y) and x[0] in "eT":
        return 2
    if x[0] in "+?" or y[0] in "+?":
        p, q = core(x), core(y)
        if same_group(p, q):
            return 2
    return 0


def _fits(x: list, y: list) -> int:
    """As ``_match``; groups that differ also go together, less well, if any of their items do."""
    s = _match(x, y)
    if s or not (x[0] in "+?" or y[0] in "+?"):
        return s
    return int(any(_fits(p, q) for p in core(x) for q in core(y)))


def _join(x: list, y: list) -> list:
    if x[0] in "eT" and y[0] in "eT":
        return merge(x, y)
    group = [merge(p, q) for p, q in zip(core(x), core(y))]
    return ["+" if "+" in (x[0], y[0]) else "?", group]


def _lone(x: list) -> list:
    """An item that only one side has."""
    return x if x[0] == "?" else ["?", x[1] if x[0] == "+" else [x]]


def _ahead(a: list, b: list, pairs: list | None, match) -> list:
    """``align`` of long sequences: the nearest like items within ``AHEAD`` places go together."""
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        d = e = 0
        while d <= AHEAD:  # the fewest items left out, on the side of a first
            if i + d < len(a) and match(a[i + d], b[j]):
                break
            if j + d < len(b) and match(a[i], b[j + d]):
                d, e = 0, d
                break
            d += 1
        if d > AHEAD:
            d = e = 1
        out += [_lone(x) for x in a[i : i + d]] + [_lone(x) for x in b[j : j + e]]
        i, j = i + d, j + e
        if d and e:
            continue
        if pairs is None:
            out.append(_join(a[i], b[j]))
        else:
            pairs.append((a[i], b[j]))
        i, j = i + 1, j + 1
    return out + [_lone(x) for x in a[i:] + b[j:]]


def align(a: list, b: list, pairs: list | None = None) -> list:
    """The sequence that describes both: longest common alignment, the rest optional.

    With ``pairs``, the items that went together are appended to it instead of joined;
    then groups go together even if their items differ. Of sequences whose table would
    pass ``MAX_CELLS``, an item goes with the next like one at most ``AHEAD`` places on:
    time and memory follow their length, and what finds no partner is optional.
    """
    match = _match if pairs is None else _fits
    if len(a) == len(b) and all(match(x, y) for x, y in zip(a, b)):
        if pairs is not None:
            pairs += zip(a, b)
            return a
        return [_join(x, y) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    if n * m > MAX_CELLS:
        return _ahead(a, b, pairs, match)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            s = match(a[i], b[j])
            best[i][j] = max(best[i + 1][j], best[i][j + 1], s + best[i + 1][j + 1] if s else 0)
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and (s := match(a[i], b[j])) and best[i][j] == s + best[i + 1][j + 1]:
            if pairs is None:
                out.append(_join(a[i], b[j]))
            else:
                pairs.append((a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i][j] == best[i + 1][j]):
            out.append(_lone(a[i]))
            i += 1
        else:
            out.append(_lone(b[j]))
            j += 1
    return out


def bare(items: list) -> list:
    """Without the page's own block numbers."""
    return [x[:5] if x[0] == "T" else ["e", x[1], bare(x[2])] if x[0] == "e" else [x[0], bare(x[1])] for x in items]


def within(label: str, inside: bool, boiler: bool) -> tuple[bool, bool]:
    """Whether an element's content is inside a main region and in boilerplate."""
    return inside or label[-1] == "+", boiler or label[-1] == "-" or (label[-1] == "~" and not inside)


def main_blocks(page: list, inside: bool = False, boiler: bool = False, region: bool = True) -> set[int]:
    """Numbers of a page's blocks in its main region; without ``region``, of those that are no link lists."""
    out: set[int] = set()
    for x in page:
        if x[0] == "T":
            if not boiler and (inside if region else 2 * x[4] <= x[3]):
                out.update(x[5])
        elif x[0] == "e":
            out |= main_blocks(x[2], *within(x[1], inside, boiler), region)
        else:
            out |= main_blocks(x[1], inside, boiler, region)
    return out


def judge(wrapper: list, region: bool = False) -> list:
    """The wrapper with, on every text, whether its slot belongs to the main text."""

    def walk(items, inside: bool, boiler: bool) -> list:
        out = []
        for x in items:
            if x[0] == "T":
                keep = inside if region else 2 * x[4] <= x[3] and not (x[1] is not None and x[2] >= 3)
                out.append([*x[:5], int(keep and not boiler)])
            elif x[0] == "e":
                out.append(["e", x[1], walk(x[2], *within(x[1], inside, boiler))])
            else:
                out.append([x[0], walk(x[1], inside, boiler)])
        return out

    return walk(wrapper, False, False)


def kept_blocks(page: list, wrapper: list) -> set[int]:
    """Numbers of the page's blocks that fall on kept slots; content that the
    wrapper does not know is judged on the page alone."""
    kept: set[int] = set()
    region = bool(main_blocks(page))

    def take(items: list, judged: list, inside: bool, boiler: bool) -> None:
        pairs: list = []
        align(items, judged, pairs)
        known = {id(x) for x, _ in pairs}
        kept.update(main_blocks([x for x in items if id(x) not in known], inside, boiler, region))
        for x, y in pairs:
            if x[0] == "T" and y[0] == "T":
                kept.update(x[5] if y[5] else ())
            elif x[0] == "e" and y[0] == "e":
                take(x[2], y[2], *within(x[1], inside, boiler))
            else:
                take(core(x), core(y), inside, boiler)

    take(page, wrapper, False, False)
    return kept


def host(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def infer(pages: DataFrame, url: str = "url", html: str = "html", salts: int = 32) -> DataFrame:
    """host, main, plain: one row per host with the judged wrappers (JSON) of its
    pages with a main region and of those without (null if there are none)."""
    bounded_batches(pages.sparkSession)
    rows = pages.filter(F.col(html).isNotNull()).select(host(F.col(url)).alias("host"), F.col(html).alias("html")).filter("host <> ''")

    def per_task(batches):
        wrappers: dict[tuple[str, bool], list] = {}
        for pdf in batches:
            for h, page in zip(pdf["host"], pdf["html"]):
                items = fold(parse(page)[0])
                k, items = (h, bool(main_blocks(items))), bare(items)
                wrappers[k] = fold(align(wrappers[k], items)) if k in wrappers else items
        yield pd.DataFrame({"host": pd.Series([h for h, _ in wrappers], dtype=object), "region": pd.Series([r for _, r in wrappers], dtype=bool), "wrapper": pd.Series([json.dumps(w) for w in wrappers.values()], dtype=object)})

    def folded(last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            items, region = None, bool(pdf["region"].iloc[0])
            for w in sorted(pdf["wrapper"]):
                items = json.loads(w) if items is None else fold(align(items, json.loads(w)))
            return pd.DataFrame({"host": [pdf["host"].iloc[0]], "region": [region], "wrapper": [json.dumps(judge(items, region) if last else items)]})

        return run

    kind = "host string, region boolean, wrapper string"
    parts = rows.mapInPandas(per_task, kind).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
    parts = parts.groupBy("host", "region", "salt").applyInPandas(folded(False), kind)
    parts = parts.groupBy("host", "region").applyInPandas(folded(True), kind)
    return parts.groupBy("host").agg(F.max(F.when(F.col("region"), F.col("wrapper"))).alias("main"), F.max(F.when(~F.col("region"), F.col("wrapper"))).alias("plain"))


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url: str = "url", html: str = "html", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """The kept columns and ``text``, the main text of every page (never null)."""
    wrappers = stage(infer(pages, url, html), "wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.coalesce(F.length("main"), F.lit(0)) + F.coalesce(F.length("plain"), F.lit(0)) + F.length("host")), F.lit(0))).first()[0]
    # hosts grow with the crawl: only a checked size is broadcast, else the (adaptive) shuffle join splits hot hosts
    wrappers = F.broadcast(wrappers) if size <= broadcast_bytes else wrappers
    rows = pages.select(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keep)), host(F.col(url)).alias("host"), F.col(html).alias("html")).join(wrappers, "host", "left")

    @F.pandas_udf("string")
    def main_text(html_: pd.Series, main: pd.Series, plain: pd.Series) -> pd.Series:
        known: dict[str | None, list] = {None: []}
        out = []
        for page, *both in zip(html_, main, plain):
            if page is None:
                out.append("")
                continue
            items, texts = parse(page)
            items = fold(items)
            w = both[0] if main_blocks(items) else both[1]
            if w not in known:
                known[w] = json.loads(w)
            kept = kept_blocks(items, known[w])
            out.append("\n".join(t for i, t in enumerate(texts) if i in kept))
        return pd.Series(out, dtype=object)

    return rows.withColumn("text", main_text("html", "main", "plain")).select(*(F.col(f"_{i}").alias(k) for i, k in enumerate(keep)), "text")
