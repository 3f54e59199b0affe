"""Main text of web pages, by wrappers inferred for each host.

A page's tokens form a sequence of elements and text slots. The wrapper of a host is a union-free regular expression
over such sequences: pages are aligned one after another with the expression so far, elements that only one side
has become optional, neighbours of one kind become repeated groups, and texts that differ become open slots.
An expression is merged with another like a page, so partial wrappers are inferred in each task and then merged:
any number of pages of one host spreads over tasks, and only small expressions are shuffled.

The wrapper decides on every page of a host with at least ``ALIKE`` pages of different URL and text; copies and fetches of
one URL are one page, however many rows they have. An element whose text is the same on all of these pages holds no article, whatever its
name. Where no element that differs has a container's name, text that is the same on all pages is template and goes, unless
it lies in the one element below the body that holds all that differs; that element is the article, with the headings it
repeats. Text of optional elements, which only some pages have, always stays, as does text within repeated
elements that differ.

Names are hints for what alignment cannot tell: among the elements that differ, which hold the article
(``CONTAINERS``, first kind first, but a kind with less than a ``SHARE``-th of the text in containers is a teaser), and
which text is a menu, advert, comment and so on (``DROPPED_TAGS``, ``DROPPED_WORDS`` in class, id or role). One such word removes no
paragraph or lesser heading that has other words beside it, none removes an ``h1``, and the header of a post is no page header. With fewer
different pages names alone decide, as nothing is known to be template.

Blocks are the texts between block-level tags; cells of a row are one block. Character references are decoded, white space in a block becomes one
space, empty blocks go, and blocks are joined by line breaks. Null or empty pages give an empty text, as do pages
without an article. Null or odd URLs share the empty host. Tags that are not closed end with their parents. Elements of
any depth are read as such; a wrapper describes ``DEPTH`` levels and takes the text of deeper ones as that of the last level.
Pages of any length are read whole; repeated rows give the same text, tables without rows none.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import lru_cache, reduce
from hashlib import md5
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their kind.
RAW = "script style textarea title iframe".split()
#: Left out with all below them where they are closed; an open tag without its end hides nothing.
HIDDEN = "noscript template svg select button".split()
VOID = set("area base br col embed img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CELLS = {"td", "th"}
#: Start tags that end an open element of one of the kinds given.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

CONTAINERS = ("article", "main", "content")
CONTENT_WORDS = set("article content entry post story".split())
# What goes: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup, readers' comments. No more:
# captions and what an object shows in its place are text.
DROPPED_TAGS = set("nav header footer aside form dialog menu".split()) | set(RAW) | set(HIDDEN)
DROPPED_WORDS = set(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer form header login masthead menu modal nav navbar navigation newsletter notice popup promo promoted related "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Elements that one such word among others does not remove.
TEXT_TAGS = set("p h2 h3 h4 h5 h6 blockquote pre figure figcaption".split())
#: A kind of container counts if it has at least one part in so many of the text in all containers.
SHARE = 3
#: Levels that a wrapper describes.
DEPTH = 60
#: Pages of different URL and text on all of which a text must be the same to count as part of the template.
ALIKE = 3
#: Times that one kind of element may stand in a sequence before the sequence becomes one repeated group.
REPEATS = 3
#: Elements of the longest sequence that is looked for as a repeated group, and cells of the largest table that two
#: sequences are aligned in. Beyond them the order of a sequence is given up, as beyond ``REPEATS``; no text is lost.
UNIT = 64
CELLS_ALIGNED = 1_000_000
#: Hosts whose wrappers a task holds before it hands them on.
HOSTS = 2_000
#: Groups that the partial wrappers of a host are merged in first, and keys that its pages are dealt over.
PARTS = 64
SALTS = 64

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|</(?P<close>[a-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<odd>[a-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDES = re.compile(rf"<(?:{'|'.join(HIDDEN)})\b", re.I)
LETTERS = re.compile(r"[a-z]+")

# An expression is a list of items [name, least, many, below]: ``least`` is 0 for an optional item, ``many`` tells
# whether it may repeat. ``below`` is the expression inside an element or a repeated group, or a slot's text if it is constant.
SLOT, GROUP = "#", "()"


def _name(tag: str, attributes: str) -> str:
    """An element's name with the words of its class, id and role."""
    words = set()
    for _, value in ATTRIBUTE.findall(attributes or ""):
        words.update(w for part in value.lower().strip("\"'").split() if not any(map(str.isdigit, part)) for w in LETTERS.findall(part))
    return ".".join([tag, *sorted(words)])


def _hidden(html: str) -> dict[int, int]:
    """Where each hidden element starts and ends; a start tag without an end, or closed in itself, is not among them."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in TOKEN.finditer(html) if HIDES.search(html) else ():
        tag = (m["open"] or m["close"] or "").lower()
        if tag not in HIDDEN:
            continue
        if m["close"]:
            if opened.get(tag):
                ends[opened[tag].pop()] = m.end()
        elif not (tag == "svg" and m["attrs"].endswith("/")):
            opened.setdefault(tag, []).append(m.start())
    return ends


def events(html: str):
    """Openings ``(+1, name)``, closings ``(-1, name)``, texts ``(0, text)`` and breaks ``(0, " ")``, always balanced."""
    stack: list[str] = []
    opened: Counter = Counter()

    def close(to: int):
        while len(stack) > to:
            opened[stack[-1].partition(".")[0]] -= 1
            yield -1, stack.pop()

    hidden, until = _hidden(html), 0
    for m in TOKEN.finditer(html):
        if m.start() < until:
            continue
        kind = m.lastgroup
        if kind == "text":
            yield 0, unescape(m["text"])
        elif kind == "close":
            tag = m["close"].lower()
            if tag in INLINE or tag in VOID or not opened[tag]:
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].partition(".")[0] == tag:
                    yield from close(i)
                    break
        elif m["open"] or m["odd"]:
            tag = (m["open"] or m["odd"]).lower()
            if tag in INLINE:
                continue
            if tag in HIDDEN:
                until = hidden.get(m.start(), 0)
                continue
            if tag in VOID:
                yield 0, " "
                continue
            for i in range(len(stack) - 1, max(-1, len(stack) - 4), -1):
                top = stack[i].partition(".")[0]
                if top in ENDS.get(tag, ()) or top == "p":
                    yield from close(i)
                    break
                if top in ("ul", "ol", "table", "dl"):
                    break
            if tag == "hr":
                yield 1, tag
                yield -1, tag
                continue
            stack.append(_name(tag, m["attrs"] or ""))
            opened[stack[-1].partition(".")[0]] += 1
            yield 1, stack[-1]
    yield from close(0)


def expression(html: str) -> list:
    """The expression of one page: every element once, neighbours of one kind folded into groups."""
    return _expression(events(html))


def _expression(steps) -> list:
    levels: list[list] = [[]]
    names: list[str] = []
    deeper = 0
    for step, what in steps:
        if step and (deeper or step > 0 and len(names) == DEPTH):
            deeper += step
        elif step > 0:
            levels.append([])
            names.append(what)
        elif step < 0:
            below = levels.pop()
            levels[-1].append([names.pop(), 1, False, _folded(_spaced(below))])
        elif levels[-1] and levels[-1][-1][0] == SLOT:
            levels[-1][-1][3].append(what)
        elif what.strip():
            levels[-1].append([SLOT, 1, False, [what]])
    return _folded(_spaced(levels[0]))


def _spaced(items: list) -> list:
    """The items with the pieces of a text as one, its white space as in a block."""
    return [[*x[:3], " ".join("".join(x[3]).split())] if x[0] == SLOT else x for x in items]


def _key(item: list):
    return (GROUP, *map(_key, item[3])) if item[0] == GROUP else item[0]


def _joined(a: list, b: list, repeated: bool = False) -> list:
    """One item for two of the same key: of the same place in two pages, or repeated in one."""
    if a[0] == SLOT:
        below = a[3] if a[3] == b[3] else None
    elif a[0] == GROUP:
        below = [_joined(x, y) for x, y in zip(a[3], b[3])]
    else:
        below = merged(a[3], b[3])
    least = max(a[1], b[1]) if repeated else min(a[1], b[1])
    return [a[0], least, repeated or a[2] or b[2], below]


def _folded(items: list) -> list:
    """Runs of items, then runs of sequences of items, with the same keys become repeated items."""
    size, codes = 1, _codes(items)
    while 2 * size <= len(items) and size <= UNIT:
        again = _repeats(codes, size)
        if not any(again):
            size += 1
            continue
        out, i = [], 0
        while i < len(items):
            unit, j = items[i : i + size], i
            while j < len(again) and again[j]:
                j += size
                unit = [_joined(x, y, repeated=size == 1) for x, y in zip(unit, items[j : j + size])]
            if j == i:
                out.append(items[i])
                i += 1
            else:
                out += unit if size == 1 else [[GROUP, 1, True, unit]]
                i = j + size
        size = 1 if size > 1 else 2
        items, codes = out, _codes(out)
    counts: dict = {}
    for x in items:
        counts[x[0]] = counts.get(x[0], 0) + 1
    if max(counts.values(), default=0) <= REPEATS:
        return items
    # No order can be told any more: one group that repeats, with each kind of element as an option.
    return _unordered(items)


def _unordered(items: list) -> list:
    """One repeated group in which each kind of element is an option."""
    kinds: dict[str, list] = {}
    for x in _flat(items):
        x = [x[0], 0, x[2], x[3]]
        kinds[x[0]] = _joined(kinds[x[0]], x, repeated=True) if x[0] in kinds else x
    return [[GROUP, 1, True, [kinds[k] for k in sorted(kinds)]]]


def _codes(items: list) -> list[int]:
    """A number for each item, the same for the same keys; empty where no two are the same, so that nothing can repeat."""
    numbers: dict = {}
    codes = [numbers.setdefault(_key(x), len(numbers)) for x in items]
    return codes if len(numbers) < len(codes) else []


def _repeats(codes: list[int], size: int) -> list[bool]:
    """For each place, whether the ``size`` items from it have the same keys as those after them."""
    out, same = [], 0
    for i in range(len(codes) - size):
        same = same + 1 if codes[i] == codes[i + size] else 0
        if i >= size - 1:
            out.append(same >= size)
    return out


def _flat(items: list) -> list:
    return [y for x in items for y in (_flat(x[3]) if x[0] == GROUP else [x])]


def merged(a: list, b: list) -> list:
    """The expression that covers both: aligned by their longest common subsequence, the rest optional."""
    p, q = [_key(x) for x in a], [_key(x) for x in b]
    if p == q:
        return [_joined(x, y) for x, y in zip(a, b)]
    if len(p) * len(q) > CELLS_ALIGNED:
        return _unordered(a + b)
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i in range(len(p) - 1, -1, -1):
        for j in range(len(q) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if p[i] == q[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(p) or j < len(q):
        if i < len(p) and j < len(q) and p[i] == q[j]:
            out.append(_joined(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(q) or i < len(p) and best[i + 1][j] >= best[i][j + 1]:
            out.append([a[i][0], 0, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], 0, *b[j][2:]])
            j += 1
    return _folded(out)


def _container(name: str) -> int | None:
    """The rank among ``CONTAINERS`` of an element that holds the article, if it does."""
    tag, *words = name.split(".")
    if tag in ("article", "main"):
        return CONTAINERS.index(tag)
    if "main" in words:
        return 1
    return 2 if CONTENT_WORDS & set(words) and tag != "body" else None


def _dropped(tag: str, words: set) -> bool:
    """Whether an element's name says that it is no part of an article."""
    if tag in DROPPED_TAGS or tag == "head":
        return True
    found = DROPPED_WORDS & words
    if not found or tag in ("html", "body", "h1"):
        return False
    if tag in TEXT_TAGS:
        return words <= DROPPED_WORDS
    return found != {"header"} or not CONTENT_WORDS & words


class Place:
    """An element of a wrapper as extraction needs it: what it is, what is constant in it, what lies below."""

    def __init__(self, name: str, items: list, constants: bool):
        tag, *words = name.split(".")
        self.dropped = _dropped(tag, set(words))
        # An item that is not on every page tells nothing about the pages without it: its text is not taken as constant.
        self.same = {x[3] for x, always, _ in items if x[0] == SLOT and always and x[3] is not None} if constants else set()
        below: dict[str, list] = {}
        times: Counter = Counter()
        for x, always, many in items:
            if x[0] != SLOT:
                below.setdefault(x[0], []).extend(_told(x[3], always))
                times[x[0]] += 2 if many else 1
        self.below = {k: Place(k, v, constants) for k, v in below.items()}
        slots = any(x[0] == SLOT and not (always and x[3] is not None) for x, always, _ in items)
        inside = [k for k, p in self.below.items() if p.differs and not p.dropped]
        #: Whether the text differs between pages, without parts that are dropped; where too few pages are known, it may.
        self.differs = not constants or slots or bool(inside)
        self.container = _container(name) if self.differs else None
        #: The only element that holds all that differs, if it stands once.
        self.only = self.below[inside[0]] if constants and not slots and len(inside) == 1 and times[inside[0]] == 1 else None
        #: Whether the element is the article for lack of a container's name.
        self.article = False


def _told(items: list, always: bool = True, many: bool = False) -> list:
    """The items of an expression without its groups, each with whether it is on every page and whether it may repeat."""
    out = []
    for x in items:
        here, often = always and x[1] > 0, many or x[2]
        out += _told(x[3], here, often) if x[0] == GROUP else [(x, here, often)]
    return out


@lru_cache(maxsize=4096)
def _unseen(name: str) -> Place:
    """The place of an element that the wrapper does not describe."""
    return Place(name, [], False)


@lru_cache(maxsize=256)
def _places(wrapper: str) -> Place:
    pages, items = json.loads(wrapper)
    place = last = Place("", _told(items), constants=pages >= ALIKE)
    name = ""
    while last.only is not None:
        name, last = next((k, p) for k, p in last.below.items() if p is last.only)
    last.article = name.partition(".")[0] not in ("", "html", "body")
    return place


def extract(html: str, wrapper: str) -> str:
    """The main text of a page under its host's wrapper."""
    return _main_text(events(html), _places(wrapper))


def _main_text(steps, place: Place, kinds: int = len(CONTAINERS)) -> str:
    """The main text under a place; only the first ``kinds`` of containers count."""
    blocks: list[list[tuple[frozenset, str, bool]]] = []
    block: list[tuple[frozenset, str, bool]] = []
    held: list[str] = []
    stack = [(place, False, frozenset(), False)]
    sizes: Counter = Counter()

    def piece():
        text = " ".join("".join(held).split())
        held.clear()
        here, dropped, inside, article = stack[-1]
        if text and not dropped:
            block.append((inside, text, not article and text in here.same))
            sizes.update(dict.fromkeys(inside, len(text)))

    def flush():
        piece()
        if block:
            blocks.append(block.copy())
            block.clear()

    for step, what in steps:
        if step == 0:
            held.append(what)
            continue
        if what.partition(".")[0] in CELLS:
            piece()
        else:
            flush()
        if step > 0:
            above, dropped, inside, article = stack[-1]
            here = above.below.get(what) or _unseen(what)
            dropped = dropped or here.dropped
            if here.container is not None and here.container < kinds and not dropped:
                inside = inside | {here.container}
                sizes[here.container] += 0
            stack.append((here, dropped, inside, article or here.article))
        else:
            stack.pop()
    flush()
    if sizes:
        most = sum(len(text) for pieces in blocks for inside, text, _ in pieces if inside)
        kind = next((k for k in sorted(sizes) if SHARE * sizes[k] >= most), max(sizes, key=sizes.get))
        kept = [[text for inside, text, _ in pieces if kind in inside] for pieces in blocks]
    else:
        kept = [[text for _, text, same in pieces if not same] for pieces in blocks]
    return "\n".join(" ".join(texts) for texts in kept if texts)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without login and port."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", ""))


def _page(url: str, html: str) -> list:
    """The partial wrapper of one page: digests of its URL and of its text, and its expression.

    The text is that of an article or main element, else all but what names drop: a class word alone is too weak a
    hint to say what makes a page different.
    """
    steps = list(events(html))
    told = [md5(x.encode("utf-8", "replace")).hexdigest() for x in (url, _main_text(steps, _unseen(""), CONTAINERS.index("content")))]
    return [[told[0]], [told[1]], _expression(steps)]


def _both(a: list, b: list) -> list:
    """One partial wrapper for two. ``ALIKE`` different digests are kept, which is all that extraction asks about their number."""
    return [*(sorted({*x, *y})[:ALIKE] for x, y in zip(a[:2], b[:2])), merged(a[2], b[2])]


def _partial(batches):
    """A partial wrapper for each host of the task's pages."""
    held: dict[str, list] = {}

    def told():
        out = pd.DataFrame([(h, json.dumps(w)) for h, w in held.items()], columns=["host", "wrapper"])
        held.clear()
        return out

    for batch in batches:
        for host, url, html in zip(batch["host"], batch["url"], batch["html"]):
            held[host] = _both(held[host], _page(url, html)) if host in held else _page(url, html)
        if len(held) > HOSTS:
            yield told()
    if held:
        yield told()


def _merged_wrappers(keys: list[str], last: bool = False):
    """One wrapper for those of a group; the last holds the number of different pages, up to ``ALIKE``, for the digests."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        urls, texts, items = reduce(_both, map(json.loads, sorted(rows["wrapper"])))
        told = [min(len(urls), len(texts)), items] if last else [urls, texts, items]
        return pd.DataFrame([(*rows[keys].iloc[0], json.dumps(told))], columns=[*keys, "wrapper"])

    return merge


def infer(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``host, wrapper`` for each host of the pages."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.coalesce(url, F.lit("")).alias("url"), F.coalesce(html, F.lit("")).alias("html")).where("html <> ''")
    partial = rows.mapInPandas(_partial, "host string, wrapper string")
    partial = partial.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)).cast("int"))
    some = partial.groupBy("host", "part").applyInPandas(_merged_wrappers(["host", "part"]), "host string, part int, wrapper string")
    return some.groupBy("host").applyInPandas(_merged_wrappers(["host"], last=True), "host string, wrapper string")


def with_wrappers(pages: DataFrame, wrappers: DataFrame, host: str, name: str = "wrapper") -> DataFrame:
    """The pages with their hosts' wrappers, null where there is none.

    Pages of a host are dealt over ``SALTS`` keys, and each wrapper, a few hundred bytes, goes to all of them, so a
    host with a third of all pages is no single task.
    """
    salt = F.pmod(F.xxhash64(*[c for c, kind in pages.dtypes if "map<" not in kind]), F.lit(SALTS)).cast("int")
    small = wrappers.select(F.col("host").alias("_host"), F.col("wrapper").alias(name), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_of"))
    rows = pages.withColumn("_salt", salt)
    return rows.join(small, (rows[host] == small["_host"]) & (rows["_salt"] == small["_of"]), "left").drop("_salt", "_host", "_of")


def main_text(html: Column, wrapper: Column) -> Column:
    """The main text of pages with the wrappers of their hosts; empty where either is null."""

    @F.pandas_udf("string")
    def text(pages: pd.Series, wrappers: pd.Series) -> pd.Series:
        return pd.Series([extract(p, w) if p and w else "" for p, w in zip(pages, wrappers)], dtype=object)

    return text(html, wrapper)
