"""Main text of web pages, by wrappers inferred for each host.

A page is a stream of block tags and texts. Repeated neighbours become one repeated
group; the streams of a host's pages are then aligned one after the other, and what
does not align is made optional. The result is a regular expression without unions:
tags, text slots, optional items and repeated groups. The slots decide what is kept, and
each page's texts are matched to the slots.

Wrappers are aligned in each task, then per host and share of a host, then per host, so
that the pages of one host never meet in one task; only wrappers do.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm import rows
from wakeline.llm.url_rules import host_of

#: Shares into which the wrappers of one host are split for the first merge.
SHARES = 32
#: A text outside the article is part of the template if as many pages of different contents,
#: and such a share of the host's, have it alike.
TEMPLATE_PAGES = 3
TEMPLATE_SHARE = 0.5
#: Pages are counted by so many of the smallest digests of their contents.
_SAMPLED_PAGES = 16
#: Sign of the item before every page, whose pages are all of the host.
_PAGE = "^"
#: Hosts whose wrappers a task holds at once before it hands them on.
_HOSTS_AT_ONCE = 2_000
_LONGEST_GROUP = 40

#: Elements by their part in a page.
_RAW = ("script", "style", "noscript", "template", "iframe", "svg", "title", "textarea", "select", "object", "math")
_DROPPED = frozenset((*_RAW, "head", "nav", "footer", "aside", "form", "button", "dialog", "menu", "header"))
_MAIN = frozenset(("article", "main"))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
_INLINE = frozenset(
    ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
     "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var")
)
#: Words in class, id and role that mark what is not the article.
_ASIDE_WORDS = frozenset(
    ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
     "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu",
     "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pager", "pagination", "popup", "promo",
     "promotion", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
     "subscribe", "toolbar", "widget")
)
#: Of these, those that an inline element inside a paragraph is left out for.
_INLINE_WORDS = frozenset(
    ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "promo", "promotion", "share", "sharing", "social", "sponsor", "sponsored")
)
#: Parts of a class that say something about a page and not what the element is.
_SAID_BEFORE = frozenset(("has", "hide", "is", "no", "not", "show", "with", "without"))
_SAID_AFTER = frozenset(("closed", "disabled", "enabled", "off", "on", "open"))
#: Elements around a whole page or article, whose classes say how it is laid out, and
#: those that cannot hold an article, so that one ends them if they were left open.
_WHOLE = frozenset(("html", "body", "main", "article"))
_ENDED_BY = {"main": _DROPPED, "article": frozenset(("nav", "menu", "header", "form"))}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_CLOSE_RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in _RAW}


class Token:
    """A block tag, or the text between two of them with the share of it in links."""

    __slots__ = ("sign", "text", "linked")

    def __init__(self, sign: str, text: str | None = None, linked: bool = False):
        self.sign, self.text, self.linked = sign, text, linked


def _marks(rest: str) -> list[str]:
    values = [m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)] if "=" in rest else []
    return re.sub(r"\d+", "0", " ".join(values).lower()).split()


def tokens(page: str) -> list[Token]:
    """Block tags and non-empty texts. A text's sign holds where it stands: ``m`` in the
    article, ``x`` in what never belongs to it, ``b`` elsewhere; and the element around it."""
    out: list[Token] = []
    stack: list[tuple[str, str, str]] = [("", "b", "")]
    pieces: list[str] = []
    plain = linked = in_link = 0
    muted: list[str] = []  # inline elements that are left out, and those of their kind within

    def flush() -> None:
        nonlocal plain, linked
        muted.clear()
        text = " ".join("".join(pieces).split())
        if text:
            _, zone, key = stack[-1]
            out.append(Token(f"#{zone}{key}", text, linked > plain))
        pieces.clear()
        plain = linked = 0

    def said(raw: str) -> None:
        nonlocal plain, linked
        if raw and not muted:
            pieces.append(entities.unescape(raw) if "&" in raw else raw)
            if in_link:
                linked += len(raw)
            else:
                plain += len(raw)

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        said(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        if found["name"] is None:
            continue
        name, ends = found["name"].lower(), bool(found["end"])
        if name in _INLINE:
            in_link = in_link if name != "a" else int(not ends)
            if not ends and (muted[-1:] == [name] or not muted and _says(_marks(found["rest"]), _INLINE_WORDS)):
                muted.append(name)
            elif ends and muted[-1:] == [name]:
                muted.pop()
            continue
        if name in ("br", "wbr", "img"):
            pieces.append(" " if name == "br" else "")
            continue
        flush()
        in_link = 0
        if ends:
            _close(stack, name)
            out.append(Token(f"/{name}"))
            continue
        _implied(stack, name)
        _interrupted(stack, name)
        words = _marks(found["rest"])
        key = ".".join([name, *words])
        out.append(Token(key))
        if name in _CLOSE_RAW:
            close = _CLOSE_RAW[name].search(page, at)
            at = close.start() if close else len(page)
        elif name not in _VOID and not found["rest"].endswith("/"):
            stack.append((name, _zone(stack[-1][1], name, words), key))
    flush()
    return out


def _zone(outer: str, name: str, words: list[str]) -> str:
    if outer == "x":
        return "x"
    # inside an article a header is its own
    named = _ASIDE_WORDS - ({"header"} if outer == "m" else set())
    if name in _WHOLE:
        if name == "article" and not {"comment", "comments"}.isdisjoint(words):
            return "x"
    elif _says(words, named):
        return "x"
    if name in _DROPPED and not (name == "header" and outer == "m"):
        return "x"
    return "m" if outer == "m" or name in _MAIN or "main" in words else "b"


def _says(words: list[str], named: frozenset | set) -> bool:
    """A class, id or role is one of the names, or is put together with one: not to say that there is or is none."""
    for word in words:
        parts = [p for p in re.split(r"[-_]+", word) if p]
        if word in named or not named.isdisjoint(parts) and _SAID_BEFORE.isdisjoint(parts) and parts[-1] not in _SAID_AFTER:
            return True
    return False


def _interrupted(stack: list, name: str) -> None:
    """An article ends what cannot hold it and was left open."""
    held = _ENDED_BY.get(name, ())
    for i in range(1, len(stack)):
        if stack[i][0] in held and stack[i][1] == "x" and stack[i - 1][1] != "x":
            del stack[i:]
            return


def _close(stack: list, name: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] == name:
            del stack[i:]
            return


def _implied(stack: list, name: str) -> None:
    """Ends that an opening tag implies."""
    if stack[-1][0] == "p":
        stack.pop()
    for own, within in (("li", ("ul", "ol")), ("dt", ("dl",)), ("dd", ("dl",)), ("tr", ("table",)), ("td", ("tr", "table")), ("th", ("tr", "table"))):
        if name == own:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in within:
                    return
                if stack[i][0] == own:
                    del stack[i:]
                    return
    if name == "body":
        _close(stack, "head")


class Alphabet(dict):
    """A character for every sign, so that streams are strings; a group's sign lists its own."""

    def __missing__(self, sign: str) -> str:
        char = chr(0xF0000 + len(self)) if len(self) < 0xFFFF else chr(0x20000 + len(self) - 0xFFFF)
        self[sign] = char
        return char


_REPEATED = re.compile(rf"(.{{1,{_LONGEST_GROUP}}}?)\1+", re.DOTALL)


class Item:
    """Of a wrapper: a tag, a slot or a repeated group. ``alike``: digest of a slot's or
    group's texts while all pages agree; ``pages``: meanwhile, the smallest digests of the contents
    of the pages it was seen in, so that copies of a page count once."""

    __slots__ = ("sign", "optional", "alike", "pages", "linked")

    def __init__(self, sign: str, optional: bool = False, alike: int | None = None, pages: list[int] | tuple = (), linked: bool = False):
        self.sign, self.optional, self.alike, self.pages, self.linked = sign, optional, alike, pages, linked

    def row(self) -> list:
        return [self.sign, self.optional, self.alike, self.pages, self.linked]


def _is_group(sign: str) -> bool:
    return sign.startswith("(")


def _members(sign: str) -> list[str]:
    return json.loads(sign[1:])


def _grouped(stream: list[Item], units: list[str], alphabet: Alphabet) -> list[tuple[Item, int]]:
    """Items with repeated groups folded, each with the number of tokens it stands for.
    ``units``: signs of groups that are known already; one occurrence of them is enough."""
    folded = [(item, 1) for item in stream]
    known = [u for u in units if len(_members(u)) > 1 or not _is_group(_members(u)[0])]
    for _ in range(4):
        text = "".join(alphabet[item.sign] for item, _ in folded)
        spans = []
        for unit in known:
            own = "".join(alphabet[m] for m in _members(unit))
            spans += [(m.start(), m.end(), unit) for m in re.finditer(f"(?:{re.escape(own)})+", text)]
        for m in _REPEATED.finditer(text):
            spans.append((m.start(), m.end(), "(" + json.dumps([folded[i][0].sign for i in range(m.start(), m.start() + len(m[1]))])))
        if not spans:
            break
        out, at = [], 0
        for start, end, sign in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
            if start < at:
                continue
            out += folded[at:start]
            said = [item for item, _ in folded[start:end] if item.sign[0] in "#("]
            alike = [i.alike for i in said]
            digest = None if None in alike else zlib.crc32(repr(alike).encode())
            group = Item(sign, alike=digest, pages=said[0].pages if said else (), linked=all(i.linked for i in said))
            out.append((group, sum(n for _, n in folded[start:end])))
            at = end
        folded = out + folded[at:]
        known = []
    return folded


def _matched(a: str, b: str) -> list[tuple[int, int]]:
    """Pairs of positions of a longest common subsequence."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    # a row of the length table is a number with a zero bit where the length grows
    places: dict[str, int] = {}
    for j, char in enumerate(y):
        places[char] = places.get(char, 0) | 1 << j
    full = (1 << len(y)) - 1
    table = [full]
    for char in x:
        same = table[-1] & places.get(char, 0)
        table.append((table[-1] + same | table[-1] - same) & full)
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if table[i] >> (j - 1) & 1:
            j -= 1
        elif not table[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((head + i, head + j))
    ends = [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    return [(k, k) for k in range(head)] + pairs[::-1] + ends


def _items(page: list[Token]) -> list[Item]:
    content = [zlib.crc32("\0".join(t.text for t in page if t.text is not None).encode())]
    own = [Item(t.sign, linked=t.linked) if t.text is None else Item(t.sign, alike=zlib.crc32(t.text.encode()), pages=content, linked=t.linked) for t in page]
    return [Item(_PAGE, pages=content), *own]


def _units(wrapper: list[Item]) -> list[str]:
    return sorted({i.sign for i in wrapper if _is_group(i.sign)}, key=lambda s: (-len(s), s))


def align(wrapper: list[Item] | None, other: list[Item], alphabet: Alphabet) -> list[Item]:
    """The wrapper of both: groups of either fold the other, the rest becomes optional."""
    if wrapper is None:
        return [item for item, _ in _grouped(other, [], alphabet)]
    right = [item for item, _ in _grouped(other, _units(wrapper), alphabet)]
    left = [item for item, _ in _grouped(wrapper, _units(right), alphabet)]
    out, i, j = [], 0, 0
    pairs = _matched(*("".join(alphabet[x.sign] for x in side) for side in (left, right)))
    for a, b in [*pairs, (len(left), len(right))]:
        for alone in left[i:a] + right[j:b]:
            alone.optional = True
            out.append(alone)
        if a < len(left) and b < len(right):
            x, y = left[a], right[b]
            alike = x.alike if x.alike == y.alike else None
            seen = sorted({*x.pages, *y.pages})[:_SAMPLED_PAGES] if alike is not None or x.sign == _PAGE else ()
            out.append(Item(x.sign, x.optional or y.optional, alike, seen, x.linked and y.linked))
        i, j = a + 1, b + 1
    return out


def _dump(wrapper: list[Item]) -> str:
    return json.dumps([item.row() for item in wrapper], separators=(",", ":"))


def _load(text: str) -> list[Item]:
    return [Item(*row) for row in json.loads(text)]


def expression(wrapper: str) -> str:
    """A wrapper for reading: slots are ``#``, groups ``(...)+``, optional items end in ``?``."""

    def shown(sign: str) -> str:
        if _is_group(sign):
            return "(" + " ".join(shown(m) for m in _members(sign)) + ")+"
        return "#" if sign[0] == "#" else f"<{sign}>"

    return " ".join(shown(i.sign) + "?" * i.optional for i in _load(wrapper) if i.sign != _PAGE)


def _slots(sign: str) -> list[str]:
    """Zones of the slots of an item, in order."""
    if _is_group(sign):
        return [z for m in _members(sign) for z in _slots(m)]
    return [sign[1]] if sign[0] == "#" else []


def _kept(item: Item, has_main: bool, pages: list[int]) -> bool:
    """Whether texts of this item are the article's; those in ``x`` never are. ``pages``: of the host."""
    zones = set(_slots(item.sign))
    if has_main:
        return "m" in zones
    if item.linked:
        return False  # a menu
    if item.alike is None or len(item.pages) < TEMPLATE_PAGES:
        return True
    # both are the smallest of their kind, so the host's tell the share of the item's
    return len({*pages} & {*item.pages}) < TEMPLATE_SHARE * len(pages)


class Extractor:
    def __init__(self) -> None:
        self.alphabet = Alphabet()
        self.wrappers: dict[str, list[Item]] = {}

    def text(self, page: str | None, wrapper: str | None) -> str:
        stream = tokens(page or "")
        own = _items(stream)
        stream = [Token(_PAGE), *stream]
        if wrapper is None:
            slots = align(None, own, self.alphabet)
        else:
            slots = self.wrappers.get(wrapper)
            if slots is None:
                if len(self.wrappers) >= _HOSTS_AT_ONCE:
                    self.wrappers.clear()
                slots = self.wrappers[wrapper] = _load(wrapper)
        folded = _grouped(own, _units(slots), self.alphabet)
        strings = ("".join(self.alphabet[i.sign] for i in slots), "".join(self.alphabet[i.sign] for i, _ in folded))
        slot = {b: slots[a] for a, b in _matched(*strings)}
        has_main = any("m" in _slots(item.sign) for item, _ in folded)
        out, at = [], 0
        for k, (item, n) in enumerate(folded):
            keep = _kept(slot.get(k, item), has_main, slots[0].pages)
            for token in stream[at : at + n]:
                if keep and token.text is not None and token.sign[1] != "x" and (token.sign[1] == "m" or not has_main):
                    out.append(token.text)
            at += n
        return " ".join(out)


_WRAPPERS = "host string, wrapper string"


def _record(wrappers: dict[str, list[Item]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(wrappers), pa.string()), pa.array([_dump(w) for w in wrappers.values()], pa.string())], names=["host", "wrapper"]
    )


def _inferring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    alphabet, wrappers = Alphabet(), {}
    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            wrappers[host] = align(wrappers.get(host), _items(tokens(page)), alphabet)
            if len(wrappers) >= _HOSTS_AT_ONCE:
                yield _record(wrappers)
                wrappers = {}
    yield _record(wrappers)


def _merging(table: pa.Table) -> pa.Table:
    """All wrappers of a host, or of a share of it, into one."""
    alphabet, merged = Alphabet(), None
    for text in sorted(table.column("wrapper").to_pylist()):
        merged = align(merged, _load(text), alphabet) if merged is not None else _load(text)
    return pa.Table.from_batches([_record({table.column("host")[0].as_py(): merged})])


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host`` and ``wrapper`` of every host of ``pages``, from all its pages with a text.
    Pages without a host have none."""
    given = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).filter("host <> '' AND html IS NOT NULL")
    parts = given.mapInArrow(_inferring, _WRAPPERS)
    share = F.pmod(F.xxhash64("wrapper"), F.lit(SHARES)).alias("share")
    shares = parts.groupBy("host", share).applyInArrow(_merging, _WRAPPERS)
    return shares.groupBy("host").applyInArrow(_merging, _WRAPPERS)


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars``, its code points.

    Kept are the texts of the article: those inside ``article`` or ``main``, or, on pages
    without, those of slots that are neither links only nor the same text wherever they occur, on
    three pages of different contents or more that are half of the host's or more; copies of
    a page count once. Menus, headers, footers, sidebars, notices, adverts, forms,
    comments, scripts and styles are left out by element, class, id and role.
    Character references are decoded, white space inside a block becomes one space, blocks
    are joined by one space. Null, empty and wholly left-out pages give "". A page
    without a host is read by a wrapper of its own. Columns of the same names
    are replaced.
    """
    found = infer(pages, url, html).select(F.col("host").alias("__host"), F.col("wrapper").alias("__wrapper"))
    known = pages.withColumn("__host", host_of(F.col(url))).join(found, "__host", "left").drop("__host")

    def make():
        extractor = Extractor()

        def work(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            pairs = zip(texts.to_pylist(), piece.column("__wrapper").to_pylist(), strict=True)
            out = [extractor.text(page, wrapper) for page, wrapper in pairs]
            return [pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())]

        return work

    return rows.append(known, html, "text string, n_chars long", make).drop("__wrapper")
