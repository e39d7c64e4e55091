"""Main text of web pages from wrappers inferred per host (operator 1).

A page becomes a stream of text blocks, each named by its path of block elements (with class, id and role). Streams of one
host are aligned into a wrapper, a regular expression without unions over such paths: equal neighbours, and groups of
neighbours that come again, become repeated groups; what one side lacks becomes optional; differing text at a matched
place makes that place a slot, equal text leaves it a constant of the template. Wrappers align with wrappers in the same
way, so each task aligns its own pages first, and only the wrappers, a few lines per host, are shuffled: to (host, part)
and then to host. A host with a third of all pages costs no more than its share.

The wrapper says which places carry the article: those inside an article or main element (or a container named like one)
that do not lie in navigation, headers, footers, asides, forms, adverts, notices or comments. Inside it, too, constants of
the template are dropped: text that stands unchanged on half of the host's different pages, of which there must be three.
A heading stays if its container has slots, and everything stays where the slots are less than a quarter of the text, as on a
host with near copies of one page. An element with a part of a name that marks other matter (``comment-list``) is set apart if
the article has slots outside it. A host without an article element keeps the slots that are neither constants nor mostly
links; text seen on one page is no constant. All pages are then read by their host's wrapper. A page without a block at the
host's article places follows another template: it keeps its slots, and if it has none either, all its blocks that are not
set apart.

Streams are aligned along a longest common subsequence however long they are: the table takes a bit a cell, and no more than
``CELLS`` of them are held at once at each depth of its making.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteforge.llm.words import slices
from tasteforge.session import materialize

# Elements that start a block, whose ends may be left out, that hold nothing, and that hold raw text.
BLOCKS = set(
    "html head body title p div article section main header footer nav aside form ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption h1 h2 h3 h4 h5 h6 hr address fieldset legend details summary dialog menu noscript template iframe "
    "svg math button select option textarea object canvas audio video label center".split()
)
CLOSES = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head", "title"},
}
BOUNDS = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "html", "nav", "aside", "form", "blockquote"}
VOID = set("br img hr meta link input area base col embed source track wbr param".split())
RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in ("script", "style", "textarea", "title", "iframe", "noscript", "template", "xmp")}
# Elements and name parts that mark what is not the article, and those that mark the article.
APART = set("nav footer aside form noscript template iframe svg math button select option textarea menu dialog head title object canvas audio video label".split())
APART_NAMES = set(
    "ad ads advert adverts advertisement advertising adslot banner promo promotion sponsor sponsored sidebar comment comments disqus reply "
    "replies notice notices alert cookie cookies consent gdpr menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar "
    "toolbar share sharing social related recommended popular newsletter subscribe signup login popup modal overlay widget pagination pager "
    "search copyright complementary contentinfo".split()
)
ARTICLE_NAMES = set("article post entry story content main".split())
# Parts of a hyphenated name beside which a part from APART_NAMES says nothing of what the element holds.
NOT_APART = ARTICLE_NAMES | set("articles posts entries stories body text no not has with without hide hidden is".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_HASHED = re.compile(r"(?<![a-z0-9])(?=[a-z]*[0-9])(?=[0-9]*[a-z])[a-z0-9]{5,}(?![a-z0-9])")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _element(name: str, attributes: str) -> str:
    """Name with its class, id and role. Numbers in them become 0, parts that mix letters and digits one sign: they count
    pages or are made anew by each build of a site, and name no template."""
    if not attributes or "=" not in attributes:
        return name
    marks = []
    for kind, *values in _ATTRIBUTE.findall(attributes):
        value = " ".join(sorted(next((v for v in values if v), "").lower().replace("/", " ").split()))
        if value:
            marks.append(f"{kind.lower()}={re.sub(r'[0-9]+', '0', _HASHED.sub('~', value))}")
    return f"{name}[{';'.join(sorted(marks))}]" if marks else name


def blocks_of(html: str) -> list[tuple[str, str, bool]]:
    """(path, text, whether all of it is links) of each text block in page order, white space made single spaces."""
    out: list[tuple[str, str, bool]] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    linked = plain = link_depth = 0
    path, place = "", 0

    def flush() -> None:
        nonlocal linked, plain
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append((path, joined, linked > 0 and not plain))
            text.clear()
        linked = plain = 0

    def add(raw: str) -> None:
        nonlocal linked, plain
        if raw:
            text.append(unescape(raw) if "&" in raw else raw)
            if not raw.isspace():
                linked, plain = linked + (link_depth > 0), plain + (link_depth == 0)

    while found := _TAG.search(html, place):
        add(html[place : found.start()])
        place = found.end()
        closing, name, attributes = found.groups()
        if name is None:
            continue
        name = name.lower()
        if name in RAW and not closing:
            end = RAW[name].search(html, place)
            place = end.start() if end else len(html)
            continue
        if name == "br":
            text.append(" ")
        elif name == "a":
            link_depth = 0 if closing else 1
        if name not in BLOCKS:
            continue
        flush()
        if closing:
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
            link_depth = 0
        elif name not in VOID:
            ends = CLOSES.get(name, {"p"})
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    del stack[i:]
                elif stack[i][0] in BOUNDS:
                    break
            stack.append((name, _element(name, attributes)))
        path = "/".join(e for _, e in stack)
    add(html[place:])
    flush()
    return out


# A wrapper: pages seen and items in order. Item: [path, pages with it, repeated, characters, linked characters, digest of the text or None,
# the SKETCH smallest hashes of different pages with it].
Item = list
SKETCH = 8
#: Cells of the alignment table, a bit each, that are held at once at each depth of its making.
CELLS = 1 << 26


def _merge_items(a: Item, b: Item) -> Item:
    seen = a[6] if a[6] == b[6] else sorted({*a[6], *b[6]})[:SKETCH]
    return [a[0], a[1], a[2] or b[2], a[3] + b[3], a[4] + b[4], a[5] if a[5] == b[5] else None, seen]


def fold_repeats(items: list[Item], longest: int = 6) -> list[Item]:
    """Neighbouring groups with equal paths become one repeated group, shortest groups first."""
    for size in range(1, longest + 1):
        out: list[Item] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * size and [i[0] for i in out[-size:]] == [i[0] for i in out[-2 * size : -size]]:
                again = out[-size:]
                del out[-size:]
                for at, extra in enumerate(again, len(out) - size):
                    merged = _merge_items(out[at], extra)
                    merged[1], merged[2] = max(out[at][1], extra[1]), True
                    out[at] = merged
        items = out
    return items


def page_wrapper(blocks: list[tuple[str, str, bool]]) -> tuple[int, list[Item]]:
    page = blake2b("\n".join(t for _, t, _ in blocks).encode("utf-8", "surrogatepass"), digest_size=6).digest()
    seen = [int.from_bytes(page)]
    return 1, fold_repeats([[p, 1, False, len(t), len(t) * link, _digest(t), seen] for p, t, link in blocks])


def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def align(one: tuple[int, list[Item]], two: tuple[int, list[Item]]) -> tuple[int, list[Item]]:
    """The wrapper of both: a longest common sequence of paths is matched, the rest is optional, repeats are folded."""
    a, b = one[1], two[1]
    pages = one[0] + two[0]
    if [i[0] for i in a] == [i[0] for i in b]:
        out = [_merge_items(x, y) for x, y in zip(a, b, strict=True)]
        for item, x, y in zip(out, a, b, strict=True):
            item[1] = x[1] + y[1]
        return pages, out
    out, i, j = [], 0, 0
    for x, y in common_paths([i[0] for i in a], [i[0] for i in b]):
        merged = _merge_items(a[x], b[y])
        merged[1] = a[x][1] + b[y][1]
        out += [*a[i:x], *b[j:y], merged]
        i, j = x + 1, y + 1
    return pages, fold_repeats(out + a[i:] + b[j:])


def common_paths(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in order.

    Row i of the alignment table says for each place j of ``b`` whether ``b[j]`` adds to what ``a[i:]`` has in common with
    ``b[j + 1:]``: a bit, 0 if it does, the last place lowest. A row follows from the one below by arithmetic on all its bits
    at once. Rows are made from the last one up and needed from the first one down, so marks are kept and the rows between
    two marks made again.
    """
    width = len(b)
    full = (1 << width) - 1
    held = max(2, CELLS // max(1, width))
    places: dict[str, list[int]] = {}
    for j, path in enumerate(b):
        places.setdefault(path, []).append(width - 1 - j)

    def mask(path: str) -> int:
        bits = bytearray(width // 8 + 1)
        for place in places[path]:
            bits[place >> 3] |= 1 << (place & 7)
        return int.from_bytes(bits, "little")

    often = {path: mask(path) for path in sorted(places, key=lambda p: -len(places[p]))[:held]}

    def above(row: int, path: str) -> int:
        if path not in places:
            return row
        shared = row & (often[path] if path in often else mask(path))
        return (row + shared | row - shared) & full

    def rows(low: int, high: int, last: int) -> Iterator[int]:
        """Rows ``low`` to ``high`` - 1, from row ``high``."""
        step = -(-(high - low) // held)
        marks, row = [(high, last)], last
        for i in range(high - 1, low - 1, -1):
            row = above(row, a[i])
            if (i - low) % step == 0:
                marks.append((i, row))
        low, row = marks.pop()
        while marks:
            yield row
            high, last = marks.pop()
            yield from rows(low + 1, high, last) if high > low + 1 else ()
            low, row = high, last

    out: list[tuple[int, int]] = []
    if not a or not b:
        return out
    below = rows(0, len(a), full)
    common = width - next(below).bit_count()  # of a[i:] and b[j:]
    j = 0
    for i, path in enumerate(a):
        if not common:
            break
        row = next(below, full)
        rest = width - j - (row & ((1 << (width - j)) - 1)).bit_count()  # of a[i + 1:] and b[j:]
        bits = b"" if path == b[j] or rest == common else row.to_bytes(width // 8 + 1, "little")
        while path != b[j] and rest < common:
            place = width - 1 - j
            rest -= not bits[place >> 3] >> (place & 7) & 1
            j += 1
        if path == b[j]:
            out.append((i, j))
            common, j = common - 1, j + 1
    return out


def pattern(wrapper: tuple[int, list[Item]]) -> str:
    """The wrapper as text: ``?`` optional, ``+`` repeated, ``*`` both; ``#text`` marks a slot."""
    pages, items = wrapper
    sign = lambda i: ("*" if i[1] < pages else "+") if i[2] else ("?" if i[1] < pages else "")
    return " ".join(f"({i[0]}{'' if i[5] is not None else ' #text'}){sign(i)}" for i in items)


def _names(element: str) -> set[str]:
    """The tokens of class, id and role, each as a whole."""
    marks = (mark.partition("=")[2] for mark in element.partition("[")[2].removesuffix("]").split(";"))
    return {token for mark in marks for token in mark.split()}


def _standing(path: str) -> tuple[bool, bool]:
    """(inside an article, apart from it) by the elements of a path, outermost first."""
    article = False
    for element in path.split("/"):
        name, names = element.partition("[")[0], _names(element)
        here = name in ("article", "main") or bool(names & ARTICLE_NAMES)
        if name in APART or names & APART_NAMES or (name == "header" or "header" in names) and not (article or here):
            return article, True
        article = article or here
    return article, False


def _suspects(path: str) -> Iterator[str]:
    """The parts of a path down to each element that has a part of a name from ``APART_NAMES``."""
    elements = path.split("/")
    for depth, element in enumerate(elements, 1):
        for token in _names(element):
            parts = set(re.split("[-_]+", token))
            if parts & APART_NAMES and not parts & NOT_APART:
                yield "/".join(elements[:depth])
                break


def _is_heading(path: str) -> bool:
    return path.rpartition("/")[2].partition("[")[0] in HEADINGS


def content_tiers(wrapper: tuple[int, list[Item]]) -> list[list[str]]:
    """Paths of the blocks that make the article, best first; a page is read by the first of these that it has a block of."""
    pages, items = wrapper
    standing = {i[0]: _standing(i[0]) for i in items}
    chars: dict[str, list[int]] = {}
    fixed: dict[str, bool] = {}
    seen_on: dict[str, set[int]] = {}
    for path, seen, _, n, links, text, sketch in items:
        total = chars.setdefault(path, [0, 0, 0])
        total[0], total[1], total[2] = total[0] + n, total[1] + links, total[2] + seen
        fixed[path] = fixed.get(path, True) and text is not None
        seen_on.setdefault(path, set()).update(sketch)
    free = [p for p, (_, apart) in standing.items() if not apart and 2 * chars[p][1] <= chars[p][0]]
    slots = [p for p in free if not fixed[p] or chars[p][2] == 1]
    inside = [p for p, (article, apart) in standing.items() if article and not apart]
    different = set(sorted(set().union(*seen_on.values()))[:SKETCH])
    constant = {p for p in inside if fixed[p] and len(different) > 2 and 2 * len(seen_on[p] & different) >= len(different)}
    for element in sorted({e for p in inside for e in _suspects(p)}, key=lambda e: (e.count("/"), e)):
        rest = [p for p in inside if not f"{p}/".startswith(f"{element}/")]
        if any(p not in constant and not _is_heading(p) for p in rest):
            inside = rest
    free_inside = [p for p in inside if p not in constant]
    held = {p[:n] for p in free_inside for n in range(len(p)) if p[n] == "/"}
    varied = [p for p in inside if p not in constant or _is_heading(p) and p.rpartition("/")[0] in held]
    if 4 * sum(chars[p][0] for p in free_inside) < sum(chars[p][0] for p in inside):
        varied = inside
    tiers = (varied, inside if varied != inside else [], slots if pages > 1 else [], free)
    return [sorted(tier) for tier in tiers if tier]


def content_paths(wrapper: tuple[int, list[Item]]) -> list[str]:
    """Paths of the blocks that make the article on pages of the host's usual template."""
    return next(iter(content_tiers(wrapper)), [])


def page_text(html: str | None, tiers: list[set[str]]) -> str:
    blocks = blocks_of(html) if html else []
    return next((" ".join(found) for keep in tiers if (found := [t for p, t, _ in blocks if p in keep])), "")


def host_of(url: Column | str) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _fold(wrappers: Iterable[str]) -> tuple[int, list[Item]]:
    total: tuple[int, list[Item]] | None = None
    for text in sorted(wrappers):
        one = json.loads(text)
        total = (one[0], one[1]) if total is None else align(total, (one[0], one[1]))
    return total or (0, [])


def host_wrappers(pages: DataFrame, html: str = "html", url: str = "url", held_hosts: int = 2000) -> DataFrame:
    """(host, wrapper): the wrapper as JSON ``[pages, items]``, over all pages of the host that have html."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, list[Item]]] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())], names=["host", "wrapper"])
            held.clear()
            return batch

        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = page_wrapper(blocks_of(text.as_py()))
                held[host] = align(held[host], own) if host in held else own
                if len(held) > held_hosts:
                    yield out()
        if held:
            yield out()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(_fold(group["wrapper"]))]})

    rows = pages.select(F.coalesce(host_of(F.col(f"`{url}`")), F.lit("")).alias("host"), F.col(f"`{html}`").cast("string").alias("html"))
    partial = rows.where("html is not null").mapInArrow(local, "host string, wrapper string")
    spread = partial.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(32)))
    kind = "host string, wrapper string"
    return spread.groupBy("host", "part").applyInPandas(merge, kind).groupBy("host").applyInPandas(merge, kind)


def extract_text(pages: DataFrame, html: str = "html", url: str = "url", text: str = "text") -> DataFrame:
    """``pages`` without html, with ``text``: the article's blocks in page order, joined by one space.

    Character references are decoded once, white space inside a block is one space. A null or empty html gives an empty
    text. Pages whose url has no host (or is null) share one wrapper. Repeated rows are kept; a column already called like
    ``text`` is replaced.
    """
    rest = [c for c in pages.columns if c not in (html, text)]
    wrappers = host_wrappers(pages, html, url)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [content_tiers(tuple(json.loads(w))) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keep, pa.list_(pa.list_(pa.string())))], names=["__host", "__keep"])

    places = materialize(wrappers.mapInArrow(decide, "__host string, __keep array<array<string>>"), "wrappers")
    source = pages.select(
        *[f"`{c}`" for c in rest], F.coalesce(host_of(F.col(f"`{url}`")), F.lit("")).alias("__host"), F.col(f"`{html}`").cast("string").alias("__html")
    )
    # Unhinted: broadcast while the stored wrappers are small, else a join whose hot hosts are split at run time.
    placed = source.join(places, "__host", "left").drop("__host")
    schema = pages.select(*[f"`{c}`" for c in rest], F.lit("").alias(text)).schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[tuple, list[set[str]]] = {}
        for batch in batches:
            for part in slices(batch, "__html", 4 << 20):
                texts = []
                for body, keep in zip(part.column(part.num_columns - 2), part.column(part.num_columns - 1).to_pylist(), strict=True):
                    key = tuple(map(tuple, keep or ()))
                    if len(sets) > 5000:
                        sets.clear()
                    if key not in sets:
                        sets[key] = [set(tier) for tier in key]
                    texts.append(page_text(body.as_py(), sets[key]))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(texts, pa.string())], names=[*rest, text])

    return placed.mapInArrow(read, schema)
