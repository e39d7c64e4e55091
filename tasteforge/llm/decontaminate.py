"""Benchmark decontamination by template canonicalisation (operator 7).

A text becomes a sequence of symbols: punctuation is dropped and case folded, a token that begins with a digit becomes
NUM, a unit word behind it UNIT, and a run of words in title case inside a sentence NAME. Windows of symbols are hashed and
joined with the windows of the benchmark items, so a question is found whatever values stand in its slots. For each item
and alignment the slot values are then compared: one item value must always stand against one document value. That
separates a copy with other parameters from an accidental template match.

A capitalised word at the start of a sentence may be a name or not, so windows over one are looked up both ways.

Every window of an item is also looked up word for word, on the folded words before any of them becomes a slot. So a
verbatim copy is found however many of its words are numbers, units or names, and however short it is.

Items that differ in slot values only, equal values standing at the same slots, are one class, and documents are joined with
the windows of classes: a question that a benchmark asks with a thousand values costs a document one row, not a thousand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteforge.llm.bitmap import collect_bitmap, may_contain
from tasteforge.llm.words import Words, gram_hashes, mix, slices, starts_of_grams, text_bytes, words_in, words_of
from tasteforge.session import materialize

# Unit words, folded, that count as a unit behind a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce "
    "ounces ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years percent degree degrees c f k v volt volts w watt watts kw j joule joules n newton newtons "
    "hz khz mhz ghz b kb mb gb tb dollar dollars cent cents euro euros usd eur gbp kmh mph meter meters metre metres kilometer kilometers"
).split()


@dataclass(frozen=True)
class Templates:
    """Windows of ``window`` symbols, at least ``literals`` of them plain words, and windows of ``window`` words as they are.

    An item counts as contained if ``run`` of its symbols in a row stand on one consistent alignment, however long it is, or
    if windows on consistent alignments make up ``coverage`` of its windows. ``filter_bits``, a power of two, is the size of
    the bitmap of item windows that every task gets: 512 KiB, whatever the benchmark.
    """

    window: int = 8
    literals: int = 4
    coverage: float = 0.5
    run: int = 11
    filter_bits: int = 1 << 22


_NUM, _UNIT, _NAME = (np.uint64(x) for x in (0x1111111111111111, 0x2222222222222222, 0x3333333333333333))
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[0x80:] = _ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = True
_KEEP = _ALNUM.copy()
_KEEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_STOP = np.zeros(256, dtype=np.uint8)
_STOP[[0x2E, 0x21, 0x3F, 0x0A]] = 1


@dataclass
class Symbols:
    """Symbols of some texts. ``plain`` reads a sentence's first word as a word, ``named`` as a name if capitalised."""

    plain: np.ndarray
    named: np.ndarray
    value: np.ndarray  # hash of the folded token behind each symbol
    literal: np.ndarray  # whether ``plain`` is the token itself
    doc: np.ndarray
    first: np.ndarray
    words: Words  # all folded words, before runs of names become one symbol


def symbols_of(column: pa.Array) -> Symbols:
    data, offsets = text_bytes(column)
    upper = _UPPER[data]
    folded = data + upper.astype(np.uint8) * np.uint8(0x20)
    lead = np.flatnonzero(data[:-1] == 0xC3)  # Latin-1 letters, capitals at 0x80-0x9E behind 0xC3
    tail = data[lead + 1]
    lead = lead[(tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)]
    upper[lead] = True
    folded[lead + 1] += np.uint8(0x20)
    keep = _KEEP[data]
    sentence = np.cumsum(_STOP[data], dtype=np.uint32)
    places = np.concatenate([[0], np.cumsum(keep)])
    words = words_in(folded[keep], places[offsets])
    n = len(words.start)
    if not n:
        none = np.zeros(0, np.uint64)
        return Symbols(none, none, none, none.astype(bool), words.doc, words.first, words)
    opening = words.data[words.start]
    capital, sentence = upper[keep], sentence[keep][words.start]
    second = words.start + 1 + (opening >= 0x80)
    # Title case only: words in capitals throughout, and single letters, are plain words.
    capital = capital[words.start] & (second < words.end) & ~capital[np.minimum(second, len(capital) - 1)]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (sentence[1:] != sentence[:-1]) | (words.doc[1:] != words.doc[:-1])
    number = (opening >= 0x30) & (opening <= 0x39)
    unit = np.zeros(n, dtype=bool)
    behind = np.flatnonzero(number[:-1]) + 1
    unit[behind] = np.isin(words.hash[behind], _unit_hashes()) & ~fresh[behind]
    capital &= ~number & ~unit
    inner = capital & ~fresh
    plain = words.hash.copy()
    plain[number], plain[unit], plain[inner] = _NUM, _UNIT, _NAME
    named = plain.copy()
    named[capital] = _NAME
    stays = np.ones(n, dtype=bool)
    stays[1:] = ~(inner[1:] & inner[:-1])  # a run of names inside a sentence is one slot
    first = np.concatenate([[0], np.cumsum(stays)])[words.first]
    literal = ~(number | unit | inner)
    return Symbols(plain[stays], named[stays], words.hash[stays], literal[stays], words.doc[stays], first, words)


def _unit_hashes() -> np.ndarray:
    return words_of(pa.array([" ".join(UNITS)])).hash


def windows_of(symbols: Symbols, size: int, cfg: Templates) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, starts, slots) for both readings; slots marks, per symbol, what is a slot in that reading.

    The second reading yields only windows that differ from the first.
    """
    n = len(symbols.plain) - size + 1
    if n <= 0:
        return
    starts = np.flatnonzero(symbols.doc[:n] == symbols.doc[size - 1 :])
    named = symbols.literal & (symbols.plain == symbols.named)
    need = min(cfg.literals, size)
    for reading, literal, only in ((symbols.plain, symbols.literal, None), (symbols.named, named, symbols.literal & ~named)):
        count = np.concatenate([[0], np.cumsum(literal, dtype=np.int32)])
        use = starts[count[starts + size] - count[starts] >= need]
        if only is not None:
            differs = np.concatenate([[0], np.cumsum(only, dtype=np.int32)])
            use = use[differs[use + size] > differs[use]]
        hashes = mix(gram_hashes(reading, size) + np.uint64(size))
        yield hashes[use], use, ~literal


_VERBATIM = np.uint64(0x4444444444444444)


def verbatim_windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of all windows of ``size`` words."""
    starts = starts_of_grams(words, size)
    return mix(gram_hashes(words.hash, size)[starts] + _VERBATIM + np.uint64(size)), starts


def _slot_values(values: np.ndarray, start: int, size: int, slot: np.ndarray) -> list[int]:
    return values[start : start + size][slot[start : start + size]].view(np.int64).tolist()


def classes_of(symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """(class of each text, per symbol the number of its slot value among the values of its text, in order of appearance).

    Texts of one class have the same symbols, slots and number of words, and the same slots hold equal values.
    """
    numbers = np.zeros(len(symbols.plain), np.int64)
    classes = np.zeros(len(symbols.first) - 1, np.int64)
    slot = ~(symbols.literal & (symbols.plain == symbols.named))
    for i, (begin, end) in enumerate(zip(symbols.first[:-1].tolist(), symbols.first[1:].tolist(), strict=True)):
        at = begin + np.flatnonzero(slot[begin:end])
        _, earliest, which = np.unique(symbols.value[at], return_index=True, return_inverse=True)
        numbers[at] = 1 + np.argsort(np.argsort(earliest))[which]
        n_words = int(symbols.words.first[i + 1] - symbols.words.first[i])
        facts = (symbols.named[begin:end], symbols.literal[begin:end], numbers[begin:end], np.array([n_words]))
        code = blake2b(b"".join(x.tobytes() for x in facts), digest_size=8).digest()
        classes[i] = int.from_bytes(code, signed=True)
    return classes, numbers


WINDOW = "key long, id long, tag long, verbatim boolean, place int, slots array<long>"
ITEM_WINDOW = f"{WINDOW}, class long, pattern array<long>"


def _window_rows(rows: DataFrame, cfg: Templates, sizes: tuple[list[int], list[int]] | None, bitmap: np.ndarray | None) -> DataFrame:
    """(key, id, tag, verbatim, place, slots) of windows: all windows of items, or those of documents that pass the bitmap.

    Items have class, and pattern: the numbers of the slots' values within the item. Items (``sizes`` is None) shorter than the window are one window of their own length, in symbols and in words. Places
    count symbols, or words where ``verbatim``; there slots is empty. A document's window that is a whole item is one row.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                symbols = symbols_of(part.column(2))
                words = symbols.words
                keys, owners, verbatim, places, slots, patterns = [], [], [], [], [], []
                classes, numbers = classes_of(symbols) if sizes is None else (None, None)

                def add(size, hashes, starts, doc, first, slot=None):
                    if shared is not None:
                        met = may_contain(shared.value, hashes)
                        hashes, starts = hashes[met], starts[met]
                        if slot is None and size < cfg.window:
                            once = np.unique(mix(hashes + mix(doc[starts].astype(np.uint64))), return_index=True)[1]
                            hashes, starts = hashes[once], starts[once]
                    elif size < cfg.window:
                        whole = np.diff(first)[doc[starts]] == size
                        hashes, starts = hashes[whole], starts[whole]
                    keys.extend(hashes.view(np.int64).tolist())
                    owners.extend(doc[starts].tolist())
                    verbatim.extend([slot is None] * len(starts))
                    places.extend((starts - first[doc[starts]]).tolist())
                    slots.extend([] if slot is None else _slot_values(symbols.value, s, size, slot) for s in starts.tolist())
                    if sizes is None:
                        patterns.extend([] if slot is None else _slot_values(numbers, s, size, slot) for s in starts.tolist())

                own, own_words = (_own_sizes(x.first, cfg) for x in (symbols, words)) if sizes is None else sizes
                for size in {cfg.window, *own} - {1, 2}:
                    for hashes, starts, slot in windows_of(symbols, size, cfg):
                        add(size, hashes, starts, symbols.doc, symbols.first, slot)
                for size in {cfg.window, *own_words}:
                    add(size, *verbatim_windows(words, size), words.doc, words.first)
                owners = np.array(owners, np.int64)
                columns = [pa.array(keys, pa.int64()), part.column(0).take(pa.array(owners)), part.column(1).take(pa.array(owners)),
                           pa.array(verbatim, pa.bool_()), pa.array(places, pa.int32()), pa.array(slots, pa.list_(pa.int64()))]
                names = ["key", "id", "tag", "verbatim", "place", "slots"]
                if sizes is None:
                    columns += [pa.array(classes[owners]), pa.array(patterns, pa.list_(pa.int64()))]
                    names += ["class", "pattern"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, ITEM_WINDOW if sizes is None else WINDOW)


def _own_sizes(first: np.ndarray, cfg: Templates) -> list[int]:
    """Lengths below the window, 0 apart."""
    sizes = np.unique(np.diff(first))
    return sizes[(sizes > 0) & (sizes < cfg.window)].tolist()


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(body).alias("tag"), body.alias("text"))


def template_matches(
    docs: DataFrame, items: DataFrame, cfg: Templates = Templates(),
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, tag, item_id, coverage, exact) for every class of items that a document contains; item_id is the smallest of
    the class, whose members ``item_classes`` lists.

    coverage is the share of the class's windows found on alignments whose slots are consistent, small for a short quote of a
    long item; exact tells that all windows have the values of an item of the class. Of an alignment that is not consistent
    the windows with an item's own values count if they make ``run`` symbols in a row. ``tag`` is a hash of the text. Null ids
    take no part, null texts have no windows, and equal rows count once. An item that is mostly slots, or has fewer than three
    symbols, is found word for word only: with other values nothing would tell it from chance. An item without a word is never
    found. A match is decided for each (doc_id, text), so texts that share a doc_id do not complete each other.
    """
    bench = _window_rows(_rows(items, item_id, item_text).where("id is not null").distinct(), cfg, None, None)
    bench = materialize(bench, "templates")
    sizes = bench.groupBy("class", "verbatim").agg(F.countDistinct("place").alias("n_windows"), F.min("id").alias("item"))
    sizes = materialize(sizes, "items")
    known = bench.select("key", "class", F.col("place").alias("item_place"), "pattern").distinct()
    # Which values stand where in some item of the class.
    values = bench.select("key", "class", F.col("place").alias("item_place"), F.xxhash64("slots").alias("values"), F.lit(True).alias("own")).distinct()
    found = _window_rows(_rows(docs, doc_id, text).where("id is not null"), cfg, _short_sizes(items, cfg, item_text), collect_bitmap(bench, "key", cfg.filter_bits))
    hits = found.join(known, "key").where(F.size("slots") == F.size("pattern")).withColumn("values", F.xxhash64("slots"))
    hits = hits.join(values, ["key", "class", "item_place", "values"], "left").withColumn("own", F.coalesce("own", F.lit(False)))
    pairs = F.arrays_zip(F.col("pattern").alias("i"), F.col("slots").alias("d"))
    aligned = hits.groupBy("id", "tag", "class", "verbatim", (F.col("place") - F.col("item_place")).alias("shift")).agg(
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"), F.collect_set("item_place").alias("places"),
        F.collect_set(F.when(F.col("own"), F.col("item_place"))).alias("same"), F.min("own").alias("own"),
    )  # no longer than the item
    aligned = aligned.withColumn("consistent", F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"]))))
    aligned = aligned.withColumn("places", F.when(F.col("consistent"), F.col("places")).otherwise(F.col("same")))
    aligned = aligned.withColumn("run", _longest_run("places", cfg)).where(F.col("consistent") | (F.col("run") >= cfg.run))
    whole = aligned.groupBy("id", "tag", "class", "verbatim").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"),
        F.max("run").alias("run"),
        F.min(~F.col("consistent") | F.col("own")).alias("exact"),
    )
    return (
        whole.join(sizes, ["class", "verbatim"])
        .groupBy("id", "tag", "class")
        .agg(F.max(F.col("n") / F.col("n_windows")).alias("coverage"), F.max("run").alias("run"), F.min("exact").alias("exact"), F.min("item").alias("item"))
        .where((F.col("coverage") >= cfg.coverage) | (F.col("run") >= cfg.run))
        .select(F.col("id").alias("doc_id"), "tag", F.col("item").alias("item_id"), "coverage", "exact")
    )


def item_classes(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, class_id) for every item with an id: class_id is the smallest item_id of those that differ from the item in
    slot values only. Items without a word, or without a text, are one class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(classes_of(symbols_of(part.column(2)))[0])], names=["id", "class"])

    classes = _rows(items, item_id, text).where("id is not null").distinct().mapInArrow(run, "id long, class long").distinct()
    least = classes.groupBy("class").agg(F.min("id").alias("class_id"))
    return classes.join(least, "class").select(F.col("id").alias("item_id"), "class_id")


def _longest_run(places: str, cfg: Templates) -> Column:
    """Most symbols in a row that the windows at ``places`` cover; windows that touch or overlap make one run."""
    size = F.lit(cfg.window)

    def add(held: Column, place: Column) -> Column:
        begin = F.when(place - held["last"] <= size, held["begin"]).otherwise(place)
        return F.struct(begin.alias("begin"), place.alias("last"), F.greatest(held["run"], place + size - begin).alias("run"))

    none = F.struct(F.lit(0).alias("begin"), F.lit(-cfg.window - 1).alias("last"), F.lit(0).alias("run"))
    return F.aggregate(F.array_sort(places), none, add, lambda held: held["run"])


def _short_sizes(items: DataFrame, cfg: Templates, text: str) -> tuple[list[int], list[int]]:
    """Which window sizes below ``window`` some item needs, in symbols and in words: at most 2 * (window - 1) numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = symbols_of(batch.column(0))
            own = [(kind, n) for kind, first in ((False, symbols.first), (True, symbols.words.first)) for n in _own_sizes(first, cfg)]
            yield pa.RecordBatch.from_pylist([{"verbatim": v, "n": n} for v, n in own], pa.schema([("verbatim", pa.bool_()), ("n", pa.int32())]))

    body = items.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    found = body.mapInArrow(run, "verbatim boolean, n int").distinct().collect()
    return sorted(r.n for r in found if not r.verbatim), sorted(r.n for r in found if r.verbatim)


def contaminated_documents(docs: DataFrame, items: DataFrame, cfg: Templates = Templates(), **columns: str) -> DataFrame:
    """(doc_id, tag, item_ids, coverage, exact) for each document that contains an item; item_ids, sorted, has one item for
    each class of items that it contains."""
    return template_matches(docs, items, cfg, **columns).groupBy("doc_id", "tag").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage"), F.max("exact").alias("exact")
    )


def flag_contaminated(docs: DataFrame, items: DataFrame, cfg: Templates = Templates(), doc_id: str = "doc_id", text: str = "text", **columns: str) -> DataFrame:
    """(doc_id, contaminated, item_ids, coverage, exact) for every row of ``docs``; clean rows have an empty list."""
    found = contaminated_documents(docs, items, cfg, doc_id=doc_id, text=text, **columns).withColumnsRenamed({"doc_id": "d", "tag": "t"})
    keys = _rows(docs, doc_id, text).select("id", "tag")
    return keys.join(found, (F.col("id") == F.col("d")) & (F.col("tag") == F.col("t")), "left").select(
        F.col("id").alias("doc_id"),
        F.col("d").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("exact", F.lit(False)).alias("exact"),
    )
