"""Exact duplicate passages by relative Lempel-Ziv parsing (operator 3).

The reference is the corpus itself. Its index is split by anchor: the anchor of a window of ``window`` words is the
smallest hash among the 8-word grams in it, so equal windows have equal anchors and the same place of the anchor in
them, and about one word in seven starts an anchor. An index block holds everything that shares an anchor. A document is
parsed against every block that can hold a part of it:

1. A first pass counts anchors. An anchor met once cannot index a repeated window. The repeated ones fill a bitmap of a
   fixed number of bits, which every task gets; a wrong bit costs work only.
2. A second pass sends, for every anchor occurrence that passes the bitmap, the hashes of its windows to the anchor's
   block. There each window is matched with its first occurrence in corpus order. Neighbouring windows whose sources are
   neighbours too make a run. Blocks of frequent anchors, found by a second bitmap, are dealt out over 64 parts. In a part,
   occurrences with the same windows lie together and all but the first are runs at once; only the first ones meet those
   of other parts, window by window, with partial minima and joins. So no task holds such a block.
3. Per document the runs are joined greedily, left to right, into factors (start, length, source). A window that lies
   over a factor's boundary has been looked up by its own hash like any other, so parsing into factors hides nothing.

Words under a factor of at least ``window`` words are removed; those are all words of a repeated window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteforge.llm.bitmap import collect_bitmap, may_contain
from tasteforge.llm.words import Words, gram_hashes, slices, starts_of_grams, text_bytes, words_of
from tasteforge.session import materialize


@dataclass(frozen=True)
class Parsing:
    """``window`` words make a duplicate; ``gram`` words an anchor gram.

    ``filter_bits`` (a power of two) is the size of the bitmap of repeated anchors: 8 MiB, whatever the input. Anchors met
    more than ``heavy`` times are spread over tasks.
    """

    window: int = 20
    gram: int = 8
    filter_bits: int = 1 << 26
    heavy_bits: int = 1 << 22
    heavy: int = 1000


def _anchors(words: Words, cfg: Parsing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, end of windows) of each anchor occurrence, windows as word indices.

    Windows that choose the same gram place follow each other, so an occurrence is a range of windows.
    """
    starts = starts_of_grams(words, cfg.window)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none
    grams = gram_hashes(words.hash, cfg.gram)
    low = np.uint64(0xFFFFFFFF)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # ties: the leftmost gram
    width, span = cfg.window - cfg.gram + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: -(width - span)], least[width - span :])
    place = (least[starts] & low).astype(np.int64)
    cut = np.flatnonzero(place[1:] != place[:-1]) + 1
    begin = np.concatenate([[0], cut])
    end = np.concatenate([cut, [len(starts)]])
    return grams[place[begin]], starts[begin], starts[end - 1] + 1


OCCURRENCE = "a long, salt int, doc long, tag long, start int, windows binary"
RUN = "doc long, tag long, start int, n int, ref_doc long, ref_tag long, ref_start int, window long"


def _count_anchors(texts: DataFrame, cfg: Parsing) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = _anchors(words_of(part.column(2)), cfg)[0]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["a"])

    return texts.mapInArrow(run, "a long").groupBy("a").agg(F.count("*").alias("n")).where("n > 1")


def _occurrences(texts: DataFrame, repeated: np.ndarray, heavy: np.ndarray, cfg: Parsing) -> DataFrame:
    """Anchor occurrences that may repeat, with their windows' hashes. salt: -1, or a number from the document if heavy."""
    context = texts.sparkSession.sparkContext
    shared, frequent = context.broadcast(repeated), context.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column(2))
                anchor, begin, end = _anchors(words, cfg)
                met = may_contain(shared.value, anchor)
                anchor, begin, end = anchor[met], begin[met], end[met]
                if not len(anchor):
                    continue
                # Windows of all occurrences, one after another.
                sizes = end - begin
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                flat = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], sizes)
                hashes = np.ascontiguousarray(gram_hashes(words.hash, cfg.window)[flat])
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(sizes), [None, pa.py_buffer((offsets * 8).astype(np.int64)), pa.py_buffer(hashes)]
                ).cast(pa.binary())
                owner = words.doc[begin]
                docs, tags = np.asarray(part.column(0))[owner], np.asarray(part.column(1))[owner]
                salt = np.where(may_contain(frequent.value, anchor), docs & 63, -1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor.view(np.int64), salt, docs, tags, (begin - words.first[owner]).astype(np.int32))] + [packed],
                    names=["a", "salt", "doc", "tag", "start", "windows"],
                )

    return texts.mapInArrow(run, OCCURRENCE)


def _match_blocks(occurrences: DataFrame) -> DataFrame:
    """Runs (n > 0), and from heavy blocks single windows (n = 0, hash in ``window``) that other parts may have, too.

    A light block has ``heavy`` occurrences at most but for wrong bits, which only make it heavy. Of a heavy one, nothing
    but the last distinct occurrence is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen, leader = None, {}, None
        for batch in batches:
            rows = []
            anchors, salts, docs, tags, starts = (batch.column(i).to_pylist() for i in range(5))
            for a, salt, doc, tag, start, packed in zip(anchors, salts, docs, tags, starts, batch.column(5), strict=True):
                hashes = np.frombuffer(packed.as_buffer(), np.int64).tolist()
                if salt >= 0:
                    if leader and leader[:2] == (a, salt) and leader[2] == hashes:
                        if leader[3:5] != (doc, tag) or leader[5] != start:
                            rows.append((doc, tag, start, len(hashes), *leader[3:], 0))
                        continue
                    leader = (a, salt, hashes, doc, tag, start)
                    rows += [(doc, tag, start + i, 0, doc, tag, start + i, h) for i, h in enumerate(hashes)]
                    continue
                if a != current:
                    current, seen = a, {}
                last = None
                for i, h in enumerate(hashes, start):
                    source = seen.setdefault(h, (doc, tag, i))
                    if source[2] == i and source[0] == doc and source[1] == tag:
                        last = None
                    elif last and source == (last[4], last[5], last[6] + last[3]):
                        last[3] += 1
                    else:
                        last = [doc, tag, i, 1, *source, 0]
                        rows.append(last)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc", "tag", "start", "n", "ref_doc", "ref_tag", "ref_start", "window"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    order = ["a", "salt", F.when(F.col("salt") >= 0, F.col("windows")), "doc", "tag", "start"]
    return occurrences.repartition("a", "salt").sortWithinPartitions(*order).mapInArrow(run, RUN)


def _match_windows(windows: DataFrame) -> DataFrame:
    """Runs of one window each: every window against the first one with its hash."""
    here = F.struct("doc", "tag", "start")
    first = windows.groupBy("window").agg(F.min(here).alias("r"), F.count("*").alias("k")).where("k > 1").select("window", "r")
    again = windows.join(first, "window").where(here != F.col("r"))
    one = F.lit(1)
    return again.select("doc", "tag", "start", one.alias("n"), F.col("r.doc").alias("ref_doc"), F.col("r.tag").alias("ref_tag"),
                        F.col("r.start").alias("ref_start"))


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, tag, text): the tag tells apart texts that share a doc_id."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.xxhash64(body).alias("tag"), body.alias("text"))


def repeated_runs(docs: DataFrame, cfg: Parsing = Parsing(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tag, start, n, ref_doc, ref_tag, ref_start): n windows from word ``start`` on whose first occurrence, in the
    order (doc_id, tag, start), is elsewhere, with that occurrence. Runs of a document do not overlap."""
    texts = _texts(docs.where(F.col(f"`{doc_id}`").isNotNull()), doc_id, text)
    counts = materialize(_count_anchors(texts, cfg), "anchors")
    repeated = collect_bitmap(counts, "a", cfg.filter_bits)
    heavy = collect_bitmap(counts.where(F.col("n") > cfg.heavy), "a", cfg.heavy_bits)
    matched = materialize(_match_blocks(_occurrences(texts, repeated, heavy, cfg)), "runs")
    light = matched.where("n > 0").drop("window")
    return light.union(_match_windows(matched.where("n = 0")))


def greedy_factors(starts: np.ndarray, counts: np.ndarray, sources: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(first word, words, index of its first run) of each factor of one document, from its runs in order of start.

    ``sources`` has a row (ref_doc, ref_tag, ref_start) per run. A run that goes on where the last one ended, in the text
    and in the source, lengthens its factor.
    """
    out, i = [], 0
    while i < len(starts):
        first, end = i, starts[i] + counts[i]
        while i + 1 < len(starts) and starts[i + 1] == end and (
            sources[i + 1] == (sources[first][0], sources[first][1], sources[first][2] + end - starts[first])
        ).all():
            i += 1
            end += counts[i]
        out.append((int(starts[first]), int(end - starts[first] + window - 1), first))
        i += 1
    return out


def duplicate_factors(docs: DataFrame, cfg: Parsing = Parsing(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tag, start, n_words, ref_doc_id, ref_tag, ref_start): the long factors of every document, in words."""
    runs = repeated_runs(docs, cfg, doc_id, text)
    listed = _by_document(runs, sources=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, tag, parts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                places = np.array([[p["start"], p["n"]] for p in parts])
                sources = np.array([[p["ref_doc"], p["ref_tag"], p["ref_start"]] for p in parts])
                for start, n, i in greedy_factors(places[:, 0], places[:, 1], sources, cfg.window):
                    rows.append((doc, tag, start, n, *sources[i].tolist()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            names = ["doc_id", "tag", "start", "n_words", "ref_doc_id", "ref_tag", "ref_start"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return listed.mapInArrow(run, "doc_id long, tag long, start int, n_words int, ref_doc_id long, ref_tag long, ref_start int")


def _by_document(runs: DataFrame, sources: bool = False) -> DataFrame:
    """A row per document that has runs; its list is no longer than its own text."""
    fields = ["start", "n", *(["ref_doc", "ref_tag", "ref_start"] if sources else [])]
    return runs.groupBy("doc", "tag").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("parts"))


def _cover(parts, window: int, n_words: int) -> np.ndarray:
    """Which words of a document stand under a factor."""
    marks = np.zeros(n_words + 1, np.int32)
    for part in parts:
        marks[part["start"]] += 1
        marks[part["start"] + part["n"] + window - 1] -= 1
    return np.cumsum(marks[:-1]) > 0


def remove_repeated(
    docs: DataFrame, cfg: Parsing = Parsing(), doc_id: str = "doc_id", text: str = "text", single_space: bool = False
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``, the text without the words of repeated windows.

    A window of ``cfg.window`` words is repeated if the same words start earlier: in a smaller doc_id, or in the same
    document at an earlier word. Windows are judged on the input. White space before a removed word goes with it;
    ``single_space`` puts one space between kept words instead of the text's own white space. A null or empty text has no
    words. A null doc_id is compared with nothing and keeps all words. Different texts under one doc_id are taken in the
    order of a text hash; equal rows are one document, and all of them keep what it keeps. Columns of ``docs`` that are
    called n_words, n_removed or kept are replaced.
    """
    added = ["n_words", "n_removed", "kept"]
    base = docs.drop(*[c for c in added if c in docs.columns])
    names = base.columns
    whole = base.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("row"), *_keys(base, doc_id, text))
    parts = _by_document(repeated_runs(docs, cfg, doc_id, text)).withColumnsRenamed({"doc": "d", "tag": "t"})
    placed = whole.join(parts, (F.col("doc") == F.col("d")) & (F.col("tag") == F.col("t")), "left").select("row", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column(1))
                raw = data.tobytes()
                totals, removed, kept = [], [], []
                for i, runs in enumerate(part.column(2)):
                    body = raw[offsets[i] : offsets[i + 1]]
                    if not runs.is_valid:
                        words = body.split()
                        totals.append(len(words))
                        removed.append(0)
                        kept.append(b" ".join(words) if single_space else body)
                        continue
                    words = words_of(part.column(1).slice(i, 1))
                    gone = _cover(runs.as_py(), cfg.window, len(words.start))
                    totals.append(len(gone))
                    removed.append(int(gone.sum()))
                    split = body.split() if single_space else _with_space(body, words)
                    left = [w for w, g in zip(split, gone.tolist(), strict=True) if not g]
                    kept.append((b" " if single_space else b"").join(left))
                columns = [part.column(0), part.column(1), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary()).cast(pa.string())], names=["row", "text", *added])

    schema = placed.select("row", "text", F.lit(1).cast("long").alias("n_words"), F.lit(1).cast("long").alias("n_removed"), F.lit("").alias("kept")).schema
    done = placed.mapInArrow(run, schema)
    return done.select(*[F.col("text").alias(text) if c == text else F.col("row").getField(c).alias(c) for c in names], *added)


def _keys(base: DataFrame, doc_id: str, text: str) -> list:
    body = F.col(f"`{text}`").cast("string")
    return [F.col(f"`{doc_id}`").cast("long").alias("doc"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("tag"), body.alias("text")]


def _with_space(body: bytes, words: Words) -> list[bytes]:
    """The text cut after each word, so that white space belongs to the word behind it (and the last word has the rest)."""
    if not len(words.end):
        return []
    ends = words.end.tolist()
    ends[-1] = len(body)
    return [body[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
