"""Phrase collocations per language by SON partitioning.

A shard is a bounded run of texts inside a task. For each phrase length in turn every shard is mined completely, at a
support lowered to its share of the language's words (rounded up, 1 at least): a phrase frequent overall reaches that in
some shard. Locally frequent phrases are united as 64-bit keys with their counts, and since a shard that says nothing of a
phrase holds it fewer times than its own support, the sum bounds the phrase's count from above; what cannot reach the
support is dropped. The rest fills a bitmap of a fixed number of bits that the next length looks its two parts up in (no
phrase is more frequent than its parts). In the end one pass counts all candidates of all lengths exactly, by their words.

Shards are small, so a task mines many and unites what they found before it sends anything. Where shards are so many
that the local support is 1 everywhere, the bound is the count itself, so candidates are the frequent phrases only; what
travels then is one key for each different phrase of a task whose parts are frequent. Keys are 64-bit hashes: two phrases
of one task would have to share one, and one of them be frequent, to change a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteforge.llm.bitmap import collect_bitmap, may_contain
from tasteforge.llm.words import gram_hashes, mix, slices, text_bytes, words_in
from tasteforge.session import materialize

NO_LANG = "und"
# A word, seen from the whole text: neither white space nor what ends a piece.
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[0x41:0x5B] += 0x20
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[*b".,;:!?\n\x0b\x0c\r"]] = True
_FOLDED[_BREAKS] = 0x0A
_WHOLE = "decimal(38,0)"


@dataclass(frozen=True)
class Phrases:
    """Phrases of 2 to ``longest`` words met ``support`` times; one is dropped if a longer one around it has ``cover`` per
    cent of its count; ``top`` are listed per language.

    A shard holds ``shard_bytes`` of text, or one longer text; the exact count goes over ``count_bytes`` at a time. A task
    sends what it mined on when it holds ``held`` phrases, and what it counted at ``counted``. ``filter_bits`` (a power of two) is the size of the bitmap of
    candidates, 16 MiB; a wrong bit costs work only. The ``known`` languages with the most words get lowered supports;
    any other is mined at support 1, which is complete too.
    """

    support: int = 100
    longest: int = 5
    cover: int = 100
    top: int = 2000
    shard_bytes: int = 512 << 10
    count_bytes: int = 4 << 20
    held: int = 500_000
    counted: int = 500_000
    filter_bits: int = 1 << 27
    known: int = 10_000


@dataclass
class _Words:
    """Words of one language in a shard: a key each, and the number of the piece they are in."""

    keys: list = field(default_factory=list)
    pieces: list = field(default_factory=list)
    spans: list = field(default_factory=list)  # (bytes, starts, ends), if texts are wanted

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(self.keys), np.concatenate(self.pieces)


def _shards(batches: Iterator[pa.RecordBatch], size: int, texts: bool) -> Iterator[dict[str, _Words]]:
    """Shards of about ``size`` bytes of (lang, text) batches, as words by language."""
    shard, held, next_piece = {}, 0, 0
    for batch in batches:
        for part in slices(batch, "text", min(size // 2, 1 << 20)):
            data, offsets = text_bytes(part.column("text"))
            cut = np.concatenate([[0], np.cumsum(_BREAKS[data], dtype=np.int32)])
            folded = _FOLDED[data]
            words = words_in(folded, offsets)
            if len(words.hash):
                other = (np.diff(cut[words.start]) != 0) | (np.diff(words.doc) != 0)
                pieces = next_piece + np.concatenate([[0], np.cumsum(other)])
                next_piece = int(pieces[-1]) + 1
                langs = pc.dictionary_encode(part.column("lang"))
                lang_of = langs.indices.to_numpy()[words.doc]
                whole = folded.tobytes() if texts else None
                for code, lang in enumerate(langs.dictionary.to_pylist()):
                    mine = np.flatnonzero(lang_of == code)
                    if not len(mine):
                        continue
                    into = shard.setdefault(lang, _Words())
                    into.keys.append(words.hash[mine])
                    into.pieces.append(pieces[mine])
                    if texts:
                        into.spans.append((whole, words.start[mine], words.end[mine]))
            held += len(data)
            if held >= size:
                yield shard
                shard, held = {}, 0
    if shard:
        yield shard


def _lang_key(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


def _grams(lang: str, keys: np.ndarray, k: int) -> np.ndarray:
    """Keys of each k consecutive words, by language."""
    return mix(gram_hashes(keys, k) ^ _lang_key(lang))


def _starts(pieces: np.ndarray, k: int) -> np.ndarray:
    return np.flatnonzero(pieces[: max(0, len(pieces) - k + 1)] == pieces[k - 1 :])


def _local_support(words: int, sizes: dict[str, int], lang: str, cfg: Phrases) -> int:
    """The support times the shard's share of the language's words, rounded up."""
    return max(1, -(-cfg.support * words // sizes[lang])) if lang in sizes else 1


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and their counts added up."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def _cut(columns: list[pa.Array], names: list[str], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Columns as batches of a bounded number of rows."""
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    return (batch.slice(at, rows) for at in range(0, max(1, batch.num_rows), rows))


def _miner(k: int, sizes: dict[str, int], bitmap, cfg: Phrases) -> Callable:
    """Locally frequent phrases of k words: (lang, key, excess), where excess is the count over what a silent shard may hold.

    Shards of a task are united before they are sent. A row without a key gives what silent shards may hold.
    """

    def united(found: dict[str, list], silent: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for lang, parts in found.items():
            keys, excess = _summed(*(np.concatenate(c) for c in zip(*parts)))
            yield from _cut(
                [
                    pa.repeat(lang, len(keys) + 1),
                    pa.array(np.append(keys.view(np.int64), 0), pa.int64(), mask=np.arange(len(keys) + 1) == len(keys)),
                    pa.array(np.append(excess, silent[lang]), pa.int64()),
                ],
                ["lang", "key", "excess"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, silent, held = {}, {}, 0
        for shard in _shards(batches, cfg.shard_bytes, texts=False):
            for lang, words in shard.items():
                keys, pieces = words.joined()
                least = _local_support(len(keys), sizes, lang, cfg)
                at = _starts(pieces, k)
                if k > 1:
                    known = may_contain(bitmap.value, _grams(lang, keys, k - 1))
                    at = at[known[at] & known[at + 1]]
                grams, counts = np.unique(_grams(lang, keys, k)[at], return_counts=True)
                frequent = counts >= least
                found.setdefault(lang, []).append((grams[frequent], counts[frequent] - (least - 1)))
                silent[lang] = silent.get(lang, 0) + least - 1
                held += int(frequent.sum())
            if held >= cfg.held:
                yield from united(found, silent)
                found, silent, held = {}, {}, 0
        yield from united(found, silent)

    return run


class _Tally:
    """Counts of different phrases by key; the text of each is kept from where it was met first."""

    def __init__(self) -> None:
        self.keys, self.counts, self.phrases = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)
        self.langs, self.words = np.zeros(0, object), np.zeros(0, np.int32)

    def add(self, lang: str, k: int, grams: np.ndarray, counts: np.ndarray, text_of: Callable) -> None:
        place = np.searchsorted(self.keys, grams)
        old = np.zeros(len(grams), bool)
        inside = place < len(self.keys)
        old[inside] = self.keys[place[inside]] == grams[inside]
        self.counts[place[old]] += counts[old]
        new, at = np.flatnonzero(~old), place[~old]
        self.keys, self.counts = np.insert(self.keys, at, grams[new]), np.insert(self.counts, at, counts[new])
        self.phrases, self.langs = np.insert(self.phrases, at, text_of(new)), np.insert(self.langs, at, lang)
        self.words = np.insert(self.words, at, k)

    def batches(self) -> Iterator[pa.RecordBatch]:
        columns = [pa.array(self.langs, pa.string()), pa.array(self.words), pa.array(self.phrases, pa.string()), pa.array(self.counts)]
        return _cut(columns, ["lang", "words", "phrase", "n"])


def _counter(bitmap, cfg: Phrases) -> Callable:
    """Exact counts of candidates in a task: (lang, words, phrase, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for shard in _shards(batches, cfg.count_bytes, texts=True):
            for lang, words in shard.items():
                keys, pieces = words.joined()
                first = np.cumsum([0] + [len(k) for k in words.keys])
                for k in range(1, cfg.longest + 1):
                    grams, at = _grams(lang, keys, k), _starts(pieces, k)
                    at = at[may_contain(bitmap.value, grams[at])]
                    found, one, counts = np.unique(grams[at], return_index=True, return_counts=True)
                    tally.add(lang, k, found, counts, lambda new: _phrases(words.spans, first, at[one[new]], k))
            if len(tally.keys) >= cfg.counted:
                yield from tally.batches()
                tally = _Tally()
        yield from tally.batches()

    return run


def _phrases(spans: list, first: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k words from each place in ``at``, joined by a space; a phrase lies in one text, so in one slice."""
    out = np.zeros(len(at), object)
    part = np.searchsorted(first, at, side="right") - 1
    for s in np.unique(part):
        data, starts, ends = spans[s]
        chosen = np.flatnonzero(part == s)
        for i, j in zip(chosen.tolist(), (at[chosen] - first[s]).tolist()):
            out[i] = b" ".join([data[a:b] for a, b in zip(starts[j : j + k], ends[j : j + k])]).decode()
    return out


def phrase_counts(texts: DataFrame, sizes: DataFrame, cfg: Phrases = Phrases()) -> DataFrame:
    """(lang, words, phrase, n): all phrases of 1 to ``longest`` words met ``support`` times or more (runs jobs).

    ``texts`` has (lang, text), ``sizes`` (lang, n words), stored.
    """
    context = texts.sparkSession.sparkContext
    largest = sizes.where(F.col("n") >= cfg.support).orderBy(F.col("n").desc(), "lang").limit(cfg.known).collect()
    known = {r["lang"]: r["n"] for r in largest}
    candidates, shared = np.zeros(cfg.filter_bits // 64, np.uint64), None
    for k in range(1, cfg.longest + 1):
        local = texts.mapInArrow(_miner(k, known, shared, cfg), "lang string, key bigint, excess bigint")
        united = materialize(local.groupBy("lang", "key").agg(F.sum("excess").alias("excess")), f"phrases-{k}")
        silent = united.where("key is null and excess > 0").limit(cfg.known).collect()
        allowed = F.lit(0)
        for r in silent:
            allowed = F.when(F.col("lang") == r["lang"], F.lit(r["excess"])).otherwise(allowed)
        bound = F.col("excess") + allowed
        level = collect_bitmap(united.where(F.col("key").isNotNull() & (bound >= cfg.support)), "key", cfg.filter_bits)
        candidates |= level
        shared = context.broadcast(level)
    # Few tasks: one that goes over more text adds more counts up before it sends them, and candidates are few.
    texts = texts.coalesce(2 * context.defaultParallelism)
    counted = texts.mapInArrow(_counter(context.broadcast(candidates), cfg), "lang string, words int, phrase string, n bigint")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= cfg.support)


def collocations(docs: DataFrame, cfg: Phrases = Phrases(), text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, words, cut): the best phrases of each language.

    A-Z are folded, texts cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs; a phrase does
    not leave its piece. ``a`` is its count, ``l`` and ``r`` those of the parts of its worst cut (after ``cut`` words),
    ``n`` the words of the language, and the score floor(1000 a n / (l r)), in exact decimals.

    Defined cases. A null language is ``und``. A null or empty text has no words. Repeated rows count each time. A
    language with fewer than ``support`` words has no rows; an empty table gives an empty result. Other columns take no part.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    sizes = materialize(texts.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(WORD)).cast("bigint")).alias("n")), "phrase-langs")
    counts = materialize(phrase_counts(texts, sizes, cfg), "phrase-counts")
    # A longer phrase around a phrase, with its count, has one of one word more in between that is as frequent.
    inner = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    around = counts.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("around"))
    around = around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = counts.where("words > 1").join(around, ["lang", "phrase"], "left")
    kept = kept.where(F.col("around").isNull() | (100 * F.col("around") < cfg.cover * F.col("n")))
    cuts = kept.select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("cut"))
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', cut)").alias("first"), F.expr("substring_index(phrase, ' ', cut - words)").alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(sizes, "lang")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    score = cuts.select("*", (F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"]).cast(_WHOLE).alias("up"), (wide["l"] * wide["r"]).alias("down"))
    score = score.withColumn("score", F.expr("up div down"))
    worst = score.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "words", "a", "l", "r", "n")).alias("worst"))
    rows = worst.select("lang", "phrase", "worst.*")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= cfg.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "words", "cut")
