"""BPE encoding and decoding with a word-level vocabulary file (operator 6).

A word becomes a doubly linked list of byte symbols. A priority queue holds the mergeable neighbours by merge rank, then
place; the best entry is merged, its two new neighbourhoods are pushed, and entries whose symbols have changed since are
skipped when they come up. Decoding joins the vocabulary strings of the ids.

Whitespace-free chunks are independent of each other, so a worker keeps the ids of chunks it has met in a two-generation
cache of bounded size. The work is one narrow pass over the texts: no shuffle, nothing per document on the driver.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteforge.llm.words import slices

# Fixed values of the vocabulary file's own pre-tokenizer.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# White space as the file's normalizer means it (the Unicode property; 0x1C-0x1F are not in it).
WHITE_SPACE = r"[\t-\r \x85\xa0  -     　]+"

# Entries of one of the two cache generations.
CACHE_ENTRIES = 100_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else 256 onwards."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class _Cache(dict):
    """Packed ids by chunk. When full, it becomes the old generation; what is used again moves to the new one."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        found = self.old.get(chunk)
        if found is None:
            found = self.encode(chunk)
        self[chunk] = found
        return found


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for string, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = string
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = rank, vocab[left + right]
        symbols = byte_symbols()
        self.inner = [vocab.get(s) for s in symbols]
        self.last = [vocab.get(s + WORD_END) for s in symbols]
        self.split = regex.compile(SPLIT_PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.white = regex.compile(WHITE_SPACE)
        self.chunks = _Cache(self.encode_chunk)

    def encode_chunk(self, chunk: str) -> bytes:
        """The packed ids of a chunk without white space. A pre-token is a chunk of its own, so both share the cache."""
        pieces = [chunk] if chunk.isalpha() else self.split.findall(chunk)
        if len(pieces) != 1:
            return b"".join(map(self.chunks.__getitem__, pieces))
        ids = self.encode_word(chunk.encode())
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one pre-token. Bytes that the vocabulary lacks have no id and are left out."""
        ids = [self.inner[b] for b in word[:-1]] + [self.last[b] for b in word[-1:]]
        ids = [i for i in ids if i is not None]
        n, merges = len(ids), self.merges
        if n < 2:
            return ids
        after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
        queue = [
            (*merges[pair], place, *pair) for place in range(n - 1) if (pair := (ids[place], ids[place + 1])) in merges
        ]
        queue = [(rank, place, new, left, right) for rank, new, place, left, right in queue]
        heapq.heapify(queue)
        while queue:
            _, place, new, left, right = heapq.heappop(queue)
            follower = after[place]
            if ids[place] != left or follower < 0 or ids[follower] != right:
                continue  # stale: one of the two has been merged since
            ids[place] = new
            ids[follower] = -1
            after[place] = rest = after[follower]
            if rest >= 0:
                before[rest] = place
                if (found := merges.get((new, ids[rest]))) is not None:
                    heapq.heappush(queue, (found[0], place, found[1], new, ids[rest]))
            ahead = before[place]
            if ahead >= 0 and (found := merges.get((ids[ahead], new))) is not None:
                heapq.heappush(queue, (found[0], ahead, found[1], ids[ahead], new))
        return [i for i in ids if i >= 0]

    def _plain(self, text: str) -> bytes:
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        # Lower case goes character by character: no special final sigma.
        text = (text.replace("Σ", "σ") if "Σ" in text else text).lower()
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        return b"".join(map(self.chunks.__getitem__, [c for c in self.white.split(text) if c] if odd else text.split()))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens in the text become their own ids."""
        text = text or ""
        if not self.special or "<|" not in text:
            return self._plain(text)
        out, place = [], 0
        for found in self.specials.finditer(text):
            out += [self._plain(text[place : found.start()]), self.special[found[0]].to_bytes(4, "little")]
            place = found.end()
        return b"".join([*out, self._plain(text[place:])])

    def decode(self, packed: bytes) -> str:
        """The vocabulary strings in order; the file names no decoder, so a space stands between two."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    """One per worker and file."""
    return WordBpe(path)


def _texts(column: pa.Array) -> Iterator[str | None]:
    return (value.as_py() for value in column)


def bpe_encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with ``ids``: binary, the text's token ids as little-endian unsigned 32-bit integers.

    A null or empty text has no ids (an empty binary). A column already named like ``ids`` is replaced; all others, and
    repeated rows, are kept as they are. ``path`` is the vocabulary file, readable on every executor.
    """
    rest = [c for c in df.columns if c != ids]
    schema = df.select(*[f"`{c}`" for c in rest], F.lit(b"").alias(ids)).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(part.schema.get_field_index(text))
                packed = pa.array([bpe.encode(t) for t in _texts(column)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, packed], names=[*part.schema.names, ids])

    return df.select(*[f"`{c}`" for c in rest]).mapInArrow(encode, schema)


def bpe_decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text that the packed ``ids`` stand for; null ids give an empty text.

    A column already named like ``out`` is replaced.
    """
    rest = [c for c in df.columns if c != out]
    schema = df.select(*[f"`{c}`" for c in rest], F.lit("").alias(out)).schema

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            for begin in range(0, batch.num_rows, 200):
                texts = [bpe.decode(v.as_py() or b"") for v in column[begin : begin + 200]]
                part = batch.slice(begin, 200)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    return df.select(*[f"`{c}`" for c in rest]).mapInArrow(decode, schema)


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row without its text, with packed ``ids``, the ``decoded`` text and ``n_tokens``: both ways in one pass."""
    rest = [c for c in df.columns if c not in ("ids", "decoded", "n_tokens", text)]
    columns = [*[F.col(f"`{c}`") for c in rest]]
    schema = df.select(*columns, F.lit(b"").alias("ids"), F.lit("").alias("decoded")).schema

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                packed = [bpe.encode(t) for t in _texts(part.column(part.num_columns - 1))]
                decoded = pa.array([bpe.decode(ids) for ids in packed], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(packed, pa.binary()), decoded], names=[*rest, "ids", "decoded"])

    done = df.select(*columns, F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(both, schema)
    return done.withColumn("n_tokens", (F.length("ids") / 4).cast("long"))
