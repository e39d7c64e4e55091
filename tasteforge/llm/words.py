"""Words of an Arrow text batch as numpy arrays: places, owners and 64-bit hashes, without a Python loop over words.

A word is a maximal run of bytes other than space and 0x09-0x0D, so the UTF-8 bytes are looked at directly and any
other character belongs to a word. A word's hash is a polynomial over random byte values modulo 2**64, read off prefix
sums, then mixed. Equal words have equal hashes; different ones differ but for a chance of about 2**-60 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_powers = np.ones(1, dtype=np.uint64)
_inverse_powers = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n; grown by doubling and kept by the worker."""
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = 1 << max(10, (n - 1).bit_length())
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]))
        _inverse_powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _INVERSE)]))
    return _powers, _inverse_powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


@dataclass
class Words:
    """Words of ``n_docs`` texts, in order. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    data: np.ndarray  # the bytes of all texts
    start: np.ndarray  # of each word in data
    end: np.ndarray
    doc: np.ndarray  # int32, the text each word belongs to
    first: np.ndarray  # int64, n_docs + 1
    hash: np.ndarray  # uint64

    @property
    def n_docs(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets into them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """The words of every text; ``lower`` folds A-Z only."""
    data, offsets = text_bytes(column)
    return words_in(_LOWER[data] if lower else data, offsets)


def words_in(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n = len(data)
    inside = np.empty(n + 1, dtype=bool)
    np.logical_not(_SPACE[data], out=inside[:n])
    inside[n] = False
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    opens[cuts] = inside[cuts]  # a text's first byte opens a word even right after another text's last
    start = np.flatnonzero(opens)
    closes = np.zeros(n + 1, dtype=bool)
    closes[1:] = inside[:-1] & ~inside[1:]
    closes[cuts[cuts > 0]] |= inside[cuts[cuts > 0] - 1]
    end = np.flatnonzero(closes)
    powers, inverses = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * inverses[start] + (end - start).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(first))
    return Words(data, start, end, doc, first.astype(np.int64), hashes)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive entries (len - k + 1 of them), by doubling, so log(k) passes."""
    if len(hashes) < k:
        return np.zeros(0, dtype=np.uint64)
    acc, covered, power, span = None, 0, hashes, 1
    while True:
        if k & span:
            if acc is None:
                acc = power
            else:
                n = len(hashes) - covered - span + 1
                acc = mix(acc[:n] * np.uint64(0xD6E8FEB86659FD93) + power[covered : covered + n])
            covered += span
        if covered == k:
            return mix(acc + np.uint64(k)) if k > 1 else acc
        n = len(power) - span
        power = mix(power[:n] * np.uint64(0xA0761D6478BD642F) + power[span : span + n])
        span *= 2


def starts_of_grams(words: Words, k: int) -> np.ndarray:
    """Indices i at which words i .. i + k - 1 all belong to one text."""
    n = len(words.doc) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(words.doc[:n] == words.doc[k - 1 :])


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = 512 << 10) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``max_bytes`` of text, or one longer text.

    A byte of text takes some sixty bytes of arrays in ``words_in`` and what follows, and a worker keeps most of that for its
    next tasks, so slices are short.
    """
    if not batch.num_rows:
        return
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
    sizes = np.diff(np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1])
    del column  # maybe a copy of the whole batch's text
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > max_bytes:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(size)
    yield batch.slice(begin)
