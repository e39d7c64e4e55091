"""Language identification by a string kernel (operator 9).

The kernel of two texts counts the character n-grams (blended: lengths 1 to ``longest``) present in both, divided by the
root of the product of their numbers. A bounded sample of labelled texts is cut into pieces; some pieces are landmarks,
and the Nystroem map K(x, landmarks) K(landmarks, landmarks)^(-1/2) turns the kernel into features, on which one ridge
regression per language is solved against the rest. Both factors are linear in the presence vector of x, so they are
multiplied out once and a batch of texts is scored by one product of its presence matrix with that matrix.

A whole text is scored: it is cut into pieces of ``piece`` characters, whose scores are averaged by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteforge.llm.words import slices

UNKNOWN = "und"


@dataclass(frozen=True)
class Kernel:
    """``per_language`` labelled texts per language, picked by a hash of the text, are the training sample; its pieces
    give ``landmarks`` landmarks, and ``ridge`` is the penalty. n-grams are hashed to 2**``bits`` places."""

    longest: int = 4
    bits: int = 15
    piece: int = 4096
    per_language: int = 150
    landmarks: int = 256
    ridge: float = 1e-2
    sharpness: float = 6.0
    seed: int = 3


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def pieces(texts: list[str | None], cfg: Kernel) -> tuple[list[np.ndarray], np.ndarray]:
    """Code points of lower-cased texts with every run of other characters as one space, in pieces, and their owners.

    A text without letters has no piece.
    """
    out, owner = [], []
    letters = _letters()
    for i, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters[codes]
        if not is_letter.any():
            continue
        codes = np.where(is_letter, codes, np.uint32(0x20))
        stay = is_letter.copy()
        stay[1:] |= is_letter[:-1]  # the first of a run of others stays, as a space
        codes = np.concatenate([[np.uint32(0x20)], codes[stay], [np.uint32(0x20)]]).astype(np.uint32)
        for begin in range(0, max(1, len(codes) - 1), cfg.piece):
            out.append(codes[begin : begin + cfg.piece])
            owner.append(i)
    return out, np.array(owner, dtype=np.int64)


def presence(parts: list[np.ndarray], cfg: Kernel) -> np.ndarray:
    """A row per piece: 1 / root of the number of places with an n-gram there, 0 elsewhere."""
    marks = np.zeros(len(parts) << cfg.bits, dtype=np.uint8)
    codes = np.concatenate(parts)
    row = np.repeat(np.arange(len(parts), dtype=np.int64) << cfg.bits, [len(p) for p in parts])
    shift = np.uint32(32 - cfg.bits)
    gram = codes * np.uint32(0x9E3779B1)
    for n in range(1, cfg.longest + 1):
        if n > 1:
            gram = (gram[:-1] ^ (gram[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            gram += codes[n - 1 :] * np.uint32(0xC2B2AE35)
        place = row[: len(gram)] + (((gram ^ (gram >> np.uint32(13))) * np.uint32(0x27D4EB2F)) >> shift)
        marks[place[row[: len(gram)] == row[n - 1 :]]] = 1  # grams over the end of a piece are none
    marks = marks.reshape(len(parts), -1)
    sizes = np.array([np.count_nonzero(m) for m in marks], dtype=np.float32)
    return marks * (1 / np.sqrt(np.maximum(sizes, 1)))[:, None]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # places x languages
    bias: np.ndarray


def fit(texts: list[str | None], labels: list[str], cfg: Kernel) -> Model:
    """Kernel ridge regression on Nystroem landmarks. Without usable texts the model knows no language."""
    rng = np.random.default_rng(cfg.seed)
    parts, owner = pieces(texts, cfg)
    names = sorted({labels[i] for i in owner.tolist()})
    if not names:
        return Model([], np.zeros((1 << cfg.bits, 0), np.float32), np.zeros(0, np.float32))
    kind = np.array([names.index(labels[i]) for i in owner.tolist()])
    # The same number of pieces of each language: a long text must not outweigh the others.
    most = 2 * cfg.per_language
    use = np.concatenate([rng.permutation(np.flatnonzero(kind == k))[:most] for k in range(len(names))])
    kind = kind[use]
    each = -(-cfg.landmarks // len(names))
    marks = np.concatenate([np.flatnonzero(kind == k)[:each] for k in range(len(names))])
    points = presence([parts[i] for i in use[marks]], cfg).astype(np.float64)
    values, vectors = np.linalg.eigh(points @ points.T)
    good = values > 1e-6
    project = points.T @ (vectors[:, good] / np.sqrt(values[good]))  # places x features
    # In batches: the presence of all pieces at once would take 39 MB a language.
    features = np.concatenate([presence([parts[i] for i in use[b : b + 64]], cfg) @ project for b in range(0, len(use), 64)])
    mean = features.mean(axis=0)
    centred = features - mean
    balance = 1.0 / np.bincount(kind, minlength=len(names))[kind]  # each language weighs the same
    targets = np.where(kind[:, None] == np.arange(len(names)), 1.0, -1.0)
    offset = (targets * balance[:, None]).sum(axis=0) / balance.sum()
    left = centred.T @ (centred * balance[:, None]) + cfg.ridge * np.eye(features.shape[1]) / len(names)
    solved = np.linalg.solve(left, centred.T @ ((targets - offset) * balance[:, None]))
    return Model(names, (project @ solved).astype(np.float32), (offset - mean @ solved).astype(np.float32))


def score_texts(texts: list[str | None], model: Model, cfg: Kernel, batch: int = 32) -> tuple[list[str], np.ndarray]:
    """Predicted language and its softmax share per text; ties go to the first language in order."""
    parts, owner = pieces(texts, cfg)
    totals, weight = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    if model.languages:
        for begin in range(0, len(parts), batch):
            group = parts[begin : begin + batch]
            scores = presence(group, cfg) @ model.weights + model.bias
            sizes = np.array([len(p) for p in group], dtype=float)
            np.add.at(totals, owner[begin : begin + batch], scores * sizes[:, None])
            np.add.at(weight, owner[begin : begin + batch], sizes)
    names, shares = [UNKNOWN] * len(texts), np.zeros(len(texts))
    for i in np.flatnonzero(weight):
        mean = totals[i] / weight[i]
        odds = np.exp(cfg.sharpness * (mean - mean.max()))
        best = int(np.argmax(mean))
        names[i], shares[i] = model.languages[best], odds[best] / odds.sum()
    return names, shares


def training_sample(docs: DataFrame, cfg: Kernel, text: str = "text", lang: str = "lang") -> tuple[list[str], list[str]]:
    """Up to ``cfg.per_language`` different labelled texts with a letter per language, by text hash, so neither row order
    nor the number of a text's copies plays a part."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("lang is not null and text is not null")
    rows = rows.withColumn("key", F.xxhash64("text"))
    order = Window.partitionBy("lang").orderBy("key")
    # Copies meet in the map-side combine as 8-byte keys; the rank limit is applied before the second shuffle.
    keys = rows.where(F.col("text").rlike(r"\p{L}")).select("lang", "key").distinct()
    picked = keys.withColumn("place", F.row_number().over(order)).where(F.col("place") <= cfg.per_language).select("lang", "key")
    # Broadcast: per_language keys for each language at most. A task sends one text per key.
    found = rows.join(F.broadcast(picked), ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text")).select("text", "lang").collect()
    found.sort(key=lambda r: (r.lang, r.text))
    return [r.text for r in found], [r.lang for r in found]


def identify(docs: DataFrame, model: Model, cfg: Kernel = Kernel(), text: str = "text") -> DataFrame:
    """``docs`` without its text, with lang_pred and score (0 to 1).

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text if the model was fitted on
    no rows. Columns already called lang_pred or score are replaced; repeated rows are scored alike.
    """
    rest = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*[f"`{c}`" for c in rest], F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", 2 << 20):
                names, shares = score_texts(part.column(part.num_columns - 1).to_pylist(), shared.value, cfg)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(names, pa.string()), pa.array(shares)], names=[*rest, "lang_pred", "score"])

    body = F.col(f"`{text}`").cast("string").alias("__text")
    return docs.select(*[f"`{c}`" for c in rest], body).mapInArrow(run, schema)


def held_out(doc_id: str, parts: int, which: int):
    """Whether crc32 of the id as text leaves ``which`` modulo ``parts``; false for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % parts == which, F.lit(False))
