"""Nearest neighbours by multi-index hashing (operator 4).

Vectors become binary codes: signs after rotations that iterative quantisation has learned from a bounded sample. A code
is cut into substrings, each with a table from value to rows. If two codes differ in at most R of their bits, one of m
substrings differs in at most floor(R / m) (pigeonhole), so probing every table up to that radius retrieves every code
within R; those are then ranked by their exact inner product. R is fitted on the sample: the distance within which
``coverage`` of the sample's true neighbours lie. They lie farther out than the full table's, so R errs on the wide side.

Inner products also depend on length. Codes are therefore made of vectors lifted to one length (a component is added that
fills up the longest), where the nearest by angle are the largest by inner product.

Rows fall into blocks by the hash of their id, queries into chunks; every chunk meets every block in a group of its own.
Each group returns its best ``k`` per query. So no task holds more than a block, copies of one vector are spread, and no
pair of vectors leaves a group but the best.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Index:
    """``bits`` bits a code in substrings of ``substring`` (at most 16) bits; ``sample`` vectors at most are learned from."""

    bits: int = 128
    substring: int = 16
    sample: int = 4096
    probes: int = 256
    iterations: int = 30
    coverage: float = 0.97
    block: int = 8192
    chunk: int = 1024
    seed: int = 5


@dataclass
class Coder:
    rotation: np.ndarray  # lifted dimensions x bits
    mean: np.ndarray
    longest: float
    radius: int
    cfg: Index

    def lift(self, rows: np.ndarray) -> np.ndarray:
        scaled = rows / self.longest
        rest = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))
        return np.concatenate([scaled, rest[:, None]], axis=1)

    def codes(self, rows: np.ndarray, query: bool = False) -> np.ndarray:
        """Substrings (rows x substrings, uint16). A query has no length to fill up; only its direction counts."""
        if query:
            lifted = np.concatenate([rows / np.linalg.norm(rows, axis=1, keepdims=True), np.zeros((len(rows), 1))], axis=1)
        else:
            lifted = self.lift(rows)
        bits = ((lifted - self.mean) @ self.rotation > 0).reshape(len(rows), -1, self.cfg.substring)
        return (bits * (1 << np.arange(self.cfg.substring))).sum(axis=2).astype(np.uint16)


def learn(sample: np.ndarray, longest: float, k: int, cfg: Index) -> Coder:
    """Rotations by iterative quantisation on the sample, and the radius."""
    rng = np.random.default_rng(cfg.seed)
    coder = Coder(np.zeros((0, 0)), np.zeros(0), longest, 0, cfg)
    lifted = coder.lift(sample)
    coder.mean = lifted.mean(axis=0)
    centred = lifted - coder.mean
    dim = centred.shape[1]
    parts = []
    for _ in range(-(-cfg.bits // dim)):
        rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(cfg.iterations):
            u, _, v = np.linalg.svd(np.sign(centred @ rotation).T @ centred)
            rotation = (u @ v).T
        parts.append(rotation)
    coder.rotation = np.concatenate(parts, axis=1)[:, : cfg.bits]
    probes = sample[: cfg.probes]
    scores = probes @ sample.T
    scores[np.arange(len(probes)), np.arange(len(probes))] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : max(1, min(k, len(sample) - 1))]
    far = hamming(coder.codes(probes, query=True)[:, None, :], coder.codes(sample)[near])
    coder.radius = int(np.quantile(far, cfg.coverage, method="higher")) if len(sample) > 1 else cfg.bits
    return coder


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class Tables:
    """One table per substring over a block's codes: distinct values, and the rows of each."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, first = np.unique(column[order], return_index=True)
            self.tables.append((values, order, first, np.diff(np.append(first, len(column)))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs from ``code`` in at most ``radius`` bits."""
        reach = radius // len(self.tables)
        met = np.zeros(len(self.codes), dtype=bool)
        for part, (values, order, first, sizes) in zip(code, self.tables, strict=True):
            hit = np.bitwise_count(values ^ part) <= reach
            met[order[np.repeat(hit, sizes)]] = True
        rows = np.flatnonzero(met)
        return rows[hamming(self.codes[rows], code) <= radius]


def best_in_block(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, coder: Coder) -> pd.DataFrame:
    """The ``k`` best rows found for each query; a block with fewer within the radius is searched whole."""
    tables = Tables(coder.codes(rows))
    out = []
    for query_id, query, code in zip(query_ids, queries, coder.codes(queries, query=True), strict=True):
        found = tables.within(code, coder.radius)
        found = found[ids[found] != query_id]
        if len(found) < k:
            found = np.flatnonzero(ids != query_id)
        scores = (rows[found] * query).sum(axis=1)  # row by row in the same order, so copies tie exactly
        if len(found) > k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= edge], scores[scores >= edge]
        order = np.lexsort((ids[found], -scores))[:k]
        out.append((np.full(len(order), query_id), ids[found[order]], scores[order]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
    return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], columns, strict=True)))


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of rows that take part: an id, and a vector of finite numbers that are not all zero."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def nearest(
    vectors: DataFrame, is_query, k: int = 20, cfg: Index = Index(), vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows with ``is_query(id column)``, the ``k`` largest inner products found among
    all rows but those with the query's own id, nearest first, ties to the smaller vec_id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do those of another length than
    the most frequent one (the smaller, at a tie). Rows that repeat an id and vector count once; of several vectors under
    one id the best counts. Other columns are ignored.
    """
    rows = usable(vectors, vec_id, vector).distinct()
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    facts = rows.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(square).alias("longest"), F.count(F.when(is_query(F.col("id")), 1)).alias("queries")
    )
    top = facts.orderBy(F.desc("n"), "d").first()
    kind = "query_id long, vec_id long, score double"
    if top is None or not top.queries:
        found = vectors.sparkSession.createDataFrame([], kind)
    else:
        rows = rows.where(F.size("v") == top.d)
        sample = rows.orderBy(F.xxhash64("id"), "id").limit(cfg.sample).collect()  # bounded by cfg.sample
        coder = learn(np.array([r.v for r in sample]), float(np.sqrt(top.longest)), k, cfg)
        blocks, chunks = -(-top.n // cfg.block), -(-top.queries // cfg.chunk)
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))
        own = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(int(n))).cast("int")
        base = rows.select("id", "v", own(blocks, 1).alias("block"), every(chunks).alias("chunk"))
        asked = rows.where(is_query(F.col("id"))).select("id", "v", own(chunks, 2).alias("chunk"), every(blocks).alias("block"))

        def search(base: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            if not len(base) or not len(asked):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
            return best_in_block(base["id"].to_numpy(), np.stack(base["v"]), asked["id"].to_numpy(), np.stack(asked["v"]), k, coder)

        found = base.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInPandas(search, kind)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
