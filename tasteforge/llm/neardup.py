"""Near-duplicate documents by MinHash with tensored banding (operator 2).

Plain banding needs ``tables * rows`` minimum hashes. Here two collections of ``m`` half keys are made, each half key
from ``t`` minimum hashes, and every pair (i, j) of halves is a table: m * m tables from 2 * m * t hashes. Two texts of
similarity s meet unless one collection has no common half: they are missed with probability 2 * (1 - s**t)**m, at
s = 0.8 and the defaults 0.0006, less above.

1. One pass over the texts gives set size, set digest, half keys and short signatures. Texts with equal sets form one
   class at once; only class representatives go on.
2. Half keys met once cannot make a shared table key. They are dropped before the pairs of halves are formed.
3. In each bucket every member is compared with one pivot (a star, never all pairs), links are confirmed on the full
   sets, and components are formed. Of the pivots of its buckets a member meets the one that it shares most tables with.
   Buckets inside one component are finished. The next rounds take other pivots.
4. What is left, buckets that still hold several components, is compared block by block, every member with every other,
   on the full sets, as a product of 0/1 matrices inside the group of a block pair. Only links that join components leave
   a group, so a group of n near copies never makes n * n rows; nothing in a bucket is capped. Two texts of similarity s
   meet in about 64 * s**4 of the 64 tables, so four diagonals of the table square (32 tables) do for this step: they
   miss a link at s = 0.8 with probability 0.0007, and only links matter here that no pivot has made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteforge.llm.components import connected_components
from tasteforge.llm.words import gram_hashes, mix, slices, words_of
from tasteforge.session import materialize


@dataclass(frozen=True)
class MinHash:
    """Word shingles of ``shingle`` words, linked at ``percent`` / 100 of the union.

    ``halves`` half keys of ``per_half`` minimum hashes in each of the two collections. ``block`` members of a bucket
    make a block of the comparison of what stars leave open. A star's pair is looked at in full if at least ``least_equal`` of the
    ``2 * halves * per_half`` signature places agree: at similarity 0.8 and the defaults, fewer happens with
    probability 0.00007.
    """

    shingle: int = 4
    percent: int = 80
    halves: int = 8
    per_half: int = 2
    least_equal: int = 16
    star_rounds: int = 3
    diagonals: int = 4
    block: int = 256
    seed: int = 7


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's k-word shingles; of a shorter text its whole sequence is the only one."""
    words = words_of(column, lower=True)
    grams = gram_hashes(words.hash, k)
    sets = []
    for begin, end in zip(words.first[:-1], words.first[1:], strict=True):
        n = end - begin
        if n >= k:
            sets.append(np.unique(grams[begin : end - k + 1]))
        else:
            sets.append(gram_hashes(words.hash[begin:end], n) if n else np.zeros(0, np.uint64))
    return sets


def _sketch(sets: list[np.ndarray], cfg: MinHash) -> tuple[np.ndarray, np.ndarray]:
    """Minimum hashes (sets x hashes) and digests (sets x 2) of non-empty sets."""
    flat = np.concatenate(sets)
    begins = np.cumsum([0] + [len(s) for s in sets[:-1]])
    rng = np.random.default_rng(cfg.seed)
    factors = rng.integers(1, 1 << 62, 2 * cfg.halves * cfg.per_half, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mins = np.empty((len(sets), len(factors)), dtype=np.uint64)
    for i, factor in enumerate(factors):
        h = flat * factor
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x9FB21C651E98DF25)
        mins[:, i] = np.minimum.reduceat(h, begins)
    digests = np.stack([np.add.reduceat(mix(flat), begins), np.add.reduceat(mix(flat + np.uint64(0x51ED270B)), begins)], axis=1)
    return mins, digests


SKETCH = "doc_id long, n_shingles long, d1 long, d2 long, a array<long>, b array<long>, signature binary"


def sketches(docs: DataFrame, cfg: MinHash, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: set size, digest of the set, half keys ``a`` and ``b`` (null for an empty set), signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column(1), cfg.shingle)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(sizes)
                halves = np.zeros((len(sets), 2, cfg.halves), dtype=np.int64)
                digests = np.zeros((len(sets), 2), dtype=np.int64)
                marks: list[bytes | None] = [None] * len(sets)
                if len(full):
                    mins, found = _sketch([sets[i] for i in full], cfg)
                    parts = mins.reshape(len(full), 2, cfg.halves, cfg.per_half)
                    keys = np.zeros(parts.shape[:3], dtype=np.uint64)
                    for i in range(cfg.per_half):
                        keys = mix(keys + parts[..., i])
                    keys = mix(keys + np.arange(2 * cfg.halves, dtype=np.uint64).reshape(1, 2, cfg.halves))
                    halves[full], digests[full] = keys.view(np.int64), found.view(np.int64)
                    short = (mins >> np.uint64(44)).astype(np.uint16)
                    for i, row in zip(full, short, strict=True):
                        marks[i] = row.tobytes()
                empty = sizes == 0
                lists = [
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1) * cfg.halves, pa.int32()), pa.array(halves[:, h].ravel())
                    )
                    for h in (0, 1)
                ]
                if empty.any():
                    lists = [pa.array([None if e else v for e, v in zip(empty, x.to_pylist(), strict=True)], x.type) for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.array(digests[:, 0]), pa.array(digests[:, 1]), *lists, pa.array(marks, pa.binary())],
                    names=["doc_id", "n_shingles", "d1", "d2", "a", "b", "signature"],
                )

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, SKETCH)


def table_keys(classes: DataFrame) -> DataFrame:
    """(key, id, diagonal): a row for every pair of half keys that both stand in more than one class."""
    halves = classes.select("id", F.size("a").alias("m"), F.posexplode(F.concat("a", "b")).alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    part = F.struct("place", "half")
    sides = halves.join(shared, "half").groupBy("id", "m").agg(
        F.collect_list(F.when(F.col("place") < F.col("m"), part)).alias("a"),
        F.collect_list(F.when(F.col("place") >= F.col("m"), part)).alias("b"),
    )  # at most m entries each
    crossed = sides.select("id", "m", "b", F.explode("a").alias("x")).select("id", "m", "x", F.explode("b").alias("y"))
    return crossed.select(F.xxhash64("x.half", "y.half").alias("key"), "id", F.pmod(F.expr("y.place - x.place"), "m").alias("diagonal"))


def pack(hashes: np.ndarray) -> bytes:
    """Six bytes of each hash; two different shingles of a pair agree in them with a chance of about 2**-48."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view(np.uint64).ravel()


def full_sets(docs: DataFrame, ids: DataFrame, cfg: MinHash, doc_id: str, text: str) -> DataFrame:
    """(id, set): the packed shingle sets of the documents named in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                packed = [pack(s) for s in shingle_sets(part.column(1), cfg.shingle)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["id", "set"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.join(ids, "id").mapInArrow(run, "id long, set binary")


def confirm(pairs: DataFrame, sets: DataFrame, cfg: MinHash) -> DataFrame:
    """The pairs (x, y) whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column(2), batch.column(3)
            keep, last, first = [], None, None
            for p, q in zip(xs, ys, strict=True):
                if p != last:
                    last, first = p, unpack(p.as_py())
                second = unpack(q.as_py())
                both = len(np.intersect1d(first, second, assume_unique=True))
                keep.append(100 * both >= cfg.percent * (len(first) + len(second) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("x"), F.col("set").alias("set_x"))
    right = sets.select(F.col("id").alias("y"), F.col("set").alias("set_y"))
    rows = pairs.join(right, "y").join(left, "x").select("x", "y", "set_x", "set_y")
    return rows.mapInArrow(run, "x long, y long")


def _may_link(left: str, right: str, cfg: MinHash):
    """Whether sizes alone allow the threshold."""
    small, large = F.least(f"n_{left}", f"n_{right}"), F.greatest(f"n_{left}", f"n_{right}")
    return small * 100 >= large * cfg.percent


def _plausible(pairs: DataFrame, cfg: MinHash) -> DataFrame:
    """Pairs (x, y, sx, sy) whose signatures agree in enough places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * cfg.halves * cfg.per_half
        for batch in batches:
            sx = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, width)
            sy = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint16).reshape(-1, width)
            keep = (sx == sy).sum(axis=1) >= cfg.least_equal
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["x", "y"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "x long, y long")


def _star_pairs(buckets: DataFrame, nodes: DataFrame, turn: int, cfg: MinHash) -> DataFrame:
    """Plausible (pivot, member) pairs whose ends lie in different components: for each member the pivot that it shares most
    tables with (the smallest, at a tie).

    ``buckets`` has (key, id, component). The pivot differs from turn to turn and table to table.
    """
    # The first turn shares the smallest member as pivot between tables, so that few different pairs come up.
    order = F.col("id") if turn == 0 else F.xxhash64("id", "key", F.lit(turn))
    pivot = F.min(F.struct(order.alias("o"), F.col("id"), F.col("component").alias("c")))
    pivots = buckets.groupBy("key").agg(pivot.alias("p"), F.count("*").alias("n"))
    pairs = (
        buckets.join(pivots.where("n > 1").select("key", F.col("p.id").alias("x"), "p.c"), "key")
        .where("x <> id and c <> component").groupBy("x", F.col("id").alias("y")).agg(F.count("*").alias("n"))
    )
    nearest = pairs.groupBy("y").agg(F.min(F.struct((-F.col("n")).alias("o"), "x")).alias("p"))
    return _with_signatures(nearest.select("p.x", "y"), nodes, cfg)


def _with_signatures(pairs: DataFrame, nodes: DataFrame, cfg: MinHash) -> DataFrame:
    side = lambda s: nodes.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("signature").alias(f"s_{s}"))
    known = pairs.join(side("y"), "y").join(side("x"), "x").where(_may_link("x", "y", cfg))
    return _plausible(known.select("x", "y", "s_x", "s_y"), cfg)


def _open_buckets(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """The rows (key, id, component) of buckets that hold more than one component."""
    placed = buckets.join(found.withColumnsRenamed({"node": "id"}), "id", "left")
    placed = placed.select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return placed.join(mixed.select("key"), "key")


def _links_across(packed: list[bytes], comps: np.ndarray, left: np.ndarray, right: np.ndarray, cfg: MinHash) -> list[tuple[int, int]]:
    """Places of linked members, one link for each two components that a link joins (a spanning forest)."""
    sizes = np.array([len(p) // 6 for p in packed])
    _, codes = np.unique(unpack(b"".join(packed)), return_inverse=True)
    common = np.bincount(codes) > 1
    number = np.cumsum(common) - 1
    owner = np.repeat(np.arange(len(packed)), sizes)[common[codes]]
    codes = number[codes[common[codes]]]
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    both = np.zeros((len(left), len(right)), np.float32)
    total = int(codes[-1]) + 1 if len(codes) else 0
    width = min(total, 8192)
    for begin in range(0, total, max(width, 1)):
        at, to = np.searchsorted(codes, [begin, begin + width])
        rows = np.zeros((len(packed), width), np.float32)
        rows[owner[at:to], codes[at:to] - begin] = 1
        both += rows[left] @ rows[right].T
    both = both.astype(np.int64)
    linked = 100 * both >= cfg.percent * (sizes[left][:, None] + sizes[right][None, :] - both)
    linked &= comps[left][:, None] != comps[right][None, :]
    root: dict[int, int] = {}
    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = comps[left[i]].item(), comps[right[j]].item()
        while a in root:
            a = root[a]
        while b in root:
            b = root[b]
        if a != b:
            root[a] = b
            out.append((left[i], right[j]))
    return out


def _block_links(rest: DataFrame, sets: DataFrame, cfg: MinHash) -> DataFrame:
    """Links (x, y) that join components within buckets, compared block by block on full sets.

    Members of a bucket fall into blocks by the hash of their id; each pair of blocks is a group of its own, so no task
    holds a bucket.
    """
    sizes = rest.groupBy("key").agg(F.count("*").alias("m"))
    rows = rest.join(sizes, "key").withColumn("blocks", F.ceil(F.col("m") / cfg.block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")).join(sets, "id")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "id", "component", "set"
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids, comps, own = (group[c].to_numpy() for c in ("id", "component", "own"))
        left, right = (np.flatnonzero(own == group[c].iloc[0]) for c in ("p", "q"))
        pairs = _links_across(group["set"].tolist(), comps, left, right, cfg) if comps.min() < comps.max() else []
        return pd.DataFrame({"x": [ids[i] for i, _ in pairs], "y": [ids[j] for _, j in pairs]}, dtype="int64")

    return rows.groupBy("key", "p", "q").applyInPandas(compare, "x long, y long").distinct()


def near_duplicates(docs: DataFrame, cfg: MinHash = MinHash(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Linked are documents whose sets reach ``cfg.percent`` per cent of their union; component_id is the smallest doc_id
    reachable over links, itself included, and kept marks the row with doc_id = component_id. A null text, or one without
    words, has an empty set and is linked with nothing. A null doc_id takes part in no link; its component_id is null and
    kept false. Rows that repeat a doc_id are one node: each gets the node's result. Other columns are ignored.
    """
    stored = materialize(sketches(docs, cfg, doc_id, text), "sketches")
    able = stored.where("n_shingles > 0 and doc_id is not null")
    classes = able.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "n_shingles", "a", "b", "signature")).alias("r"))
    classes = materialize(
        classes.select("d1", "d2", F.col("r.doc_id").alias("id"), F.col("r.n_shingles").alias("n"), "r.a", "r.b", "r.signature"), "classes"
    )
    keyed = materialize(_shared_keys(table_keys(classes)), "buckets")
    buckets = keyed.select("key", "id")
    nodes = classes.select("id", "n", "signature")
    # The texts of a repeated doc_id are one node, so its classes are linked from the start.
    mark = F.struct("d1", "d2")
    repeated = able.groupBy("doc_id").agg(F.min(mark).alias("lo"), F.max(mark).alias("hi")).where("lo <> hi").select("doc_id")
    links = able.join(repeated, "doc_id").join(classes.select("d1", "d2", "id"), ["d1", "d2"]).where("doc_id <> id")
    links = links.select(F.col("doc_id").alias("x"), F.col("id").alias("y")).distinct()
    first = materialize(_star_pairs(buckets.withColumn("component", F.col("id")), nodes, 0, cfg), "pairs")
    candidates = buckets.select("id").distinct()
    sets = materialize(full_sets(docs, candidates, cfg, doc_id, text), "sets")
    links = materialize(links.union(confirm(first, sets, cfg)), "links")
    found = connected_components(links)
    for turn in range(1, cfg.star_rounds):
        rest = materialize(_open_buckets(buckets, found), "open")
        pairs = _star_pairs(rest, nodes, turn, cfg)
        links = materialize(links.union(confirm(pairs, sets, cfg)), "links")
        found = connected_components(links)
    rest = materialize(_open_buckets(keyed.where(F.col("diagonal") < cfg.diagonals), found), "open")
    # Stored: the components read their links several times, and the blocks are the costliest step.
    links = materialize(links.union(_block_links(rest, sets, cfg)), "links")
    found = connected_components(links)
    roots = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "d1", "d2", F.coalesce("component", "id").alias("component_id")
    )
    plain = stored.select("doc_id", "n_shingles", "d1", "d2")
    joined = plain.where("n_shingles > 0 and doc_id is not null").join(roots, ["d1", "d2"], "left")
    alone = plain.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    every = joined.select("doc_id", "n_shingles", "component_id").union(alone.select("doc_id", "n_shingles", "component_id"))
    return every.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _shared_keys(keys: DataFrame) -> DataFrame:
    """Rows of table keys that more than one class has."""
    return keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "key")
