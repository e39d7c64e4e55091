"""Embedding whitening from a bit-sliced scatter matrix.

Entries become whole numbers x. Each dimension is shifted by its least value and cut into bit planes; a plane of 64 rows
is one word, so the cross-product of two dimensions is the sum over pairs of planes of 2**(a + b) times the population
count of their AND. The counts are exact, tasks emit sums of them, Spark adds those as decimals, and the matrix is centred
in Python's whole numbers (n * sum xy - sum x * sum y) before one division makes it the covariance that eigh decomposes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose planes are packed at a time, and bits of a limb: a product of limbs summed over a task's rows fits 64 bits.
ROWS, LIMB = 8192, 16
#: Scaled entries are held within these bounds, so that x is a 64-bit number.
FAR = 2.0**62


@dataclass(frozen=True)
class Whitening:
    """x = floor(scale * c) + offset; how many components are returned."""

    scale: float = 1024.0
    offset: int = 100_000
    components: int = 8


@dataclass(frozen=True)
class Fit:
    """``low`` is subtracted from x (the y of the code); ``sums`` are of y. ``axes`` has a unit eigenvector per row."""

    n: int
    low: np.ndarray
    high: np.ndarray
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    trace: float


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector) of rows whose vector is there and all finite, in the length that most of them have (else the shorter)."""
    vectors = rows.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    vectors = vectors.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    lengths = vectors.groupBy(F.size("vector").alias("length")).count()
    most = lengths.agg(F.max(F.struct("count", -F.col("length")))).first()[0]
    return vectors.where(F.size("vector") == (-most[1] if most else 0))


def whole(batch: pa.RecordBatch, cfg: Whitening) -> np.ndarray:
    """x of a batch's vectors, rows by dimensions."""
    vectors = batch.column("vector")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    scaled = np.clip(np.floor(flat * cfg.scale), -FAR, FAR).astype(np.int64)
    return scaled.reshape(len(vectors), -1) + cfg.offset


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of y (rows by dimensions), packed over rows: (dimensions, bits, words of 64 rows)."""
    rows, dims = y.shape
    packed = np.zeros((dims, bits, -(-rows // 64) * 8), dtype=np.uint8)
    across = np.ascontiguousarray(y.T)
    for a in range(bits):
        plane = (across >> np.uint64(a)).astype(np.uint8) & np.uint8(1)
        packed[:, a, : -(-rows // 8)] = np.packbits(plane, axis=1)
    return packed.view(np.uint64)


def add_scatter(scatter: np.ndarray, sums: np.ndarray, sliced: np.ndarray) -> None:
    """Add a block's cross-products (upper triangle) to ``scatter`` (limb sums, dims, dims), its sums to ``sums`` (limbs, dims)."""
    dims, bits, _ = sliced.shape
    cuts = range(0, bits, LIMB)
    ones = np.bitwise_count(sliced).sum(axis=2, dtype=np.int64)
    for p, at in enumerate(cuts):
        sums[p] += ones[:, at : at + LIMB] @ (1 << np.arange(min(LIMB, bits - at)))
    for i in range(dims):
        for a in range(bits):
            if not ones[i, a]:
                continue
            both = np.bitwise_count(sliced[i, a] & sliced[i:]).sum(axis=2, dtype=np.int64)
            for q, at in enumerate(cuts):
                weighted = both[:, at : at + LIMB] @ (1 << np.arange(min(LIMB, bits - at)))
                scatter[a // LIMB + q, i, i:] += weighted << (a % LIMB)


def _bounds_of(cfg: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, None, None
        for batch in batches:
            if batch.num_rows:
                x = whole(batch, cfg)
                a, b = x.min(axis=0), x.max(axis=0)
                low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
                n += len(x)
        if n:
            dims = pa.array(np.arange(len(low)), pa.int32())
            yield pa.RecordBatch.from_pydict({"dim": dims, "n": pa.array([n] * len(low), pa.int64()), "low": low, "high": high})

    return run


def _scatter_of(cfg: Whitening, low: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, limbs = len(low), -(-bits // LIMB)
        scatter, sums = np.zeros((2 * limbs - 1, dims, dims), np.int64), np.zeros((limbs, dims), np.int64)
        some = False
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = (whole(batch.slice(at, ROWS), cfg) - low).view(np.uint64)
                add_scatter(scatter, sums, planes(y, bits))
                some = True
        if not some:
            return
        upper, alone = np.triu_indices(dims), (np.arange(dims), np.full(dims, -1))
        parts = [(upper, limb, total[upper]) for limb, total in enumerate(scatter)]
        for (i, j), limb, total in parts + [(alone, limb, total) for limb, total in enumerate(sums)]:
            columns = [pa.array(c, pa.int32()) for c in (i, j, np.full(len(i), limb))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total)], names=["i", "j", "limb", "total"])

    return run


def fit(vectors: DataFrame, cfg: Whitening = Whitening()) -> Fit | None:
    """The components of ``vectors`` (id, vector), all of one length; None without rows (runs two jobs).

    A task emits one row per pair of dimensions and limb, so what is shuffled and what reaches the driver depend on the
    dimensions only.
    """
    bounds = vectors.select("vector").mapInArrow(_bounds_of(cfg), "dim int, n bigint, low bigint, high bigint")
    found = bounds.groupBy("dim").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    if not found:
        return None
    n, low, high = found[0]["n"], np.array([r["low"] for r in found]), np.array([r["high"] for r in found])
    bits = max(1, max(int(b) - int(a) for a, b in zip(low, high)).bit_length())
    parts = vectors.select("vector").mapInArrow(_scatter_of(cfg, low, bits), "i int, j int, limb int, total bigint")
    totals = parts.groupBy("i", "j", "limb").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total")).collect()
    dims = len(low)
    products, sums = [[0] * dims for _ in range(dims)], [0] * dims
    for r in totals:
        value = int(r["total"]) << (LIMB * r["limb"])
        if r["j"] < 0:
            sums[r["i"]] += value
        else:
            products[r["i"]][r["j"]] += value
    covariance = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            covariance[i, j] = covariance[j, i] = (n * products[i][j] - sums[i] * sums[j]) / (n * n)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes.T[::-1]
    heaviest = np.abs(axes).argmax(axis=1)
    axes = axes * np.sign(axes[np.arange(dims), heaviest])[:, None]
    return Fit(n, low, high, sums, covariance, values, axes, float(np.trace(covariance)))


def _projector(found: Fit, cfg: Whitening):
    """A function from x to whitened values, one column per component that has any variance."""
    top = min(cfg.components, len(found.values))
    floor = len(found.values) * np.finfo(float).eps * max(float(found.values[0]), 0.0)
    rank = int((found.values[:top] > floor).sum())
    mean = np.array([s / found.n for s in found.sums])
    turn = (found.axes[:rank] / np.sqrt(found.values[:rank])[:, None]).T
    low = found.low
    return lambda x: ((x - low).view(np.uint64).astype(np.float64) - mean) @ turn, rank, top


def _moments_of(found: Fit, cfg: Whitening):
    project, rank, _ = _projector(found, cfg)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            w = project(whole(batch, cfg))
            mean = w.mean(axis=0)
            inside = (w - mean).T @ (w - mean)
            i, j = np.triu_indices(rank)
            size = float(len(w))
            sums = {"n": np.full(len(i), size), "inside": inside[i, j], "mi": size * mean[i], "mj": size * mean[j]}
            pairs = {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32())}
            yield pa.RecordBatch.from_pydict(pairs | sums | {"between": size * mean[i] * mean[j]})

    return run


def identity_error(vectors: DataFrame, found: Fit, cfg: Whitening = Whitening()) -> float | None:
    """The largest entry of the whitened rows' covariance minus the identity, measured on the rows; None without components.

    Each batch centres its own rows before it multiplies; the batches' means are then combined.
    """
    if not _projector(found, cfg)[1]:
        return None
    schema = "i int, j int, n double, inside double, mi double, mj double, between double"
    parts = vectors.select("vector").mapInArrow(_moments_of(found, cfg), schema)
    n = F.sum("n")
    cov = (F.sum("inside") + F.sum("between") - F.sum("mi") * F.sum("mj") / n) / n
    unit = F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    return parts.groupBy("i", "j").agg(cov.alias("cov")).agg(F.max(F.abs(F.col("cov") - unit))).first()[0]


def _deviations(found: Fit):
    """A function from x to the sum over dimensions of (n x - S)**2, exact, as Python or 64-bit integers."""
    n, dims = found.n, len(found.low)
    widest = max(int(b) - int(a) for a, b in zip(found.low, found.high))
    if dims * (n * widest) ** 2 < 1 << 63:
        sums = np.array(found.sums, dtype=np.int64)
        return lambda x: (np.square(n * (x - found.low) - sums)).sum(axis=1).tolist()
    if dims * widest**2 < 1 << 63 and dims * widest < 1 << 39:
        # n**2 sum y**2 - 2 n sum y s + sum s**2, with s cut into limbs of 24 bits.
        cuts = range(0, max(1, max(found.sums).bit_length()), 24)
        limbs = [np.array([(s >> at) & 0xFFFFFF for s in found.sums], dtype=np.int64) for at in cuts]
        constant = sum(s * s for s in found.sums)

        def by_limbs(x: np.ndarray) -> list[int]:
            y = x - found.low
            squares, dots = (y * y).sum(axis=1).tolist(), [(y @ limb).tolist() for limb in limbs]
            cross = [sum(int(d[r]) << (24 * k) for k, d in enumerate(dots)) for r in range(len(y))]
            return [n * n * q - 2 * n * c + constant for q, c in zip(squares, cross)]

        return by_limbs
    sums = np.array(found.sums, dtype=object)
    return lambda x: (np.square(n * (x.astype(object) - found.low.astype(object)) - sums)).sum(axis=1).tolist()


def _whitened_of(found: Fit, error: float | None, cfg: Whitening):
    project, rank, top = _projector(found, cfg)
    deviations = _deviations(found)
    explained = [float(max(v, 0.0)) / found.trace if found.trace > 0 else None for v in found.values[:top]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = whole(part, cfg)
                rows = len(x)
                values = np.full((rows, top), np.nan)
                values[:, :rank] = project(x)
                exact = deviations(x)
                which = pa.array(np.repeat(np.arange(rows), top))
                long = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
                wide = pa.array([Decimal(d) if d < 10**38 else None for d in exact], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(which),
                        pa.array(np.tile(np.arange(1, top + 1), rows), pa.int32()),
                        pa.array(np.full(rows * top, found.n), pa.int64()),
                        long.take(which),
                        pa.array(values.ravel(), pa.float64(), mask=np.isnan(values.ravel())),
                        pa.array(explained * rows, pa.float64()),
                        pa.array([error] * (rows * top), pa.float64()),
                        wide.take(which),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
                )

    return run


def whiten(rows: DataFrame, cfg: Whitening = Whitening(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact) for every usable row and component.

    Defined cases. A vector that is null, empty, or holds a null or non-finite entry takes no part; neither does one of
    another length than most have (of two lengths as frequent, the shorter counts). Scaled entries beyond 2**62 are held
    there. A component without variance (fewer rows than dimensions, constant dimensions) has null in ``whitened`` and
    takes no part in ``identity_error``. ``deviation`` is null where it does not fit 64 bits; ``deviation_exact`` holds it
    up to 38 digits. Repeated rows and ids count as often as they come. An empty table gives an empty result. Other
    columns take no part.
    """
    vectors = usable(rows, vec_id, vector)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, "
        "deviation_exact decimal(38,0)"
    )
    found = fit(vectors, cfg)
    if found is None:
        out = rows.sparkSession.createDataFrame([], schema)
    else:
        error = identity_error(vectors, found, cfg)
        out = vectors.mapInArrow(_whitened_of(found, error, cfg), schema)
    return out.withColumnRenamed("id", vec_id)
