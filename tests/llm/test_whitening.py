"""Whitening against numpy and whole-number arithmetic on the same rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tasteforge.llm.whitening import Fit, Whitening, _deviations, add_scatter, planes, whiten

SCHEMA = "vec_id bigint, embedding array<float>, component string"


def plain(rows, cfg=Whitening()):
    """x, n, S and the covariance, with Python's integers and fractions."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {k: [math.floor(cfg.scale * float(np.float32(c))) + cfg.offset for c in v] for k, (_, v) in enumerate(kept)}
    n, dims = len(x), len(kept[0][1])
    sums = [sum(r[d] for r in x.values()) for d in range(dims)]
    cov = np.array([[float(Fraction(sum((n * r[a] - sums[a]) * (n * r[b] - sums[b]) for r in x.values()), n**3)) for b in range(dims)] for a in range(dims)])
    return [i for i, _ in kept], list(x.values()), n, sums, cov


def vectors(n=90, dims=11, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, dims)) @ np.diag(np.linspace(1, 0.05, dims)) @ rng.normal(size=(dims, dims)) * 0.1
    return [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]


def test_it_equals_the_plain_version(spark):
    rows = vectors() + [(500, None), (501, []), (502, [None] * 11), (503, [float("nan")] * 11), (504, [math.inf] + [0.0] * 10), (505, [1.0] * 3)]
    ids, x, n, sums, cov = plain(rows[:90])
    frame = spark.createDataFrame([(i, v, "other") for i, v in rows], SCHEMA).repartition(5)
    got = whiten(frame).collect()
    assert len(got) == 8 * 90 and {r["n"] for r in got} == {90}
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes.T[::-1]
    by_row = {(r["vec_id"], r["component"]): r for r in got}
    centred = np.array([[float(Fraction(a) - Fraction(s, n)) for a, s in zip(row, sums)] for row in x])
    for c in range(8):
        column = centred @ axes[c] / math.sqrt(values[c])
        found = np.array([by_row[i, c + 1]["whitened"] for i in ids])
        assert np.allclose(found, column * np.sign(found @ column), atol=1e-9)
        assert by_row[0, c + 1]["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
    for k, i in enumerate(ids):
        assert by_row[i, 1]["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x[k], sums)) == by_row[i, 8]["deviation_exact"]
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-9


def test_planes_give_exact_products_also_of_wide_values():
    rng = np.random.default_rng(1)
    for bits in (1, 7, 16, 17, 40, 64):
        y = rng.integers(0, 1 << bits, size=(131, 4), dtype=np.uint64, endpoint=False) if bits < 64 else rng.integers(0, 2**64 - 1, size=(131, 4), dtype=np.uint64)
        limbs = -(-bits // 16)
        scatter, sums = np.zeros((2 * limbs - 1, 4, 4), np.int64), np.zeros((limbs, 4), np.int64)
        for part in (y[:100], y[100:]):
            add_scatter(scatter, sums, planes(part, bits))
        exact = y.astype(object)
        total = sum(scatter[k].astype(object) << (16 * k) for k in range(len(scatter)))
        assert (np.triu(total.astype(object)) == np.triu((exact.T @ exact))).all()
        assert (sum(sums[k].astype(object) << (16 * k) for k in range(limbs)) == exact.sum(axis=0)).all()


@pytest.mark.parametrize("n,width", [(1000, 100), (10**10, 2000), (10**12, 1 << 45)])
def test_deviations_stay_exact_beyond_64_bits(n, width):
    rng = np.random.default_rng(2)
    y = rng.integers(0, width, size=(20, 6))
    y[0], y[1] = 0, width
    low = np.full(6, -50)
    sums = [int(s) * (n // 20) + 7 for s in y.sum(axis=0)]
    found = Fit(n, low, low + width, sums, None, None, None, 0.0)
    assert [int(d) for d in _deviations(found)(y + low)] == [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in y]


def test_odd_tables(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, "a")], SCHEMA)).collect() == []
    one = whiten(spark.createDataFrame([(1, [0.5, 0.25], "a")], SCHEMA)).collect()
    assert [(r["component"], r["whitened"], r["deviation"], r["explained"]) for r in one] == [(1, None, 0, None), (2, None, 0, None)]
    rows = [(None, [1.0, 2.0, 3.0], "a"), (4, [2.0, 2.0, 3.0], "a"), (4, [2.0, 2.0, 3.0], "a"), (5, [1.0, 2.0], "b")]
    got = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 9 and {r["n"] for r in got} == {3}
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got)


def test_entries_far_out_are_held(spark):
    rows = [(i, [3.0e38 if i == 3 else float(i), float(i * i)], "a") for i in range(6)]
    got = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 12 and all(r["deviation_exact"] is None or r["deviation_exact"] > 0 for r in got)
    assert all(r["deviation"] is None for r in got)
