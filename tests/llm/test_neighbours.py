from pathlib import Path

import numpy as np
import pytest

from tasteforge.llm.neighbours import Index, Tables, hamming, learn, nearest

SF = "/root/testdata/sf0.01"


def brute_force(rows, k):
    out = []
    good = [(i, np.array(v, float)) for i, v in rows]
    for q, v in good:
        if q % 20 == 0:
            scores = sorted((-(w * v).sum(), i) for i, w in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return out


def ask(spark, rows, k=20, cfg=Index()):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = nearest(df, lambda c: c % 20 == 0, k, cfg)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, d, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, d)) * rng.uniform(1, spread, size=(n, 1))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(data)]


def test_pigeonhole_retrieves_every_code_in_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 16, (500, 4)).astype(np.uint16)
    tables = Tables(codes)
    for radius in (0, 5, 18, 24, 40, 64):
        for code in codes[:10]:
            assert tables.within(code, radius).tolist() == np.flatnonzero(hamming(codes, code) <= radius).tolist()


def recall(got, expected):
    return len({r[:1] + r[2:3] for r in got} & {r[:1] + r[2:3] for r in expected}) / len(expected)


@pytest.mark.parametrize("spread", [1.0, 3.0])
def test_recall_and_scores_against_brute_force(spark, spread):
    rows = vectors(900, 24, spread=spread)
    got, expected = ask(spark, rows, 10, Index(block=256, chunk=16)), brute_force(rows, 10)
    assert len(got) == len(expected) and recall(got, expected) >= 0.9
    table = dict(rows)
    assert all(abs(s - float(np.dot(table[q], table[i]))) < 1e-9 for q, _, i, s in got)
    assert [r[:2] for r in got] == [r[:2] for r in expected]


def test_copies_ties_and_few_rows(spark):
    same = [(i, [1.0, 0.5, 0.25]) for i in range(100)]
    assert ask(spark, same, 20, Index(block=16)) == brute_force(same, 20)
    few = vectors(5, 8)
    got = ask(spark, few)
    assert [r[:3] for r in got] == [r[:3] for r in brute_force(few, 20)]


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, []), (1, [0.5, 1.0]), (20, [-1.0, 0.0])]
    assert [r[:3] for r in ask(spark, rows)] == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert ask(spark, []) == [] and ask(spark, [(1, [1.0])]) == [] and ask(spark, [(0, [1.0])]) == []


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")
def test_recall_on_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = [tuple(r) for r in nearest(df, lambda c: c % 20 == 0).collect()]
    expected = brute_force([(r.vec_id, r.embedding) for r in df.collect()], 20)
    assert len(got) == len(expected) and recall(got, expected) >= 0.9


def test_rotation_is_learned():
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(300, 10)) * np.linspace(0.1, 3, 10)
    cfg = Index(bits=32)
    coder = learn(sample, float(np.linalg.norm(sample, axis=1).max()), 5, cfg)
    first = coder.rotation[:, :11]
    assert np.allclose(first.T @ first, np.eye(11), atol=1e-8)
    assert 0 < coder.radius < 32
