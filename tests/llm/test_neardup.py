import itertools
import random
import re

import pytest

from tasteforge.llm import neardup
from tasteforge.llm.components import connected_components
from tasteforge.llm.neardup import MinHash, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute_force(rows, k=4, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = rows[i][0], rows[j][0]
        if a is None or b is None or not sets[i] or not sets[j]:
            continue
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted(
        ((d, len(s), None if d is None else find(d), d is not None and find(d) == d) for (d, _), s in zip(rows, sets, strict=True)), key=repr
    )


def run(spark, rows, cfg=MinHash(), **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, n long")
    got = near_duplicates(df, cfg, **more)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def corpus(seed, families=25):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    rows, doc = [], 0
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 160))]
        for _ in range(rng.randrange(1, 8)):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((doc, rng.choice([" ", "  \n", "\t"]).join(words)))
            doc += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_families_match_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute_force(rows)


def test_blocked_rest_finds_what_stars_do_not(spark):
    rows = corpus(3, 12)
    cfg = MinHash(star_rounds=1, diagonals=8, block=2)
    assert run(spark, rows, cfg) == brute_force(rows)


def test_edges_of_the_contract(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ÉCOLE un"), (8, "école un"), (9, "a\x0bb\x1cc"),
        (10, long), (11, long + " tail"), (12, "A b C d e"), (13, "a B c D e"), (None, "a b c d e"), (13, "a B c D e"), (20, "p q r s"), (20, "one"),
    ]
    assert run(spark, rows) == brute_force(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_five_word_variant(spark):
    rows = corpus(4, 12)
    assert run(spark, rows, MinHash(shingle=5)) == brute_force(rows, 5)


def test_a_hot_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, "something else entirely here")]
    for i in range(1, 301):
        words = list(base)
        words[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(words)))
    seen = []
    real = neardup.confirm
    monkeypatch.setattr(neardup, "confirm", lambda pairs, *a: (seen.append(pairs.count()), real(pairs, *a))[1])
    assert {r[2] for r in run(spark, rows)} == {0, 1}
    assert sum(seen) <= 301 * MinHash().star_rounds


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100), (7, 3)] + [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(40)]
    root = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
