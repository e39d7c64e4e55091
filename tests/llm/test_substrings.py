import random
import re

import pytest

from tasteforge.llm.substrings import Parsing, duplicate_factors, remove_repeated

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, window=20):
    """(doc_id, n_words, n_removed, kept words) by a first-seen table over all windows in corpus order."""
    first, out = {}, []
    split = {d: WORD.findall(t or "") for d, t in rows}
    for doc in sorted(split):
        words = split[doc]
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first.setdefault(tuple(words[i : i + window]), (doc, i)) != (doc, i):
                gone[i : i + window] = [True] * window
        out.append((doc, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def run(spark, rows, cfg=Parsing()):
    df = spark.createDataFrame([(*r, "k", 5) for r in rows], "doc_id long, text string, kept string, tag int")
    got = remove_repeated(df, cfg, single_space=True)
    assert got.columns == ["doc_id", "text", "tag", "n_words", "n_removed", "kept"]
    return sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept").collect())


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(40)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(15, 80))] for _ in range(8)]
    rows = []
    for doc in range(60):
        words = []
        for _ in range(rng.randrange(0, 6)):
            piece = rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
            cut = rng.randrange(len(piece) + 1) if rng.random() < 0.4 else 0
            words += piece[cut:]
        if rng.random() < 0.2:
            words += [rng.choice("ab")] * rng.randrange(60) + ["x", "y"] * rng.randrange(30)
        rows.append((doc * 3, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(1000 + i, rows[i][1]) for i in range(10)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cfg", [Parsing(), Parsing(heavy=2), Parsing(filter_bits=64, heavy_bits=64)])
def test_matches_brute_force(spark, cfg):
    rows = corpus(11)
    assert run(spark, rows, cfg) == brute_force(rows)


def test_periodic_and_extreme_texts(spark):
    rows = [(1, None), (2, ""), (3, "a " * 19), (4, "b " * 20), (5, "c " * 5000), (6, "b " * 21), (7, "x y " * 40), (8, "é\x0bü " * 400), (9, " ".join(f"q{i}" for i in range(50_000)))]
    rows += [(10, rows[-1][1] + " end")]
    assert run(spark, rows) == brute_force(rows)
    assert run(spark, []) == []


def test_repeated_ids_and_null_ids(spark):
    long = " ".join(f"p{i}" for i in range(30))
    rows = [(None, long), (5, long), (5, long), (6, long + " tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_removed) for r in remove_repeated(df).collect()}
    assert got == {(None, 0), (5, 0), (6, 30)}


def test_own_white_space_is_kept(spark):
    long = " ".join(f"p{i}" for i in range(30))
    df = spark.createDataFrame([(1, long), (2, f"One\n\ntwo {long}\n three  four \n"), (3, " untouched \t text ")], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in remove_repeated(df).collect()}
    assert got == {1: long, 2: "One\n\ntwo\n three  four \n", 3: " untouched \t text "}


def test_factors_are_copies_of_their_sources(spark):
    rows = corpus(12)
    words = {d: WORD.findall(t) for d, t in rows}
    found = duplicate_factors(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert found
    for f in found:
        assert words[f.doc_id][f.start : f.start + f.n_words] == words[f.ref_doc_id][f.ref_start : f.ref_start + f.n_words]
        assert (f.ref_doc_id, f.ref_start) < (f.doc_id, f.start) and f.n_words >= 20
