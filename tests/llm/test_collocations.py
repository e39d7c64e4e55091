"""Collocations against a plain version in Python, over shards of many sizes, and odd rows."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tasteforge.llm.collocations import Phrases, _shards, collocations

SCHEMA = "doc_id bigint, text string, lang string, phrase string"


def plain(rows, cfg):
    counts, words = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(found)
            for k in range(1, cfg.longest + 1):
                for i in range(len(found) - k + 1):
                    counts[lang, tuple(found[i : i + k])] += 1
    frequent = {p: c for p, c in counts.items() if len(p[1]) > 1 and c >= cfg.support}
    dropped = {
        (lang, q[i : i + k])
        for (lang, q), c in frequent.items()
        for k in range(2, len(q))
        for i in range(len(q) - k + 1)
        if 100 * c >= cfg.cover * counts[lang, q[i : i + k]]
    }
    listed = defaultdict(list)
    for (lang, p), a in frequent.items():
        if (lang, p) in dropped:
            continue
        cuts = [(1000 * a * words[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        listed[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], k))
    out = []
    for lang, found in listed.items():
        for rank, (score, a, phrase, l, r, k) in enumerate(sorted(found)[: cfg.top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -score, phrase.count(b" ") + 1, k))
    return sorted(out)


def corpus(n=300, seed=5):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "São", "Ünder", "a\tb", "x"] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(n):
        parts = rng.choices(words, weights=[9, 3, 8, 6, 5, 4, 3, 2, 2, 2] + [1] * 12, k=rng.randrange(1, 40))
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!? "]) for p in parts)
        if i % 3 == 0:
            text += " New York  City of the"
        rows.append((i, text, rng.choice(["en", "en", "fr", None, "und"]), "other"))
    return rows + [(1000, None, "en", ""), (1001, "", None, ""), (1002, " \t.,", "de", ""), (1003, "lonely words", "it", "")]


@pytest.mark.parametrize("cfg", [
    Phrases(support=10, shard_bytes=300, count_bytes=500, held=40, counted=50, filter_bits=1 << 12),
    Phrases(support=25, shard_bytes=4000, filter_bits=1 << 16, cover=80, known=1),
    Phrases(support=6, shard_bytes=1 << 20, filter_bits=1 << 16, longest=4, top=7),
    Phrases(support=1, shard_bytes=900, count_bytes=900, filter_bits=1 << 20, known=2),
])
def test_it_equals_the_plain_version(spark, cfg):
    rows = corpus()
    got = collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), cfg)
    expected = plain(rows, cfg)
    assert expected and sorted(tuple(r) for r in got.collect()) == expected


def test_a_hot_phrase_and_copies(spark):
    rows = [(i, "breaking news today, " * 50 + f"tail {i % 7}", "en", "") for i in range(60)]
    got = collocations(spark.createDataFrame(rows, SCHEMA).repartition(6), Phrases(shard_bytes=5000))
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, Phrases())


def test_scores_are_exact_beyond_64_bits(spark):
    """1000 a n and l r pass 64 bits here; the decimals are the ones the operator uses."""
    a, n, l, r = 3_000_000_007, 9_000_000_000_000_011, 5_000_000_029, 4_000_000_007
    frame = spark.sql(f"SELECT cast({a} AS decimal(18,0)) a, cast({n} AS decimal(18,0)) n, cast({l} AS decimal(18,0)) l, cast({r} AS decimal(18,0)) r")
    got = frame.selectExpr("cast(cast(1000 AS decimal(4,0)) * a * n AS decimal(38,0)) div (l * r) AS score").first()["score"]
    assert got == 1000 * a * n // (l * r)


def test_empty_tables(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations(spark.createDataFrame([(1, None, None, "")], SCHEMA), Phrases(support=1)).collect() == []


def test_shards_are_bounded_and_hold_every_word():
    texts = ["one two. three"] * 40 + ["long " * 500, "", "a b"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "fr"] * 21 + ["en"], "text": texts})
    shards = list(_shards(iter([batch] * 3), 700, texts=False))
    assert len(shards) > 1
    assert sum(len(k) for s in shards for w in s.values() for k in w.keys) == 3 * (40 * 3 + 500 + 2)
