"""Source mixing against a plain version with fractions, its texts, and odd rows."""

import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tasteforge.llm.mixing import Mix, mix_sources, mixed_texts, source_targets

SCHEMA = "doc_id bigint, text string, source string, extra int"


def plain_targets(sizes: dict, weights=(3, 1, 2), share=Fraction(3, 2), most=2) -> dict:
    """Share by weight, stop at the cap, share what is left over again, as the words of the contract say."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = {}, share * sum(sizes.values())
    while len(target) < len(names):
        rest = [s for s in names if s not in target]
        unit = left / sum(weight[s] for s in rest)
        above = [s for s in rest if unit * weight[s] > most * sizes[s]]
        for s in above or rest:
            target[s] = Fraction(most * sizes[s]) if above else unit * weight[s]
        left -= sum(target[s] for s in above)
    return target


def plain_mix(rows):
    sizes, by_source = defaultdict(int), defaultdict(list)
    for doc_id, text, source, _ in rows:
        n = len((text or "").split())
        sizes[source] += n
        by_source[source].append((hashlib.md5(str("" if doc_id is None else doc_id).encode()).hexdigest(), doc_id is not None, doc_id, n))
    out = []
    for source, target in plain_targets(sizes).items():
        budget, total, at = int(target + Fraction(1, 2)), sizes[source], 0
        for _, _, doc_id, n in sorted(by_source[source], key=lambda x: (x[0], x[1], x[2] or 0, x[3])):
            whole, cut = divmod(budget, total) if total else (0, 0)
            out.append((doc_id, source, n, total, float(target), whole * n + max(0, min(n, cut - at))))
            at += n
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sample():
    rows = [(i, " ".join(f"w{j}" for j in range(i * 7 % 23)), f"s{min(i % 9, 3)}", i) for i in range(200)]
    rows += [(i, "one two", None, 0) for i in range(200, 205)] + [(i, "x " * 400, "é", 0) for i in range(205, 208)]
    rows += [(None, "a b c", "s0", 0), (None, "a b", "s0", 0), (5, "again and again", "s1", 0), (5, "again and again", "s1", 0)]
    return rows + [(300, None, "s0", 0), (301, "", "empty", 0), (302, " \t\n", "empty", 0)]


def test_it_equals_the_plain_version(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = rows_of(mix_sources(docs))
    assert got == plain_mix(rows)
    assert got == rows_of(mix_sources(docs.repartition(2)))
    assert all(taken <= 2 * size for _, _, size, _, _, taken in got)


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 5}, {"a": 7}, {"a": 0, "b": 0}, {None: 9, "b": 1, "a": 100, "d": 0}])
def test_targets(spark, sizes):
    found = source_targets(spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()], "no_source boolean, source string, source_size bigint"))
    got = {None if r["no_source"] else r["source"]: r["target"] for r in found.collect()}
    assert got == {s: float(t) for s, t in plain_targets(sizes).items()}


def test_other_weights_and_share(spark):
    sizes = {f"s{i:02d}": (i * 37) % 50 + 1 for i in range(30)}
    frame = spark.createDataFrame([(False, s, n) for s, n in sizes.items()], "no_source boolean, source string, source_size bigint")
    got = {r["source"]: r["target"] for r in source_targets(frame, Mix((5, 2, 4, 1), (7, 4), 3)).collect()}
    expected = plain_targets(sizes, (5, 2, 4, 1), Fraction(7, 4), 3)
    assert got == pytest.approx({s: float(t) for s, t in expected.items()})


def test_texts_of_the_mix(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, SCHEMA)
    mix = mix_sources(docs, carry=("text", "extra"))
    texts = mixed_texts(mix)
    assert texts.where(F.size(F.split(F.trim("text"), r"[\x20\x09-\x0D]+")) != F.col("words")).count() == 0
    by_source = {r["source"]: r["words"] for r in texts.groupBy("source").agg(F.sum("words").alias("words")).collect()}
    taken = {r["source"]: r["taken"] for r in mix.groupBy("source").agg(F.sum("taken").alias("taken")).collect() if r["taken"]}
    assert by_source == taken
    cut = texts.join(docs, "doc_id").where("doc_id is not null and doc_id <> 5").select(texts["text"], docs["text"].alias("all")).collect()
    assert all(r["all"].startswith(r["text"]) for r in cut)


def test_hot_source_copies_and_an_empty_table(spark):
    rows = [(7, "same words here", "hot", 0)] * 300 + [(i, "a b", f"s{i}", 0) for i in range(50)]
    got = rows_of(mix_sources(spark.createDataFrame(rows, SCHEMA).repartition(8)))
    assert got == plain_mix(rows)
    assert mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def test_carried_names_must_not_clash(spark):
    with pytest.raises(ValueError, match="size"):
        mix_sources(spark.createDataFrame([(1, "a", "s", 1)], "doc_id int, text string, source string, size int"), carry=("size",))
