import random

import numpy as np
import pytest

from tasteforge.llm import toxicity as tox
from tasteforge.llm.toxicity import FEATURES, Network, Scorer, labelled_sample, score_documents, train, train_in_task, training_sample

SMALL = Network(window=12, stride=8, hidden=4, batch=32, rounds=2)


def corpus(n=400, seed=1):
    """Clean words, and in half of the texts words with one telling stem; most of those words are met once."""
    rng = random.Random(seed)
    plain = ["w" + "".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "zork" + "".join(rng.choice("hijk") for _ in range(3))
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return train(*corpus(), SMALL)


def test_held_out_accuracy_on_unseen_words(model):
    texts, labels = corpus(200, seed=2)
    scores, _ = Scorer(model, SMALL).score(texts)
    right = (scores >= 0.3) == np.array(labels, bool)
    assert right.mean() > 0.95
    assert ((scores >= 0) & (scores <= 1)).all()


def test_gradients_agree_with_differences():
    cfg = Network(hidden=3)
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in tox.initial(cfg).items()}
    x = rng.normal(size=(6, 4, FEATURES))
    lengths, y = np.array([6, 3, 1, 5]), np.array([1.0, 0, 1, 0])

    def loss(w):
        w = {k: v.astype(np.float32) for k, v in w.items()}
        p = tox.forward(x.astype(np.float32), lengths, w).astype(np.float64)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    keep = {}
    w32 = {k: v.astype(np.float32) for k, v in weights.items()}
    p = tox.forward(x.astype(np.float32), lengths, w32, keep)
    grads = tox.gradients(keep, (p - y).astype(np.float32), w32)
    for key, g in grads.items():
        for place in np.ndindex(weights[key].shape):
            up, down = ({k: v.copy() for k, v in weights.items()} for _ in range(2))
            up[key][place] += 1e-2
            down[key][place] -= 1e-2
            assert abs((loss(up) - loss(down)) / 2e-2 - g[place]) < 2e-2, key


def test_windows_cover_every_word():
    for n in (0, 1, 63, 64, 65, 112, 500):
        starts = tox.window_starts(n, Network())
        covered = {i for s in starts for i in range(s, min(n, s + 64))}
        assert covered == set(range(n)) and all(s + 64 <= n or s == 0 for s in starts)


def test_worst_window_is_found_anywhere_and_batches_do_not_matter(model):
    words = corpus(2, seed=5)[0][1].split() * 40
    texts = []
    for place in (0, len(words) // 2, len(words) - 1):
        own = list(words)
        own[place] = "zorkhij"
        texts.append(" ".join(own))
    scorer = Scorer(model, SMALL)
    scores, starts = scorer.score(texts, chunk=7)
    assert (scores > 0.3).all()
    assert all(s <= p < s + SMALL.window for s, p in zip(starts, (0, len(words) // 2, len(words) - 1), strict=True))
    alone = [Scorer(model, SMALL).score([t])[0][0] for t in texts]
    assert np.allclose(scores, alone, atol=1e-5)


def test_no_ngram_of_a_long_word_is_lost():
    rng = random.Random(9)
    for n in (50, 51, 52, 54, 55, 95, 96, 97, 142, 143, 500):
        word = "".join(rng.choice("abcdefgh") for _ in range(n))
        marked = f"^{word}$"
        whole = {marked[i : i + k] for k in range(3, 6) for i in range(len(marked) - k + 1)}
        pieces = tox.words_in(word, SMALL)
        assert set().union(*(tox.ngrams(p, SMALL) for p in pieces)) == whole
        assert all(len(p.strip(tox.CUT)) <= SMALL.piece for p in pieces) and (len(pieces) == 1) == (n <= 50)


def test_the_middle_of_a_long_word_is_scored(model):
    plain = "_".join(corpus(1, seed=7)[0][0].split()[1:2] * 40)
    scores, _ = Scorer(model, SMALL).score([plain, plain[:120] + "_zorkhij_zorkijk_" + plain[120:]])
    assert scores[0] < 0.3 <= scores[1]


def test_frames_and_defined_cases(spark, model):
    rows = [(1, "wabcd wefga zorkhik"), (1, "wabcd wefga zorkhik"), (2, None), (3, ""), (4, "!? --"), (None, "wabcd " * 30_000)]
    df = spark.createDataFrame([(*r, 9.0) for r in rows], "doc_id long, text string, score double")
    got = score_documents(df, model, SMALL)
    assert got.columns == ["doc_id", "score"]
    scores = [(r.doc_id, r.score) for r in got.collect()]
    assert len(scores) == 6 and scores[0] == scores[1] and scores[0][1] >= 0.3
    assert all(s < 0.3 for d, s in scores if d != 1)
    assert score_documents(df.limit(0), model, SMALL, keep_text=True).columns == ["doc_id", "text", "score"]


def test_sample_bounds_and_odd_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, 1), (5, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    cfg = Network(toxic=7, other=11)
    one = training_sample(docs, labels, cfg)
    two = training_sample(docs.repartition(4), labels.repartition(3), cfg)
    assert sorted(zip(*one, strict=True)) == sorted(zip(*two, strict=True))
    assert 6 <= sum(one[1]) <= 7 and len(one[1]) <= 18


def test_sample_takes_one_text_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(500)] + [(2, "other"), (2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    one = training_sample(docs, labels, Network())
    assert sorted(one[1]) == [0, 1] and one[0][one[1].index(0)] == "other"
    two = training_sample(docs.repartition(5), labels, Network())
    assert sorted(zip(*one, strict=True)) == sorted(zip(*two, strict=True))


def test_one_kind_of_label_only():
    for labels, high in (([0, 0], False), ([1, 1], True), ([], False)):
        fitted = train(["some words", "other words"][: len(labels)], labels, SMALL)
        scores, _ = Scorer(fitted, SMALL).score(["any text", None])
        assert bool((scores >= 0.3).all()) == high


def test_training_in_a_task_gives_the_same_model(spark):
    rows = [(i, f"{'vile awful ' if i % 5 == 0 else 'kind plain '}word{i % 7} and more text", int(i % 5 == 0)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    cfg = Network(rounds=1, epochs=1)
    there = train_in_task(labelled_sample(docs, labels, cfg), cfg)
    here = train(*training_sample(docs, labels, cfg), cfg)
    assert there.tables == here.tables and there.usual == here.usual
    assert all((there.weights[k] == here.weights[k]).all() for k in here.weights)
    nothing = train_in_task(labelled_sample(docs.limit(0), labels.limit(0), cfg), cfg)
    assert nothing.tables.words == {} and 0 <= nothing.usual < 0.3
