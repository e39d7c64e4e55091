import tracemalloc

import numpy as np

from tasteforge.llm.language import Kernel, fit, identify, pieces, presence, score_texts, training_sample

SMALL = Kernel(bits=12, per_language=20, landmarks=16, piece=64)
TEXTS = {
    "en": ["the cat and the dog went with this thing to that house", "which of these would they rather think about there"],
    "de": ["der Hund und die Katze gingen nicht ohne das schöne Haus", "ich möchte über diese Straße auch noch schnell gehen"],
    "fr": ["le chien et la chatte étaient avec eux dans la maison", "nous voulons que cette école soit très près du château"],
}


def train(cfg=SMALL):
    texts = [t for group in TEXTS.values() for t in group]
    labels = [name for name, group in TEXTS.items() for _ in group]
    return fit(texts, labels, cfg)


def test_multiplied_out_weights_equal_the_plain_kernel_solution():
    """Scores from landmarks, kernel matrix and ridge written out step by step, on grams counted in a Python set."""
    cfg = Kernel(bits=20, per_language=20, landmarks=6, piece=4096)
    texts = [t for group in TEXTS.values() for t in group]
    kind = np.repeat(np.arange(3), 2)
    model = fit(texts, [["de", "en", "fr"][k] for k in kind], cfg)

    def grams(text):
        clean = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
        return {clean[i : i + n] for n in range(1, 5) for i in range(len(clean) - n + 1)}

    def kernel(a, b):
        return np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])

    sets = [grams(t) for t in texts]
    marks = sets
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    root = vectors / np.sqrt(values)
    features = kernel(sets, marks) @ root
    mean = features.mean(axis=0)
    targets = np.where(kind[:, None] == np.arange(3), 1.0, -1.0)
    offset = targets.mean(axis=0)
    centred = (features - mean) / np.sqrt(2)
    solved = np.linalg.solve(centred.T @ centred + cfg.ridge * np.eye(6) / 3, centred.T @ ((targets - offset) / np.sqrt(2)))
    new = "die schöne cat et le house"
    expected = (kernel([grams(new)], marks) @ root - mean) @ solved + offset
    got = presence(pieces([new], cfg)[0], cfg) @ model.weights + model.bias
    assert np.allclose(got, expected, atol=2e-2)


def test_predictions_and_defined_cases(spark):
    rows = [(1, "die Katze und der Hund"), (2, "the dog and this cat"), (3, "le chat et la maison " * 5000), (4, None), (5, ""), (6, "123 !?"), (2, "the dog and this cat")]
    df = spark.createDataFrame([(*r, "xx", 3.0) for r in rows], "doc_id long, text string, lang_pred string, lang double")
    got = identify(df, train(), SMALL)
    assert got.columns == ["doc_id", "lang", "lang_pred", "score"]
    found = sorted((r.doc_id, r.lang_pred) for r in got.collect())
    assert found == [(1, "de"), (2, "en"), (2, "en"), (3, "fr"), (4, "und"), (5, "und"), (6, "und")]
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert identify(df.limit(0), train(), SMALL).count() == 0


def test_whole_long_texts_count():
    start, rest = "the dog and this cat " * 3, "der Hund und die Katze ich möchte " * 400
    assert score_texts([start + rest], train(), SMALL)[0] == ["de"]


def test_sample_is_bounded_and_independent_of_row_order(spark):
    rows = [(f"text {i} a", "en" if i % 3 else "de") for i in range(200)] + [(None, "en"), ("no label", None)]
    cfg = Kernel(per_language=10)
    one = training_sample(spark.createDataFrame(rows, "text string, lang string"), cfg)
    two = training_sample(spark.createDataFrame(rows[::-1], "text string, lang string").repartition(5), cfg)
    assert one == two and len(one[0]) == 20


def test_copies_take_one_place_of_the_sample(spark):
    rows = [("the same text", "en")] * 400 + [(f"text {chr(97 + i // 26)}{chr(97 + i % 26)}", "en") for i in range(300)] + [("123 !", "en")] * 9
    texts, labels = training_sample(spark.createDataFrame(rows, "text string, lang string"), Kernel(per_language=150))
    assert len(texts) == len(set(texts)) == 150 and set(labels) == {"en"} and "123 !" not in texts
    few, _ = training_sample(spark.createDataFrame(rows, "text string, lang string"), Kernel(per_language=1000))
    assert len(few) == 301


def test_forty_languages_fit_in_bounded_memory():
    cfg = Kernel(per_language=40, piece=256)
    rng = np.random.default_rng(2)
    letters = [chr(0x400 + i) for i in range(200)]
    texts = ["".join(rng.choice(letters[4 * k : 4 * k + 30], 200)) for k in range(40) for _ in range(40)]
    tracemalloc.start()
    model = fit(texts, [f"l{k:02}" for k in range(40) for _ in range(40)], cfg)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.languages) == 40 and peak < 500 << 20


def test_no_labelled_rows():
    model = fit([], [], SMALL)
    assert score_texts(["some text", None], model, SMALL)[0] == ["und", "und"]
