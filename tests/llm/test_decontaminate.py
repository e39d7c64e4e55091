import random

import pyarrow as pa

from tasteforge.llm.decontaminate import Templates, flag_contaminated, item_classes, symbols_of, template_matches

ITEMS = [
    (1, "A train leaves Paris at 9 and travels 300 km in 4 hours before it meets Anna Smith on the bridge."),
    (2, "Compute the sum of all primes below twenty without any help from a calculator or a book."),
    (3, "what is love"),
    (4, None),
    (5, ""),
    (6, "Mary has 5 apples and gives 5 pears to her friend who already owns three red plums"),
]
FILLER = "some other words stand before it. "


def flags(spark, texts, items=ITEMS, cfg=Templates()):
    docs = spark.createDataFrame([(i, t, "z", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, tag string, coverage double")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = flag_contaminated(docs, bench, cfg)
    assert got.columns == ["doc_id", "contaminated", "item_ids", "coverage", "exact"]
    return {r.doc_id: (r.item_ids, r.exact) for r in got.collect()}


def test_copies_parameters_and_clean_texts(spark):
    texts = [
        FILLER + ITEMS[0][1] + " the end",
        FILLER + "A train leaves London at 7 and travels 250 miles in 3 minutes before it meets Bob on the bridge. " * 2,
        FILLER + "a TRAIN leaves Paris at 9 and travels 300 km",
        ITEMS[1][1].upper().replace(" ", "***  "),
        "compute the sum of all primes below " + "noise " * 300,
        "John has 7 apples and gives 7 pears to her friend who already owns three red plums",
        "John has 7 apples and gives 8 pears to her friend who already owns three red plums",
        "she asked: what is love?",
        None, "", "word " * 100_000,
    ]
    got = flags(spark, texts)
    assert got[0] == ([1], True) and got[1] == ([1], False) and got[3][0] == [2]
    assert got[2] == ([], False) and got[4] == ([], False)
    assert got[5] == ([6], False) and got[6] == ([], False)
    assert got[7][0] == [3]
    assert all(got[i] == ([], False) for i in (8, 9, 10))


def test_agrees_with_brute_force_on_planted_passages(spark):
    rng = random.Random(3)
    vocabulary = ["w" + "".join(rng.choice("abcde") for _ in range(3)) for _ in range(120)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(10, 40))) for i in range(20)]
    texts, expected = [], {}
    for d in range(80):
        body, inside = text(rng.randrange(0, 80)), set()
        for i in rng.sample(range(20), rng.choice([0, 0, 1, 2])):
            words = items[i][1].split()
            cut = rng.choice([0, 0, len(words) // 4])
            body += " " + " ".join(words[cut:]) + " " + text(rng.randrange(30))
        joined = f" {body} "
        for i, t in items:
            words = t.split()
            windows = [" ".join(words[k : k + 8]) for k in range(len(words) - 7)]
            if sum(f" {w} " in joined for w in windows) >= 0.5 * len(windows):
                inside.add(i)
        texts.append(body)
        expected[d] = sorted(inside)
    got = flags(spark, texts, items)
    assert {d: v[0] for d, v in got.items()} == expected and any(expected.values())


def test_quotes_of_a_small_share_agree_with_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["w" + "".join(rng.choice("abcde") for _ in range(4)) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([60, 90, 200]))) for i in range(12)]
    texts, expected = [], {}
    for d in range(60):
        body = text(20)
        for i in rng.sample(range(12), 2):
            words = items[i][1].split()
            n = rng.choice([7, 10, 11, 15, len(words) * rng.randrange(25, 46) // 100])
            at = rng.randrange(len(words) - n + 1)
            body += " " + " ".join(words[at : at + n]) + " " + text(10)
        grams = lambda t, k=Templates().run: {tuple(t.split()[j : j + k]) for j in range(len(t.split()) - k + 1)}
        texts.append(body)
        expected[d] = [i for i, t in items if grams(t) & grams(body)]
    got = flags(spark, texts, items)
    assert {d: v[0] for d, v in got.items()} == expected
    assert 0 < sum(map(len, expected.values())) < 120


def test_a_long_verbatim_part_counts_beside_other_values(spark):
    item = "Mary has 5 apples and gives 5 pears to her friend who already owns three red plums from the old garden behind the house of a baker"
    other = item.replace("has 5", "has 7").replace("gives 5", "gives 8")
    changed = item.replace("5", "7").rpartition(" her friend ")[0] + " her friend who already owns three red plums in town"
    tail = item.partition("three red")[0]
    got = flags(spark, [other, changed, tail], [(1, item)])
    assert got[0] == ([1], True) and got[1] == ([1], False) and got[2] == ([1], True)


def test_slots_and_short_items_are_found_word_for_word(spark):
    items = ["Is 17 prime?", "Add 3 and 5", "Solve x = 3", "Alice 3, Bob 4, Carol 5, Dave 6, Erin 7, Frank 8, Grace 9", "Why?", "2 + 2", "Name Ann Lee Roe"]
    values = ["Is 19 prime?", "Add 4 and 6", "Solve x = 5", "Alice 4, Bob 5, Carol 6, Dave 7, Erin 8, Frank 9, Grace 1", "Who?", "2 + 3", "Name Ann Lee Poe"]
    quote = FILLER + "Bob 4, Carol 5, Dave 6, Erin 7, Frank 8, Grace 9"
    cut = FILLER + "Frank 8, Grace 9 Frank 8"
    got = flags(spark, [FILLER + f"Then he told Jo: {t} " * 2 for t in items] + [FILLER + t for t in values] + [quote, cut], list(enumerate(items)))
    assert all(got[i] == ([i], True) for i in range(7))
    assert all(got[i] == ([], False) for i in range(7, 14))
    assert got[14] == ([3], True) and got[15] == ([], False)


def test_items_of_one_template_are_one_class(spark):
    ask = "A train leaves {0} at {1} and travels {2} km in {1} hours before it meets {0} again on the bridge."
    towns = ["Paris", "Rome", "Bern", "Oslo", "Prague"]
    text = lambda i, n=0: ask.format(towns[i % 5], i + 1, n + 500 + i)
    bench = spark.createDataFrame([(i, text(i)) for i in range(200)] + [(900, ask.replace("{1} hours", "{3} hours").format("Paris", 1, 500, 7))], "item_id long, text string")
    docs = spark.createDataFrame([(i, FILLER + text(i, 1000 * (i % 2))) for i in range(200)], "doc_id long, text string")
    found = template_matches(docs, bench).where("item_id < 900").collect()
    assert sorted((r.doc_id, r.item_id, r.coverage, r.exact) for r in found) == [(i, 0, 1.0, i % 2 == 0) for i in range(200)]
    assert {tuple(r) for r in item_classes(bench).collect()} == {(i, 0) for i in range(200)} | {(900, 900)}


def test_classes_of_odd_items(spark):
    items = [(1, "Is 17 prime?"), (2, "Is 19 prime?"), (3, "2 + 2"), (4, "2 + 3"), (5, None), (6, "  "), (None, "x"), (7, "The Ann. Bo"), (8, "The Ann Bo"), (1, "Is 17 prime?")]
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, class long")
    assert {tuple(r) for r in item_classes(bench).collect()} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 5), (7, 7), (8, 8)}
    docs = spark.createDataFrame([(0, FILLER + "So: Is 19 prime?"), (1, "Is 18 prime?")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id, r.exact) for r in template_matches(docs, bench).collect()] == [(0, 1, True)]


def test_empty_tables_null_and_repeated_ids(spark):
    assert flags(spark, []) == {}
    assert flags(spark, ["plain text of no use here"], []) == {0: ([], False)}
    docs = spark.createDataFrame([(None, ITEMS[1][1]), (7, ITEMS[1][1]), (7, ITEMS[1][1]), (7, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS + ITEMS[:2] + [(None, "clean")], "item_id long, text string")
    got = sorted((str(r.doc_id), r.contaminated) for r in flag_contaminated(docs, bench).collect())
    assert got == [("7", False), ("7", True), ("7", True), ("None", False)]


def test_symbols():
    symbols = symbols_of(pa.array(["The cat of Élodie Martin, Bob! Eats 3,5 kg. (kg)", None, "É"]))
    assert symbols.first.tolist() == [0, 8, 8, 9]
    assert symbols.literal.tolist() == [True, True, True, False, True, False, False, True, True]
