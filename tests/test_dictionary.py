import random

import pytest
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import functions as F

from tasteforge.operators import dictionary as dictionaries
from tasteforge.operators.dictionary import fit_dictionary, load_dictionary, save_dictionary
from tasteforge.plans.gold import interaction_matrix


@pytest.fixture(scope="module")
def skewed(spark):
    """5000 rows over 400 ids, one of which holds a third of them."""
    rng = random.Random(7)
    ids = [(1 if rng.random() < 0.34 else rng.randrange(400), i) for i in range(5000)] + [(None, -1)]
    return spark.createDataFrame(ids, "user BIGINT, row BIGINT").repartition(6)


def test_frequency_order_with_ties_in_text_order(spark):
    df = spark.createDataFrame([(i,) for i in (2, 10, 7, 7, None)], "id BIGINT")
    rows = fit_dictionary(df, "id").frame.orderBy("index").collect()
    assert [tuple(r) for r in rows] == [("7", 2, 0), ("10", 1, 1), ("2", 1, 2)]


def test_same_numbers_as_the_indexer(spark, skewed):
    dictionary = fit_dictionary(skewed, "user")
    text = skewed.withColumn("user", F.col("user").cast("string"))
    model = StringIndexer(inputCol="user", outputCol="i", handleInvalid="skip").fit(text)
    ours = {r["label"]: r["index"] for r in dictionary.frame.collect()}
    assert ours == {label: i for i, label in enumerate(model.labels)}
    assert dictionary.size == len(model.labels)
    assert sorted(ours.values()) == list(range(dictionary.size))


@pytest.mark.parametrize("broadcast_rows", [100_000, 10])
def test_encode_and_decode_are_inverse_and_drop_nothing_known(spark, skewed, broadcast_rows):
    dictionary = fit_dictionary(skewed, "user")
    encoded = dictionary.encode(skewed, "user", "i", broadcast_rows)
    assert encoded.columns == ["user", "row", "i"]
    back = dictionary.decode(encoded, "i", "label", broadcast_rows)
    rows = back.collect()
    assert len(rows) == 5000 and len({r["row"] for r in rows}) == 5000
    assert all(str(r["user"]) == r["label"] for r in rows)

    text = skewed.withColumn("user", F.col("user").cast("string"))
    model = StringIndexer(inputCol="user", outputCol="i", handleInvalid="skip").fit(text)
    decoder = IndexToString(inputCol="i", outputCol="label", labels=model.labels)
    expected = decoder.transform(model.transform(text)).select("row", F.col("i").cast("long"), "label")
    assert {tuple(r) for r in back.select("row", "i", "label").collect()} == {tuple(r) for r in expected.collect()}


@pytest.mark.parametrize("broadcast_rows", [100_000, 1])
def test_unseen_and_null_ids_are_skipped(spark, broadcast_rows):
    dictionary = fit_dictionary(spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id STRING"), "id")
    asked = spark.createDataFrame([("a",), ("z",), (None,), ("b",)], "id STRING")
    assert {tuple(r) for r in dictionary.encode(asked, "id", "i", broadcast_rows).collect()} == {("a", 0), ("b", 1)}


def test_empty_input_gives_an_empty_dictionary(spark):
    nothing = spark.createDataFrame([(None,)], "id STRING")
    dictionary = fit_dictionary(nothing, "id")
    assert (dictionary.size, dictionary.label_bytes, dictionary.frame.count()) == (0, 0, 0)
    assert dictionary.encode(nothing, "id", "i").isEmpty()


def test_broadcast_is_bounded_in_bytes_too(spark, plan):
    wide = spark.range(50).selectExpr("repeat(string(id), 1 << 20) AS id")
    dictionary = fit_dictionary(wide, "id")
    assert dictionary.label_bytes > 50 << 20 and not dictionary.fits()
    assert "LeftAnti" in plan(dictionary.encode(wide, "id", "i"))  # 50 rows, but too many bytes
    assert dictionary.encode(wide, "id", "i").select("i").distinct().count() == 50


def test_heavy_ids_stay_out_of_the_shuffle(spark, skewed, plan):
    text = plan(fit_dictionary(skewed, "user").encode(skewed, "user", "i", broadcast_rows=10))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text and "CartesianProduct" not in text


def test_save_and_load(spark, skewed, tmp_path):
    dictionary = fit_dictionary(skewed, "user")
    save_dictionary(dictionary, str(tmp_path / "d"))
    loaded = load_dictionary(spark, str(tmp_path / "d"))
    assert (loaded.size, loaded.label_bytes) == (dictionary.size, dictionary.label_bytes)
    assert loaded.frame.exceptAll(dictionary.frame).isEmpty()


def test_one_very_long_label_does_not_move_the_switch(spark, plan):
    labels = spark.range(500).selectExpr("if(id = 0, repeat('x', 1 << 20), string(id)) AS id")
    dictionary = fit_dictionary(labels, "id")
    assert dictionary.fits() and "LeftAnti" not in plan(dictionary.encode(labels, "id", "i"))
    # In the large case it travels with the tail, whatever its rank, and nothing is lost.
    assert dictionary.encode(labels, "id", "i", broadcast_rows=400).select("i").distinct().count() == 500


def test_the_large_lookup_reads_a_stored_input(spark, skewed, plan):
    dictionary = fit_dictionary(skewed, "user")
    heavy = skewed.groupBy("user").agg(F.count("*").alias("n"))
    text = plan(dictionary.encode(heavy, "user", "i", broadcast_rows=1))
    assert "HashAggregate" not in text


def test_the_matrix_stores_one_narrow_lookup(spark, monkeypatch):
    """The scored table is stored already, and the second lookup needs neither the item's label nor the key twice."""
    stored, keep = [], dictionaries.materialize
    monkeypatch.setattr(dictionaries, "materialize", lambda df, name: (stored.append((name, df.dtypes)), keep(df, name))[1])
    rows = [(f"u{i % 7}" if i % 11 else None, f"i{i % 5}" if i % 13 else None, i / 3) for i in range(200)]
    scored = spark.createDataFrame(rows, "steam_id STRING, app_id STRING, interaction_score DOUBLE")
    large = interaction_matrix(scored, broadcast_rows=2).matrix.collect()
    lookups = [columns for name, columns in stored if name == "lookup"]
    assert lookups == [[("steam_id", "string"), ("item_index", "int"), ("interaction_score", "float")]]
    assert sorted(large) == sorted(interaction_matrix(scored).matrix.collect())
