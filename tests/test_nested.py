from pyspark.sql import functions as F

from tasteforge.operators.nested import explode_items, map_rows, compute_once, pick_fields

LIBRARY = "user STRING, games ARRAY<STRUCT<appid: BIGINT, minutes: BIGINT>>"


def libraries(spark):
    return spark.createDataFrame(
        [("null", None), ("empty", []), ("some", [(1, 0), (2, None), (3, 1)])], LIBRARY
    )


def test_explode_drops_missing_arrays_and_filters_elements(spark):
    fields = {"app": "appid", "minutes": "minutes"}
    every = explode_items(libraries(spark), "games", fields, carry=("user",)).collect()
    assert sorted((r.user, r.app) for r in every) == [("some", 1), ("some", 2), ("some", 3)]
    played = explode_items(libraries(spark), "games", fields, keep=lambda g: g["minutes"] > 0, carry=("user",))
    assert [tuple(r) for r in played.collect()] == [("some", 3, 1)]


def test_explode_outer_keeps_the_row(spark):
    rows = explode_items(libraries(spark), "games", {"app": "appid"}, carry=("user",), outer=True).collect()
    assert {r.user for r in rows if r.app is None} == {"null", "empty"}


def test_explode_plain_elements(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id INT, words ARRAY<STRING>")
    assert [tuple(r) for r in explode_items(df, "words", "word", carry=("id",)).collect()] == [(1, "a"), (1, "b")]


def test_pick_fields_through_structs_and_arrays(spark):
    schema = "m STRUCT<price: STRUCT<final: STRING>, genres: ARRAY<STRUCT<description: STRING>>>"
    df = spark.createDataFrame(
        [((("1 $",), [("Action",), (None,)]),), ((None, []),), (None,)], schema
    )
    got = pick_fields(df, {"price": "m.price.final", "genres": "m.genres.description"}).collect()
    assert [tuple(r) for r in got] == [("1 $", ["Action", None]), (None, []), (None, None)]


def test_map_values_to_rows(spark):
    df = spark.createDataFrame([({"x": (1,), "y": (2,)},), ({},)], "m MAP<STRING, STRUCT<v: INT>>")
    assert sorted(r.v for r in map_rows(df, "m", {"v": "v"}).collect()) == [1, 2]


def test_compute_once_replaces_in_place(spark, plan):
    df = spark.createDataFrame([(1, "a\nb", 2), (2, "\n", 3), (3, None, 4)], "id INT, t STRING, n INT")
    cleaned = compute_once(df, F.regexp_replace("t", "\n", ""), "t", lambda t: F.length(t) > 0)
    assert cleaned.columns == ["id", "t", "n"]
    assert [tuple(r) for r in cleaned.collect()] == [(1, "ab", 2)]
    assert plan(cleaned).count("regexp_replace") == 1

    long_enough_by_default = compute_once(df, F.upper("t"), "t", lambda t, n=3: F.length(t) >= n)
    assert [r.t for r in long_enough_by_default.collect()] == ["A\nB"]


def test_compute_once_parses_once(spark, plan):
    df = spark.createDataFrame([('{"n": 1}',), ('{"n": 0}',), ("junk",), (None,)], "payload STRING")
    parsed = compute_once(df, F.from_json("payload", "n INT"), "p", lambda p: p["n"] > 0)
    assert [r.p.n for r in parsed.collect()] == [1]
    assert plan(parsed.select(F.col("p.n") + 1)).count("from_json") == 1
