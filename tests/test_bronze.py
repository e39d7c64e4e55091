import json

import pytest
from pyspark.sql import functions as F

from tasteforge import schemas
from tasteforge.plans import bronze, worklists


def payloads(spark, rows, id_col):
    text = [(k, p if p is None or isinstance(p, str) else json.dumps(p)) for k, p in rows]
    return spark.createDataFrame(text, f"{id_col} STRING, payload STRING")


def test_libraries(spark):
    raw = payloads(
        spark,
        [
            ("1", {"response": {"games": [{"appid": 400, "playtime_forever": 7, "extra": 1}, {"appid": 10}]}}),
            ("2", {"response": {}}),
            ("3", {"response": {"games": []}}),
            ("4", "<html>"),
            ("5", None),
        ],
        "steam_id",
    )
    shaped = bronze.shape_libraries(raw, ingested_at=F.lit("2026-06-08T00:00:00"))
    assert shaped.columns == ["ingested_at", "steam_id", "game_count", "games"]
    (row,) = shaped.collect()
    assert (row.steam_id, row.game_count) == ("1", 2)
    assert [tuple(g) for g in row.games] == [(400, 7), (10, 0)]


def test_friends(spark):
    raw = payloads(
        spark, [("1", {"friendslist": {"friends": [{"steamid": "a"}, {"steamid": 7}]}}), ("2", {}), ("3", "x")], "steam_id"
    )
    assert {r.steam_id: r.friends for r in bronze.shape_friends(raw).collect()} == {"1": ["a", "7"], "2": [], "3": []}


def test_metadata(spark):
    data = {
        "type": "game",
        "name": "n",
        "required_age": 0,
        "is_free": False,
        "price_overview": {"final": 999, "final_formatted": "9,99"},
        "categories": [{"id": 2, "description": "c"}],
        "genres": [{"id": "1", "description": "g"}],
        "unknown": {"x": 1},
    }
    raw = payloads(
        spark,
        [
            ("400", {"400": {"success": True, "data": data}, "7": {"success": True, "data": {"name": "other"}}}),
            ("401", {"401": {"success": False}}),
            ("402", {"7": {"success": True, "data": data}}),
            ("403", {"403": {"success": True, "data": {"required_age": "17"}}}),
        ],
        "app_id",
    )
    shaped = {r.app_id: r.metadata for r in bronze.shape_metadata(raw, ingested_at=F.lit("2026-06-08T00:00:00")).collect()}
    assert shaped.keys() == {"400", "403"}
    full, bare = shaped["400"], shaped["403"]
    assert len(full) == 16 and list(full.asDict()) == list(schemas.METADATA_FIELDS)
    assert (full.name, full.required_age, full.price_overview.final, full.genres[0].id) == ("n", "0", 999, "1")
    assert (bare.required_age, bare.developers, bare.genres, bare.price_overview.final) == ("17", [], [], None)
    assert bare.name is None


def review(**fields):
    return {"recommendationid": "r", "author": {"steamid": "u"}, "language": "english", "review": "t", **fields}


def test_reviews(spark):
    raw = payloads(
        spark,
        [
            (
                "1",
                {
                    "success": 1,
                    "reviews": [
                        review(weighted_vote_score="0.52", author={"steamid": "u", "playtime_at_review": 9}),
                        review(weighted_vote_score=0.5, voted_up=True),
                        review(weighted_vote_score="x"),
                        review(),
                        review(language="german"),
                    ],
                },
            ),
            ("2", {"success": 1, "reviews": [review(language="german")]}),
            ("3", {"success": 1, "reviews": []}),
            ("4", {"success": 0, "reviews": [review()]}),
            ("5", {"reviews": [review()]}),
            ("6", {"success": True, "reviews": [review(review="line\r\nbreak \U0001f600")]}),
        ],
        "app_id",
    )
    shaped = {r.app_id: r for r in bronze.shape_reviews(raw, ingested_at=F.lit("2026-06-08T00:00:00")).collect()}
    assert shaped.keys() == {"1", "2", "6"}
    assert shaped["1"].review_count == 4
    assert [r.weighted_score for r in shaped["1"].reviews] == [0.52, 0.5, 0.0, 0.0]
    assert [r.playtime_minutes for r in shaped["1"].reviews] == [9, 0, 0, 0]
    assert (shaped["2"].review_count, shaped["2"].reviews) == (0, [])
    assert shaped["6"].reviews[0].review_text == "line\r\nbreak \U0001f600"


def test_catalogue(spark):
    raw = payloads(spark, [("x", {"a": {"appid": 1, "ccu": 5}, "b": {"appid": 2}}), ("y", {})], "k")
    assert sorted(map(tuple, bronze.shape_catalogue(raw).collect())) == [(1, 5), (2, None)]


@pytest.mark.parametrize(
    ("job", "id_col"),
    [(bronze.shape_libraries, "steam_id"), (bronze.shape_metadata, "app_id"), (bronze.shape_reviews, "app_id")],
)
def test_payloads_are_parsed_once(spark, plan, job, id_col):
    assert plan(job(payloads(spark, [("1", "{}")], id_col))).count("from_json(StructField") <= 1


def test_worklists(spark):
    catalogue = spark.createDataFrame([(1, 9), (2, None), (10, 9), (3, 1), (None, 99)], "appid BIGINT, ccu BIGINT")
    tagged = catalogue.where("appid in (2, 3)")
    lists = worklists.seed_worklist(catalogue, tagged, n=2, n_tagged=1)
    assert [r.app_id for r in lists.popular.collect()] == ["1", "10"]
    assert [r.app_id for r in lists.tagged.collect()] == ["3"]
    assert sorted(r.app_id for r in lists.combined.collect()) == ["1", "10", "3"]
    assert lists.sizes().first().asDict() == {"popular": 2, "tagged": 1, "combined": 3}

    profiles = spark.createDataFrame(
        [("b", [(400,), (10,), (None,)]), ("a", [(10,)]), ("c", []), ("", [(1,)]), (None, [(2,)]), ("d", None)],
        "steam_id STRING, games ARRAY<STRUCT<appid: BIGINT>>",
    )
    assert sorted(r.app_id for r in worklists.items_in_libraries(profiles).collect()) == ["1", "10", "2", "400"]
    assert [r.app_id for r in worklists.harvest(profiles, 2).collect()] == ["1", "10"]
    assert [r.steam_id for r in worklists.quota(profiles, 5).collect()] == ["a", "b"]
    assert [r.steam_id for r in worklists.quota(profiles, 1).collect()] == ["a"]

    reviews = spark.createDataFrame([([("u",), ("",), (None,), ("u",)],), (None,)], "reviews ARRAY<STRUCT<steam_id: STRING>>")
    assert [r.steam_id for r in worklists.users_in_reviews(reviews).collect()] == ["u"]
