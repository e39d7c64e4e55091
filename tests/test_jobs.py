"""The whole chain on landed documents: silver, gold, training, serving."""

import json
import math
from dataclasses import replace

import pytest

from tasteforge.__main__ import main
from tasteforge.plans.gold import interaction_matrix, run_gold, score_interactions
from tasteforge.plans.serve import recommend_topk, run_recommend, unserved_users, users_frame
from tasteforge.plans.silver import run_silver
from tasteforge.plans.train import run_training
from tasteforge.sources import bundle as bundles
from tasteforge.sources.bundle import list_bundles, load_bundle, save_bundle
from tasteforge.sources.tables import read_table, table_path


def land(base, dataset, day, name, document):
    folder = base / "raw" / dataset / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(document, indent=4), encoding="utf-8")


def vote(user, up, text="a review of some length", **more):
    return {
        "review_id": f"r{user}", "steam_id": user, "playtime_minutes": 1, "voted_up": up, "votes_up": 0,
        "weighted_score": 0.5, "steam_purchase": True, "review_text": text, **more,
    }


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("base")
    for u in range(12):
        games = [{"appid": 100 + a, "playtime_forever": 10 * (1 + (u * a) % 5)} for a in range(8) if (u + a) % 4]
        land(root, "user_profiles", "2026-06-09", f"user_{u}", {
            "ingested_at": f"2026-06-09T00:00:{u:02d}", "steam_id": f"u{u}", "game_count": len(games), "games": games,
        })
    land(root, "user_profiles", "2026-06-08", "user_0", {
        "ingested_at": "2026-06-08T00:00:00", "steam_id": "u0", "game_count": 1, "games": [{"appid": 999, "playtime_forever": 9}],
    })
    land(root, "user_profiles", "2026-06-09", "user_idle", {
        "ingested_at": "2026-06-09T00:00:00", "steam_id": "idle", "game_count": 1, "games": [{"appid": 100, "playtime_forever": 0}],
    })
    for a in range(7):  # app 107 has no metadata
        land(root, "app_metadata", "2026-06-09", f"meta_{100 + a}", {
            "ingested_at": "2026-06-09T00:00:00", "app_id": str(100 + a),
            "metadata": {"name": f"game {a}", "is_free": False, "price_overview": {}, "required_age": a or "17",
                         "release_date": {"coming_soon": False, "date": ""}, "metacritic": {}, "categories": [],
                         "genres": [{"id": "1", "description": "Action"}]},
        })
    land(root, "app_reviews", "2026-06-09", "reviews_101", {
        "ingested_at": "2026-06-09T00:00:00", "app_id": "101", "review_count": 4,
        "reviews": [vote("u0", True, "good\r\n\r\ngame, really"), vote("u1", False), vote("u2", True, "mm"), vote("x", True)],
    })
    land(root, "app_reviews", "2026-06-08", "reviews_101", {
        "ingested_at": "2026-06-08T00:00:00", "app_id": "101", "review_count": 1, "reviews": [vote("u4", False)],
    })
    return str(root)


@pytest.fixture(scope="module")
def bundle(spark, base):
    assert None not in run_silver(spark, base).values()
    run_gold(spark, base)
    return run_training(spark, base, run_id="first")


def test_silver_tables(spark, base, bundle):
    played = read_table(spark, table_path(base, "user_interactions"))
    assert dict(played.dtypes) == {"steam_id": "string", "app_id": "string", "playtime_minutes": "bigint"}
    assert played.where("app_id = '999' OR steam_id = 'idle'").isEmpty()
    assert played.count() == sum(1 for u in range(12) for a in range(8) if (u + a) % 4)

    reviews = {r.steam_id: r for r in read_table(spark, table_path(base, "app_reviews")).collect()}
    assert reviews.keys() == {"u0", "u1", "x"}  # the short one falls, the older document is replaced
    assert reviews["u0"].review_text == "good game, really"

    metadata = read_table(spark, table_path(base, "app_metadata")).where("app_id = '100'").first()
    assert metadata.asDict() == {
        "app_id": "100", "game_name": "game 0", "is_free": False, "price_formatted": None, "release_date": "",
        "metacritic_score": None, "genres": ["Action"], "categories": [],
    }


def test_gold_matrix(spark, base, bundle):
    matrix = read_table(spark, table_path(base, "ml_interaction_matrix"))
    assert matrix.dtypes == [("user_index", "int"), ("item_index", "int"), ("interaction_score", "float")]
    named = bundle.items.decode(bundle.users.decode(matrix, "user_index", "user"), "item_index", "item")
    scores = {(r.user, r.item): r.interaction_score for r in named.collect()}
    assert len(scores) == read_table(spark, table_path(base, "user_interactions")).count()
    for user, factor in (("u0", 1.5), ("u1", 0.5), ("u4", 1.0), ("u2", 1.0)):
        minutes = 10 * (1 + int(user[1:]) % 5)
        assert scores[user, "101"] == pytest.approx(factor * math.log1p(minutes), rel=1e-6)


def test_duplicate_reviews_fan_out_unless_one_is_kept(spark, base, bundle):
    played = spark.createDataFrame([("u", "1", 5)], "steam_id STRING, app_id STRING, playtime_minutes BIGINT")
    twice = spark.createDataFrame([("u", "1", True), ("u", "1", False)], "steam_id STRING, app_id STRING, voted_up BOOLEAN")
    assert score_interactions(played, twice).count() == 2
    assert run_gold(spark, base, one_review=True).matrix.count() == read_table(spark, table_path(base, "user_interactions")).count()


@pytest.mark.parametrize("broadcast_rows", [100_000, 3])
def test_matrix_is_the_same_by_either_lookup(spark, base, bundle, broadcast_rows):
    scored = score_interactions(
        read_table(spark, table_path(base, "user_interactions")), read_table(spark, table_path(base, "app_reviews"))
    )
    tables = interaction_matrix(scored, broadcast_rows=broadcast_rows)
    stored = read_table(spark, table_path(base, "ml_interaction_matrix"))
    assert tables.matrix.exceptAll(stored).isEmpty() and stored.exceptAll(tables.matrix).isEmpty()


def test_bundle_round_trip_and_mixed_parts(spark, base, bundle):
    loaded = load_bundle(spark, base, "first")
    assert loaded.item_factors.exceptAll(bundle.item_factors).isEmpty()
    assert (loaded.users.size, loaded.items.size, loaded.rmse) == (bundle.users.size, bundle.items.size, bundle.rmse)
    with pytest.raises(ValueError, match="no complete model bundle"):
        load_bundle(spark, base, "absent")

    run_training(spark, base, run_id="second")
    assert [r.run_id for r in list_bundles(spark, base).collect()] == ["second", "first"]
    assert load_bundle(spark, base).run_id == "second"
    folder = list_bundles(spark, base).first().folder
    bundle.users.frame.limit(2).write.mode("overwrite").parquet(f"{base}/models/parts/{folder}/users")
    with pytest.raises(ValueError, match="different runs"):
        load_bundle(spark, base, "second")


def test_a_crash_between_parts_leaves_the_published_bundle(spark, base, bundle, tmp_path, monkeypatch):
    store = str(tmp_path)
    with pytest.raises(ValueError, match="no complete model bundle"):
        load_bundle(spark, store)
    save_bundle(bundle, store)
    served = load_bundle(spark, store).item_factors.collect()
    for part in ("save_dictionary", "utc_stamp"):  # while parts are written, and right before the commit
        with monkeypatch.context() as patch:
            patch.setattr(bundles, part, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                save_bundle(replace(bundle, rmse=-1.0), store)
        assert load_bundle(spark, store, "first").rmse == bundle.rmse
        assert load_bundle(spark, store).item_factors.collect() == served
    save_bundle(replace(bundle, rmse=-1.0), store)
    assert load_bundle(spark, store).rmse == -1.0 and list_bundles(spark, store).count() == 1


def test_a_bundle_of_given_factors_round_trips(spark, base, bundle, tmp_path):
    given = replace(bundle, als=None, run_id="given")
    save_bundle(given, str(tmp_path))
    loaded = load_bundle(spark, str(tmp_path), "given")
    metadata = read_table(spark, table_path(base, "app_metadata"))
    asked = users_frame(spark, ["u3", "u5"])
    lists = [sorted(map(tuple, recommend_topk(b, asked, metadata, k=4, ordered=False).drop("genres").collect())) for b in (bundle, loaded)]
    assert lists[0] and lists[0] == lists[1] and loaded.als is None


def test_training_refuses_a_matrix_of_another_run(spark, base, bundle, tmp_path):
    copy = str(tmp_path)
    for table in ("ml_interaction_matrix", "item_dictionary"):
        read_table(spark, table_path(base, table)).write.parquet(table_path(copy, table))
    read_table(spark, table_path(base, "user_dictionary")).limit(3).write.parquet(table_path(copy, "user_dictionary"))
    with pytest.raises(ValueError, match="run gold again"):
        run_training(spark, copy)


def test_recommendations(spark, base, bundle):
    lists, unserved = run_recommend(spark, base, ["u3", "idle", "u5", "u3"], k=3, run_id="first")
    rows = lists.collect()
    assert lists.columns == ["steam_id", "app_id", "game_name", "genres", "predicted_affinity_score", "rank"]
    assert {(r.steam_id, r["rank"]) for r in rows} == {(u, k) for u in ("u3", "u5") for k in (1, 2, 3)}
    scores = [r.predicted_affinity_score for r in rows]
    assert scores == sorted(scores, reverse=True) and min(scores) >= 0
    assert all((r.game_name is None) == (r.app_id == "107") for r in rows)
    assert [tuple(r) for r in unserved.collect()] == [("idle", "unknown")]


def test_every_item_is_ranked_when_k_is_large(spark, base, bundle):
    metadata = read_table(spark, table_path(base, "app_metadata"))
    rows = recommend_topk(bundle, users_frame(spark, ["u3"]), metadata, k=50, ordered=False).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, bundle.item_factors.count() + 1))
    assert {r.app_id for r in rows if r.game_name is None} <= {"107"}


def test_users_without_factors_are_reported(spark, base, bundle):
    trained = bundle.user_factors
    known = bundle.users.frame.join(trained, bundle.users.frame["index"] == trained["id"], "left_anti")
    asked = users_frame(spark, ["nobody"]).unionByName(bundle.users.frame.selectExpr("label AS steam_id"))
    got = {tuple(r) for r in unserved_users(bundle, asked).collect()}
    assert got == {("nobody", "unknown")} | {(r.label, "no factors") for r in known.collect()}


def test_missing_dataset_does_not_stop_the_others(spark, tmp_path):
    land(tmp_path, "app_metadata", "2026-06-09", "meta_1", {"ingested_at": "x", "app_id": "1", "metadata": {"name": "n"}})
    written = run_silver(spark, str(tmp_path))
    assert written["user_interactions"] is None and written["app_reviews"] is None
    assert read_table(spark, written["app_metadata"].path).count() == 1


def test_packed_documents_give_the_same_silver_tables(spark, base, bundle, tmp_path):
    """Dated files to the hive layout, then a rewritten day: fewer documents, the same tables."""
    packed = str(tmp_path / "packed")
    main(["compact", "--base-path", base, "--out", packed])
    before, after = run_silver(spark, base), run_silver(spark, packed, "hive")
    for table in ("user_interactions", "app_metadata", "app_reviews"):
        old, new = (read_table(spark, w[table].path) for w in (before, after))
        assert old.count() and old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty()
    folder = tmp_path / "packed/raw/user_profiles"
    assert sorted(p.name for p in folder.glob("ingest_date=*")) == ["ingest_date=2026-06-08", "ingest_date=2026-06-09"]
    assert len(list(folder.glob("*/part-*"))) <= 4
    # A rerun of the day appends; rewriting keeps one document per key and does not touch the other day.
    day, rest = folder / "ingest_date=2026-06-09", {p.name for p in (folder / "ingest_date=2026-06-08").iterdir()}
    lines = [line for p in day.glob("part-*") for line in p.read_text().splitlines()]
    newer = [json.dumps({**json.loads(line), "ingested_at": "2026-06-09T01:00:00", "more": "kept"}) for line in lines]
    (day / "again.json").write_text("\n".join([*newer, "{ not json"]))
    main(["compact", "--base-path", packed, "--layout", "hive", "--day", "2026-06-09"])
    now = [line for p in day.glob("part-*") for line in p.read_text().splitlines()]
    assert sorted(now) == sorted([*newer, "{ not json"]) and not (day / "again.json").exists()
    assert {p.name for p in (folder / "ingest_date=2026-06-08").iterdir()} == rest
    again = read_table(spark, run_silver(spark, packed, "hive")["user_interactions"].path)
    assert again.exceptAll(read_table(spark, before["user_interactions"].path)).isEmpty() and again.count()
    with pytest.raises(SystemExit):
        main(["compact", "--base-path", base])


def test_command_line(spark, base, bundle, capsys):
    main(["silver", "--base-path", base])
    main(["recommend", "--base-path", base, "--user", "u3", "--user", "nobody", "--top", "2", "--run-id", "first"])
    out = capsys.readouterr().out
    assert "user_interactions: " in out and "nobody" in out and "unknown" in out


def test_payloads_to_stored_lists(spark, tmp_path, capsys):
    """bronze, worklist, silver, gold, train, recommend by command line, from payload tables to lists on disk."""
    base = str(tmp_path / "b")

    def payloads(table, rows):
        df = spark.createDataFrame([(i, json.dumps(p)) for i, p in rows], "id STRING, payload STRING")
        df.write.parquet(f"{base}/payloads/{table}")

    payloads("library_payloads", [
        (f"u{u}", {"response": {"games": [{"appid": str(100 + a) if u % 2 else 100 + a, "playtime_forever": 5 + (u * a) % 7} for a in range(8) if (u + a) % 3]}})
        for u in range(10)
    ])
    payloads("metadata_payloads", [(str(100 + a), {str(100 + a): {"success": True, "data": {"name": f"game {a}"}}}) for a in range(8)])
    payloads("review_payloads", [("101", {"success": 1, "reviews": [
        {"recommendationid": "1", "author": {"steamid": "u1"}, "language": "english", "voted_up": True, "review": "long enough text"}]})])
    for name in ("popular", "tagged"):
        payloads(f"catalogue_{name}", [("", {"a": {"appid": 1, "ccu": 5}, "b": {"appid": 2}})])
    main(["bronze", "--base-path", base])
    day = sorted(p.name for p in (tmp_path / "b/raw/user_profiles").glob("ingest_date=*"))[-1].removeprefix("ingest_date=")
    main(["worklist", "--base-path", base, "--layout", "hive", "--day", day])
    lists = {n: {r[0] for r in read_table(spark, table_path(base, f"worklist_{n}")).collect()} for n in ("seeds", "reviewers", "harvest", "quota")}
    assert lists["seeds"] == {"1", "2"} and lists["reviewers"] == {"u1"} and lists["quota"] == {f"u{u}" for u in range(10)}
    assert lists["harvest"] == {"100", "101", "102", "103", "104"}
    for job in ("silver", "gold", "train"):
        main([job, "--base-path", base, "--layout", "hive", *(["--run-id", "r"] if job == "train" else [])])
    spark.createDataFrame([("u1",), ("u2",), ("stranger",)], "steam_id STRING").write.parquet(f"{base}/asked")
    main(["recommend", "--base-path", base, "--users", f"{base}/asked", "--out", f"{base}/out", "--top", "2"])
    assert {(r.steam_id, r["rank"]) for r in spark.read.parquet(f"{base}/out/lists").collect()} == {(u, k) for u in ("u1", "u2") for k in (1, 2)}
    assert [tuple(r) for r in spark.read.parquet(f"{base}/out/unserved").collect()] == [("stranger", "unknown")]
    with pytest.raises(SystemExit):
        main(["recommend", "--base-path", base, "--users", "x"])
