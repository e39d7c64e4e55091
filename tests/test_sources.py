import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tasteforge import schemas
from tasteforge.operators.latest import latest_per_key
from tasteforge.plans.silver import run_silver
from tasteforge.sources.documents import (
    OUTCOME,
    compact_documents,
    corrupt_report,
    document_counts,
    on_day,
    readable,
    rejected,
    rescue,
    rewrite_documents,
    scan_documents,
    scan_or_empty,
    store_outcomes,
    write_documents,
)
from tasteforge.sources.tables import read_table, write_table


def land(base, dataset, day, name, document):
    folder = base / "raw" / dataset / day
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=4)
    (folder / name).write_text(text, encoding="utf-8")


def profile(user, at, *games):
    return {
        "ingested_at": at,
        "steam_id": user,
        "game_count": len(games),
        "games": [{"appid": a, "playtime_forever": p} for a, p in games],
    }


@pytest.fixture
def landed(tmp_path):
    land(tmp_path, "user_profiles", "2026-06-08", "user_1.json", profile("1", "2026-06-08T01:00:00", (400, 5)))
    land(tmp_path, "user_profiles", "2026-06-09", "user_1.json", profile("1", "2026-06-09T01:00:00", (400, 9)))
    land(tmp_path, "user_profiles", "2026-06-09", "user_2.json", "{ not json")
    land(tmp_path, "user_profiles", "2026-06-09", "notes.txt", "not a document")
    return str(tmp_path)


def test_pretty_printed_documents_over_all_days(spark, landed):
    docs = scan_documents(spark, landed, "user_profiles", schemas.USER_PROFILES)
    good = readable(docs).orderBy("ingested_at").collect()
    assert [(r.steam_id, r.games[0].playtime_forever, str(r.ingest_date)) for r in good] == [
        ("1", 5, "2026-06-08"),
        ("1", 9, "2026-06-09"),
    ]
    assert good[0].source_file.endswith("/2026-06-08/user_1.json")
    assert tuple(corrupt_report(docs).first()) == (3, 1, 0, 0)


def test_one_day_reads_one_folder(spark, landed):
    docs = scan_documents(spark, landed, "user_profiles", schemas.USER_PROFILES, day="2026-06-08")
    assert [r.games[0].playtime_forever for r in docs.collect()] == [5]
    assert scan_documents(spark, landed, "user_profiles", schemas.USER_PROFILES, day="2026-01-01") is None


def test_missing_dataset_is_none_and_other_errors_are_raised(spark, landed):
    assert scan_documents(spark, landed, "app_reviews", schemas.APP_REVIEWS) is None
    with pytest.raises(AnalysisException):
        scan_documents(spark, landed, "user_profiles", "a STRUCT<", day=None)


def test_written_documents_prune_by_day_and_reruns_replace(spark, tmp_path, plan):
    base = str(tmp_path)
    rows = [("2026-06-08T01:00:00", "1", 1, [(400, 5)]), ("2026-06-09T01:00:00", "2", 1, [(10, 1)])]
    write_documents(spark.createDataFrame(rows, schemas.USER_PROFILES), base, "user_profiles")
    again = [("2026-06-08T02:00:00", "1", 1, [(400, 6)])]
    write_documents(spark.createDataFrame(again, schemas.USER_PROFILES), base, "user_profiles")

    every = readable(scan_documents(spark, base, "user_profiles", schemas.USER_PROFILES, layout="hive"))
    latest = latest_per_key(every, ["steam_id"], "ingested_at", ["source_file"])
    assert {(r.steam_id, r.games[0].playtime_forever) for r in latest.collect()} == {("1", 6), ("2", 1)}

    day = scan_documents(spark, base, "user_profiles", schemas.USER_PROFILES, layout="hive", day="2026-06-09")
    assert [r.steam_id for r in day.collect()] == ["2"]
    assert "PartitionFilters: [isnotnull(ingest_date" in plan(day)


def test_on_day_pushes_a_range(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.sql(
        "SELECT TIMESTAMP_NTZ'2026-06-07 23:59:59.999999' ts UNION ALL SELECT TIMESTAMP_NTZ'2026-06-08 00:00:00' "
        "UNION ALL SELECT TIMESTAMP_NTZ'2026-06-08 23:59:59.999999' UNION ALL SELECT TIMESTAMP_NTZ'2026-06-09 00:00:00'"
    ).write.parquet(path)
    df = on_day(spark.read.parquet(path), "ts", "2026-06-08")
    assert df.count() == 2
    assert "GreaterThanOrEqual(ts,2026-06-08T00:00), LessThan(ts,2026-06-09T00:00)" in plan(df)


def test_table_overwrite_whole_or_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5).toDF("id"), path)
    write_table(spark.range(2).toDF("id"), path)
    assert read_table(spark, path, "id BIGINT").count() == 2

    parted = str(tmp_path / "p")
    write_table(spark.sql("SELECT 1 v, 'a' d UNION ALL SELECT 2, 'b'"), parted, ["d"])
    write_table(spark.sql("SELECT 3 v, 'b' d"), parted, ["d"])
    assert {(r.v, r.d) for r in spark.read.parquet(parted).collect()} == {(1, "a"), (3, "b")}


def test_stray_fields_do_not_drift_the_schema(spark, tmp_path):
    metadata = {"name": "n", "required_age": 0, "genres": [], "price_overview": {}}
    land(tmp_path, "app_metadata", "2026-06-08", "a.json", {"app_id": "1", "metadata": metadata})
    land(tmp_path, "app_metadata", "2026-06-08", "b.json", {"app_id": "2", "metadata": {"required_age": "17"}})
    docs = readable(scan_documents(spark, str(tmp_path), "app_metadata", schemas.APP_METADATA))
    got = docs.orderBy("app_id").select(
        "metadata.required_age", F.col("metadata.genres.description"), "metadata.price_overview.final_formatted"
    )
    assert [tuple(r) for r in got.collect()] == [("0", [], None), ("17", None, None)]


def test_one_value_of_another_kind_costs_that_value_only(spark, tmp_path):
    profiles = [
        {"ingested_at": "2026-06-08T00:00:00", "steam_id": "text-id", "games": [{"appid": "1", "playtime_forever": 3}, {"appid": 2, "playtime_forever": "4"}]},
        {"ingested_at": "2026-06-08T00:00:00", "steam_id": 7, "games": [{"appid": 3.0, "playtime_forever": 5.5}, {"appid": 4, "playtime_forever": "many"}]},
        {"ingested_at": "2026-06-08T00:00:00", "steam_id": "odd", "games": [{"appid": 5, "playtime_forever": 6}, "x", {"appid": None, "playtime_forever": 1}]},
        {"ingested_at": "2026-06-08T00:00:00", "steam_id": "none", "games": {"appid": 6}},
    ]
    for i, doc in enumerate(profiles):
        land(tmp_path, "user_profiles", "2026-06-08", f"{i}.json", doc)
    land(tmp_path, "user_profiles", "2026-06-08", "broken.json", "{ not json")
    land(tmp_path, "app_reviews", "2026-06-08", "r.json", {
        "ingested_at": "x", "app_id": 9, "reviews": [
            {"review_id": 1, "steam_id": 2, "playtime_minutes": "8", "voted_up": 1, "weighted_score": "0.5", "review_text": "long enough text"},
            {"review_id": "b", "steam_id": "c", "playtime_minutes": [], "voted_up": "perhaps", "weighted_score": {}, "review_text": "also long enough"},
        ],
    })
    land(tmp_path, "app_metadata", "2026-06-08", "m.json", {
        "ingested_at": "x", "app_id": "9", "metadata": {"name": "n", "is_free": "true", "metacritic": [], "genres": {}, "price_overview": []},
    })
    written = run_silver(spark, str(tmp_path))
    played = {tuple(r) for r in read_table(spark, written["user_interactions"].path).collect()}
    assert played == {("text-id", "1", 3), ("text-id", "2", 4), ("7", "3", 5), ("odd", "5", 6)}
    table = written["user_interactions"]
    assert (table.documents, table.corrupt, table.unstamped) == (5, 1, 0) and table.partial >= 1
    reasons = {r.reason for r in spark.read.json(table.rejects).collect()}
    assert reasons == {"not JSON", "value of another kind"}
    reviews = {tuple(r) for r in read_table(spark, written["app_reviews"].path).collect()}
    assert reviews == {("9", "1", "2", 8, True, 0.5, "long enough text"), ("9", "b", "c", None, None, 0.0, "also long enough")}
    (meta,) = read_table(spark, written["app_metadata"].path).collect()
    assert (meta.app_id, meta.game_name, meta.is_free, meta.metacritic_score) == ("9", "n", True, None)


def test_elements_of_another_kind_go_at_any_depth(spark, tmp_path):
    schema = "id STRING, a STRUCT<b: ARRAY<STRUCT<n: BIGINT, c: ARRAY<STRUCT<d: STRING>>>>, e: ARRAY<STRING>>, f ARRAY<ARRAY<BIGINT>>"
    documents = [
        {"id": "clean", "a": {"b": [{"n": 1, "c": [{"d": "x"}]}], "e": ["p"]}, "f": [[1, 2], []]},
        {"id": "odd", "a": {"b": ["Action", {"n": "2", "c": [3, {"d": "y"}, [4]]}, None, {"n": [], "c": {}}], "e": [1, "q", {"r": 1}]}, "f": [5, [6, "7", {}]]},
        {"id": "scalar", "a": 5, "f": "none"},
        {"id": "arrays", "a": {"b": {}, "e": []}, "f": [[]]},
    ]
    for i, document in enumerate(documents):
        land(tmp_path, "x", "2026-06-08", f"{i}.json", document)
    land(tmp_path, "x", "2026-06-08", "broken.json", "{ not json")
    got = {r.id: r for r in readable(rescue(scan_documents(spark, str(tmp_path), "x", schema), schema)).collect()}
    assert got.keys() == {"clean", "odd", "scalar", "arrays"}
    plain = lambda r: None if r is None else r.asDict(recursive=True)
    assert plain(got["clean"].a) == {"b": [{"n": 1, "c": [{"d": "x"}]}], "e": ["p"]} and got["clean"].f == [[1, 2], []]
    assert plain(got["odd"].a) == {"b": [{"n": 2, "c": [{"d": "y"}]}, {"n": None, "c": None}], "e": ["1", "q", '{"r":1}']}
    assert got["odd"].f == [[6, 7, None]]
    assert got["scalar"].a is None and got["scalar"].f is None
    assert plain(got["arrays"].a) == {"b": None, "e": []} and got["arrays"].f == [[]]


def test_genres_of_another_kind_cost_only_themselves(spark, tmp_path):
    land(tmp_path, "app_metadata", "2026-06-08", "m.json", {
        "ingested_at": "x", "app_id": "9", "metadata": {"name": "n", "genres": ["Action", {"id": 1, "description": "B"}], "categories": [{"description": "c"}, 4]},
    })
    written = run_silver(spark, str(tmp_path))["app_metadata"]
    (meta,) = read_table(spark, written.path).collect()
    assert (meta.game_name, meta.genres, meta.categories, written.partial) == ("n", ["B"], ["c"], 1)


def test_rejects_and_table_come_from_one_parse(spark, landed, plan):
    docs = scan_documents(spark, landed, "user_profiles", schemas.USER_PROFILES_READ)
    assert "json" in plan(docs).lower()
    stored, counts = store_outcomes(docs, *document_counts(docs))
    assert counts == {"documents": 3, "corrupt": 1, "partial": 0, "unstamped": 0}
    lost = rejected(stored.where(f"{OUTCOME} <> 'whole'").drop(OUTCOME))
    for frame in (lost, readable(stored.where(f"{OUTCOME} <> 'lost'").drop(OUTCOME))):
        assert "FileScan json" not in plan(frame) and "FileScan parquet" in plan(frame)
        assert "PartitionFilters: [isnotnull(outcome" in plan(frame)
    assert [(r.reason, r.text) for r in lost.collect()] == [("not JSON", "{ not json")]
    assert readable(stored.drop(OUTCOME)).count() == 2


def test_a_missing_dataset_has_typed_columns(spark, landed):
    there, absent = (scan_or_empty(spark, landed, d, schemas.USER_PROFILES) for d in ("user_profiles", "absent"))
    assert absent.dtypes == there.dtypes and absent.isEmpty() and not there.isEmpty()
    assert tuple(corrupt_report(absent).first()) == (0, 0, 0, 0)


def test_packing_and_rewriting_of_nothing(spark, tmp_path):
    assert not compact_documents(spark, str(tmp_path), "absent", "id", str(tmp_path / "out"))
    assert not rewrite_documents(spark, str(tmp_path), "absent", "id")


def test_packing_keeps_unknown_fields_and_broken_texts(spark, tmp_path):
    land(tmp_path, "x", "2026-06-08", "a.json", {"id": 7.0, "ingested_at": "1", "own": {"deep": ["line\nbreak", 1]}})
    land(tmp_path, "x", "2026-06-08", "b.json", {"id": "7", "ingested_at": "2", "own": "newer"})
    land(tmp_path, "x", "2026-06-08", "c.json", "{ not\njson")
    land(tmp_path, "x", "2026-06-09", "a.json", {"id": 7, "ingested_at": "0", "own": {"deep": ["line\nbreak", 1]}})
    out = str(tmp_path / "out")
    for _ in range(2):  # packing again replaces the days
        assert compact_documents(spark, str(tmp_path), "x", "id", out)
    lines = {(str(r.ingest_date), r.value) for r in spark.read.text(f"{out}/raw/x").collect()}
    (broken,) = [v for _, v in lines if "not" in v]
    assert ("2026-06-08", broken) in lines and broken == "{ not json"
    kept = {(d, json.dumps(json.loads(v)["own"])) for d, v in lines if v != broken}
    assert kept == {("2026-06-08", '"newer"'), ("2026-06-09", json.dumps({"deep": ["line\nbreak", 1]}))}
    assert len(lines) == 3


def test_documents_of_a_day_are_landed_by_several_tasks(spark, tmp_path, monkeypatch):
    from tasteforge import queries

    folders = []

    def path(_, name):
        folders.append(tmp_path / name)
        return str(tmp_path / name)

    monkeypatch.setattr(queries, "FILES_PER_TASK", 10, raising=False)
    monkeypatch.setattr(queries, "intermediate_path", path)
    rows = [(i if i else None, i % 7) for i in range(30)] + [(5, 1)]
    spark.createDataFrame(rows, "s_suppkey BIGINT, s_nationkey INT").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    got = queries.QUERIES["compacted_documents"](spark, str(tmp_path)).collect()
    for day, n in (("2024-01-01", 45), ("2024-01-02", 31)):
        files = [f.name for f in (tmp_path / "landed" / "raw" / "user_profiles" / day).glob("part-*.txt")]
        assert len(files) == n  # still one document to a file
        assert len({f.split("-")[1] for f in files}) > 1  # written by more than one task
    assert {(r.state, r.documents) for r in got} == {("before", 76), ("after", 60)}
    before, after = ({(r.steam_id, r.app_id) for r in got if r.state == s} for s in ("before", "after"))
    assert before == after and len(before) == 30


def test_many_one_document_files_are_read_in_parts(spark, tmp_path, monkeypatch):
    from tasteforge.sources import documents

    names = ["a.json", "b c.json", "100%25.json", "[x]{y}*.json", "back\\slash?.json", "_hidden.json", "_k=v.json", ".dot.json", "other.txt", "é.json"]
    for i, name in enumerate(names):
        for day in ("2026-06-08", "2026-06-09"):
            land(tmp_path, "x", day, name, {"id": i, "n": i, "ingested_at": f"{day} {i}", "own": [name]})
    for name, text in (("broken.json", "{ not\njson"), ("empty.json", ""), ("array.json", '[{"id": "p"}, {"id": "q"}]'), ("odd.json", '{"id": 5, "n": {}}')):
        land(tmp_path, "x", "2026-06-09", name, text)
    land(tmp_path, "x", "2026-06-10/below", "deep.json", {"id": 99})
    land(tmp_path, "x", "notes", "n.json", {"id": 98})
    land(tmp_path, "x", "2026-06-11", "last.json", {"id": 0, "ingested_at": "late"})
    found = []
    for at_once in (1000, 4, 1):
        monkeypatch.setattr(documents, "FILES_AT_ONCE", at_once, raising=False)
        docs = scan_documents(spark, str(tmp_path), "x", "id STRING, n BIGINT")
        assert any(f.endswith(".json") for f in docs.inputFiles()) == (at_once == 1000)  # else the driver knows the stored table only
        one = scan_documents(spark, str(tmp_path), "x", "id STRING, n BIGINT", day="2026-06-09")
        rows = lambda df: sorted((tuple(r) for r in df.select("id", "n", "_corrupt_record", "ingest_date", "source_file").collect()), key=str)
        out = str(tmp_path / f"out{at_once}")
        assert compact_documents(spark, str(tmp_path), "x", "id", out)
        lines = sorted((str(r.ingest_date), r.value) for r in spark.read.text(f"{out}/raw/x").collect())
        found.append((docs.dtypes, rows(docs), docs.count(), rows(one), lines))
    assert found[0] == found[1] == found[2]
    assert found[0][2] == 20 and {r[0] for r in found[0][1]} >= {"0", "p", "q", "98", "5", None} and len(found[0][4]) > 15
    assert scan_documents(spark, str(tmp_path), "absent", "id STRING") is None
    assert not compact_documents(spark, str(tmp_path), "absent", "id", str(tmp_path / "none"))
