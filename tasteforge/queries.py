"""The registered queries: each operator bound to the driver's tables, next to the SQL it must equal.

Nested inputs are built row by row from flat columns or by splitting a whole text, never by
collecting a group into one array, so every query grows with its tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge import schemas
from tasteforge.functions.parsing import lenient_double, utc_stamp
from tasteforge.functions.scoring import hybrid_score
from tasteforge.functions.text import clean_text, long_enough
from tasteforge.operators.dictionary import IdDictionary, fit_dictionary, load_dictionary, save_dictionary
from tasteforge.operators.factors import AlsSettings, factor_topk, predict
from tasteforge.operators.joins import enrich, left_join_feedback, missing_keys
from tasteforge.operators.latest import latest_per_key
from tasteforge.operators.nested import compute_once, explode_items, pick_fields
from tasteforge.operators.splits import hash_split, rmse
from tasteforge.operators.topn import distinct_ids, top_n, top_n_tagged
from tasteforge.plans import bronze, gold, silver, worklists
from tasteforge.plans.serve import recommend_topk
from tasteforge.plans.train import train_and_evaluate
from tasteforge.session import intermediate_path, materialize
from tasteforge.sources.bundle import ModelBundle, load_bundle, save_bundle
from tasteforge.sources.documents import (
    DAY,
    SOURCE,
    compact_documents,
    corrupt_report,
    on_day,
    readable,
    rewrite_documents,
    scan_documents,
    scan_or_empty,
    write_documents,
)
from tasteforge.sources.tables import read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register under ``name``, or under the function's own name where no operator bears it."""

    def add(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str):
    return F.col(column).cast("string")


def _struct(**fields):
    return F.struct(*[value.alias(name) for name, value in fields.items()])


# --- scoring and joins -----------------------------------------------------------------------


def _labelled_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = _table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("voted_up"))
    return documents, labels


@_register("""
    SELECT d.doc_id::VARCHAR AS doc_id, l.quality = 1 AS voted_up
    FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def left_join_reviews(spark, sf_dir):
    documents, labels = _labelled_documents(spark, sf_dir)
    return left_join_feedback(documents.select("doc_id"), labels, keys=["doc_id"])


@_register("""
    SELECT d.doc_id::VARCHAR AS doc_id,
           round(ln(1 + d.n_chars) * CASE WHEN l.quality = 1 THEN 1.5 WHEN l.quality <> 1 THEN 0.5 ELSE 1 END, 6)
               AS interaction_score
    FROM documents d LEFT JOIN labels l USING (doc_id)
""", name="hybrid_score")
def hybrid_score_by_review(spark, sf_dir):
    joined = left_join_feedback(*_labelled_documents(spark, sf_dir), keys=["doc_id"])
    score = hybrid_score(F.col("n_chars"), F.col("voted_up"))
    return joined.select("doc_id", F.round(score, 6).alias("interaction_score"))


@_register("""
    WITH sold AS (SELECT l_partkey, sum(l_quantity) AS ccu FROM lineitem GROUP BY 1),
    ranked AS (
        SELECT p_partkey, ccu FROM part LEFT JOIN sold ON l_partkey = p_partkey
        ORDER BY coalesce(ccu, 0) DESC, p_partkey LIMIT 500
    )
    SELECT r.p_partkey::VARCHAR AS app_id, r.ccu AS score, m.p_name AS game_name, m.p_type AS genre
    FROM ranked r LEFT JOIN (SELECT * FROM part WHERE p_size > 10) m USING (p_partkey)
    ORDER BY coalesce(r.ccu, 0) DESC, app_id
""")
def enrich_recs(spark, sf_dir):
    recs = top_n(_catalogue(spark, sf_dir), 500, "ccu", "appid").select(
        F.col("appid").alias("app_id"), F.col("ccu").alias("score")
    )
    metadata = _table(spark, sf_dir, "part").where(F.col("p_size") > 10)
    metadata = pick_fields(metadata, {"app_id": "p_partkey", "game_name": "p_name", "genre": "p_type"})
    return enrich(recs, metadata).orderBy(F.coalesce("score", F.lit(0)).desc(), "app_id")


@_register("""
    SELECT c_custkey AS custkey FROM customer c
    WHERE NOT EXISTS (
        SELECT 1 FROM orders o
        WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    )
""")
def unknown_users(spark, sf_dir):
    asked = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    orders = _table(spark, sf_dir, "orders")
    known = orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    return missing_keys(asked, known.select(F.col("o_custkey").alias("custkey")), "custkey")


# --- latest snapshot, nested data, text --------------------------------------------------------


@_register("""
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""", name="latest_per_key")
def latest_per_user(spark, sf_dir):
    return latest_per_key(_table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])


@_register("""
    SELECT * FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1
""")
def latest_with_ties(spark, sf_dir):
    return latest_per_key(_table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])


@_register(r"""
    SELECT doc_id, trim(regexp_replace(text, '[\r\n]+', ' ', 'g'), ' ') AS review_text FROM documents
    WHERE length(trim(regexp_replace(text, '[\r\n]+', ' ', 'g'), ' ')) >= 10
""", name="clean_text")
def cleaned_texts(spark, sf_dir):
    texts = _table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review_text"))
    return compute_once(texts, clean_text(F.col("review_text")), "review_text", long_enough)


def _lines():
    """The lines of a text as an array of (line_no, n_chars, line)."""
    return F.transform(
        F.split("text", "\n"),
        lambda line, i: _struct(line_no=i, n_chars=F.length(line), line=line),
    )


@_register("""
    WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    r AS (SELECT doc_id, unnest(range(len(lines))) AS i, unnest(lines) AS line FROM l)
    SELECT doc_id, i::INT AS line_no, length(line)::INT AS n_chars FROM r WHERE length(line) > 0
""", name="explode_items")
def exploded_items(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", _lines().alias("lines"))
    fields = {"line_no": "line_no", "n_chars": "n_chars"}
    return explode_items(documents, "lines", fields, keep=lambda item: item["n_chars"] > 0, carry=("doc_id",))


@_register("""
    SELECT p_partkey AS app_id, p_name AS game_name, p_size AS score,
           CASE WHEN p_size > 10 THEN p_brand END AS brand
    FROM part
""")
def nested_project(spark, sf_dir):
    priced = F.when(F.col("p_size") > 10, _struct(brand=F.col("p_brand")))
    parts = _table(spark, sf_dir, "part").select(
        "p_partkey",
        _struct(name=F.col("p_name"), metacritic=_struct(score=F.col("p_size")), price=priced).alias("metadata"),
    )
    return pick_fields(
        parts,
        {
            "app_id": "p_partkey",
            "game_name": "metadata.name",
            "score": "metadata.metacritic.score",
            "brand": "metadata.price.brand",
        },
    )


@_register("""
    SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: length(x)), ',') AS line_lengths
    FROM documents
""")
def array_field(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", _lines().alias("lines"))
    lengths = pick_fields(documents, {"doc_id": "doc_id", "n_chars": "lines.n_chars"})
    as_text = F.array_join(F.col("n_chars").cast("array<string>"), ",")
    return lengths.select("doc_id", as_text.alias("line_lengths"))


@_register("""
    SELECT doc_id,
           len(string_split(text, chr(10)))::INT AS n_lines,
           len(list_filter(string_split(text, chr(10)), lambda x: length(x) >= 10))::INT AS n_kept
    FROM documents
""")
def filter_array_elements(spark, sf_dir):
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line: long_enough(line))
    return _table(spark, sf_dir, "documents").select(
        "doc_id", F.size(lines).alias("n_lines"), F.size(kept).alias("n_kept")
    )


@_register("""
    SELECT event_id, (props->>'k')::INT AS k FROM events
""")
def json_extract(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k INT").alias("props"))
    return pick_fields(events, {"event_id": "event_id", "k": "props.k"})


_UNTYPED = """CASE o_orderstatus WHEN 'F' THEN o_totalprice::VARCHAR WHEN 'P' THEN o_orderpriority
              WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN '' END END"""


@_register(f"""
    SELECT o_orderkey, coalesce(try_cast({_UNTYPED} AS DOUBLE), 0.0) AS weighted_score FROM orders
""")
def lenient_cast(spark, sf_dir):
    blank = F.when(F.col("o_orderkey") % 2 == 0, F.lit(""))
    untyped = (
        F.when(F.col("o_orderstatus") == "F", _text("o_totalprice"))
        .when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .when(F.col("o_orderstatus") == "O", blank)
    )
    return _table(spark, sf_dir, "orders").select("o_orderkey", lenient_double(untyped).alias("weighted_score"))


@_register("""
    SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
""")
def scan_day_partition(spark, sf_dir):
    return on_day(_table(spark, sf_dir, "events"), "ts", "2024-01-15").select("event_id", "user_id", "value")


# --- shaping raw payloads ------------------------------------------------------------------------


@_register("""
    WITH r AS (
        SELECT l_orderkey::VARCHAR AS steam_id, unnest([l_partkey, l_suppkey]) AS appid,
               unnest([l_quantity::BIGINT, 0]) AS playtime_forever
        FROM lineitem WHERE l_returnflag <> 'N'
    )
    SELECT steam_id, 2::BIGINT AS game_count, appid, playtime_forever FROM r
""")
def shape_libraries(spark, sf_dir):
    no_playtime = F.lit(None).cast("bigint")
    games = F.array(
        _struct(appid=F.col("l_partkey"), playtime_forever=F.col("l_quantity").cast("bigint")),
        _struct(appid=F.col("l_suppkey"), playtime_forever=no_playtime),
    )
    public = F.to_json(_struct(response=_struct(games=games)))
    payload = F.when(F.col("l_returnflag") == "N", F.lit('{"response": {}}')).otherwise(public)
    raw = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("steam_id"), payload.alias("payload"))
    fields = {"appid": "appid", "playtime_forever": "playtime_forever"}
    return explode_items(bronze.shape_libraries(raw), "games", fields, carry=("steam_id", "game_count"))


@_register("""
    SELECT o_orderkey::VARCHAR AS steam_id,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END::INT AS n_friends,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_custkey::VARCHAR || ',' || o_orderkey::VARCHAR END AS friends
    FROM orders
""")
def shape_friends(spark, sf_dir):
    friends = F.array(_struct(steamid=_text("o_custkey")), _struct(steamid=_text("o_orderkey")))
    visible = F.to_json(_struct(friendslist=_struct(friends=friends)))
    payload = F.when(F.col("o_orderstatus") == "P", F.lit("{}")).otherwise(visible)
    raw = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("steam_id"), payload.alias("payload"))
    friends = F.array_join("friends", ",").alias("friends")
    return bronze.shape_friends(raw).select("steam_id", F.size("friends").alias("n_friends"), friends)


@_register("""
    SELECT p_partkey::VARCHAR AS app_id, p_name AS game_name, p_size::VARCHAR AS required_age,
           p_size < 25 AS is_free, p_type || ',' || p_brand AS genres, 0 AS n_developers,
           NULL::VARCHAR AS price_formatted
    FROM part WHERE p_size > 5
""")
def shape_metadata(spark, sf_dir):
    data = _struct(
        name=F.col("p_name"),
        required_age=F.col("p_size"),
        is_free=F.col("p_size") < 25,
        genres=F.array(_struct(description=F.col("p_type")), _struct(description=F.col("p_brand"))),
    )
    envelope = F.create_map(_text("p_partkey"), _struct(success=F.col("p_size") > 5, data=data))
    raw = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("app_id"), F.to_json(envelope).alias("payload"))
    return bronze.shape_metadata(raw).select(
        "app_id",
        F.col("metadata.name").alias("game_name"),
        F.col("metadata.required_age").alias("required_age"),
        F.col("metadata.is_free").alias("is_free"),
        F.array_join("metadata.genres.description", ",").alias("genres"),
        F.size("metadata.developers").alias("n_developers"),
        F.col("metadata.price_overview.final_formatted").alias("price_formatted"),
    )


@_register("""
    WITH l AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents WHERE lang = 'en'),
    r AS (SELECT doc_id, source, len(lines) AS n, unnest(range(len(lines))) AS i, unnest(lines) AS line FROM l)
    SELECT doc_id::VARCHAR AS app_id, n::BIGINT AS review_count, doc_id || '-' || i AS review_id, source AS steam_id,
           CASE WHEN i % 3 = 0 THEN length(line) / 8 ELSE 0 END::DOUBLE AS weighted_score, line AS review_text
    FROM r
""")
def shape_reviews(spark, sf_dir):
    def review(line, i):
        return _struct(
            recommendationid=F.concat_ws("-", _text("doc_id"), i),
            author=_struct(steamid=F.col("source")),
            language=F.when(F.col("lang") == "en", "english").otherwise(F.col("lang")),
            weighted_vote_score=F.when(i % 3 == 0, (F.length(line) / 8).cast("string")).when(i % 3 == 1, F.lit("x")),
            review=line,
        )

    reviews = F.transform(F.split("text", "\n"), review)
    payload = F.to_json(_struct(success=F.lit(1), reviews=reviews))
    raw = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("app_id"), payload.alias("payload"))
    fields = {c: c for c in ("review_id", "steam_id", "weighted_score", "review_text")}
    return explode_items(bronze.shape_reviews(raw), "reviews", fields, carry=("app_id", "review_count"))


@_register("""
    SELECT p_partkey AS appid, CASE WHEN p_size > 10 THEN p_size END::BIGINT AS ccu FROM part
    UNION ALL SELECT -p_partkey - 1, 7 FROM part
""")
def shape_catalogue(spark, sf_dir):
    size = F.col("p_size").cast("bigint")
    listing = F.create_map(
        F.lit("a"), _struct(appid=F.col("p_partkey"), ccu=F.when(size > 10, size)),
        F.lit("b"), _struct(appid=-F.col("p_partkey") - 1, ccu=F.lit(7).cast("bigint")),
    )
    return bronze.shape_catalogue(_table(spark, sf_dir, "part").select(F.to_json(listing).alias("payload")))


# --- silver --------------------------------------------------------------------------------------


@_register("""
    WITH latest AS (
        SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_partkey
            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) = 1
    ), games AS (
        SELECT l_partkey, unnest([l_suppkey * 10, l_suppkey * 10 + 1, l_suppkey * 10 + 2]) AS app_id,
               unnest([l_quantity, round(l_discount * 100), round(l_tax * 100)])::BIGINT AS playtime
        FROM latest
    )
    SELECT l_partkey::VARCHAR AS steam_id, app_id::VARCHAR AS app_id, playtime AS playtime_minutes
    FROM games WHERE playtime > 0
""")
def silver_interactions(spark, sf_dir):
    supplier = F.col("l_suppkey") * 10
    games = F.array(
        _struct(appid=supplier, playtime_forever=F.col("l_quantity").cast("bigint")),
        _struct(appid=supplier + 1, playtime_forever=F.round(F.col("l_discount") * 100).cast("bigint")),
        _struct(appid=supplier + 2, playtime_forever=F.round(F.col("l_tax") * 100).cast("bigint")),
    )
    ties = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    profiles = _table(spark, sf_dir, "lineitem").select(
        _text("l_partkey").alias("steam_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
        games.alias("games"),
        *ties,
    )
    return silver.silver_interactions(profiles, ties)


@_register("""
    SELECT p_name AS app_id, p_name || ' ' || p_brand AS game_name, p_size < 10 AS is_free,
           CASE WHEN p_size > 20 THEN p_size::VARCHAR END AS price_formatted, p_brand AS release_date,
           p_size::BIGINT AS metacritic_score, p_type || ',' || p_brand AS genres, '' AS categories
    FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) = 1
""")
def silver_metadata(spark, sf_dir):
    price = F.when(F.col("p_size") > 20, _struct(final_formatted=_text("p_size")))
    metadata = _struct(
        name=F.concat_ws(" ", "p_name", "p_brand"),
        is_free=F.col("p_size") < 10,
        price_overview=price,
        release_date=_struct(date=F.col("p_brand")),
        metacritic=_struct(score=F.col("p_size").cast("bigint")),
        genres=F.array(_struct(description=F.col("p_type")), _struct(description=F.col("p_brand"))),
        categories=F.array().cast("array<struct<description: string>>"),
    )
    documents = _table(spark, sf_dir, "part").select(
        F.col("p_name").alias("app_id"),
        F.lpad(_text("p_partkey"), 19, "0").alias("ingested_at"),
        metadata.alias("metadata"),
    )
    flat = silver.silver_metadata(documents)
    return flat.withColumns({c: F.array_join(c, ",") for c in ("genres", "categories")})


@_register(r"""
    WITH latest AS (
        SELECT *, md5(text) AS app_id FROM documents
        QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id DESC) = 1
    ), s AS (
        SELECT *, string_split(text, '. ') AS parts FROM latest
    ), r AS (
        SELECT app_id, doc_id, source, lang, n_chars, unnest(range(len(parts))) AS i, unnest(parts) AS part FROM s
    ), c AS (
        SELECT *, trim(regexp_replace(part, '[\r\n]+', ' ', 'g'), ' ') AS review_text FROM r
    )
    SELECT app_id, doc_id || '-' || i AS review_id, source AS steam_id, length(part)::BIGINT AS playtime_minutes,
           lang = 'en' AS voted_up, (n_chars % 100)::DOUBLE / 100::DOUBLE AS weighted_score, review_text
    FROM c WHERE length(review_text) >= 10
""")
def silver_reviews(spark, sf_dir):
    def review(part, i):
        return _struct(
            review_id=F.concat_ws("-", _text("doc_id"), i),
            steam_id=F.col("source"),
            playtime_minutes=F.length(part).cast("bigint"),
            voted_up=F.col("lang") == "en",
            weighted_score=(F.col("n_chars") % 100).cast("double") / 100,
            review_text=part,
        )

    reviews = _table(spark, sf_dir, "documents").select(
        F.md5("text").alias("app_id"),
        F.lpad(_text("doc_id"), 19, "0").alias("ingested_at"),
        F.transform(F.split("text", r"\. "), review).alias("reviews"),
    )
    return silver.silver_reviews(reviews)


# --- ids, gold -----------------------------------------------------------------------------------


@_register("""
    SELECT o_custkey::VARCHAR AS label, count(*) AS frequency,
           row_number() OVER (ORDER BY count(*) DESC, o_custkey::VARCHAR) - 1 AS "index"
    FROM orders GROUP BY o_custkey
""")
def id_dictionary(spark, sf_dir):
    return fit_dictionary(_table(spark, sf_dir, "orders"), "o_custkey").frame


_FINISHED = """WITH dictionary AS (
        SELECT o_custkey AS k, row_number() OVER (ORDER BY count(*) DESC, o_custkey::VARCHAR) - 1 AS i
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)"""


def _finished_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, IdDictionary]:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    dictionary = fit_dictionary(orders.where(F.col("o_orderstatus") == "F"), "o_custkey")
    return orders.select("o_orderkey", "o_custkey"), dictionary


@_register(f"""
    {_FINISHED} SELECT o_orderkey, o_custkey, i AS user_index FROM orders JOIN dictionary ON o_custkey = k
""")
def encode_known_ids(spark, sf_dir):
    orders, dictionary = _finished_orders(spark, sf_dir)
    return dictionary.encode(orders, "o_custkey", "user_index")


@_register(f"""
    {_FINISHED} SELECT o_orderkey, i AS user_index, k::VARCHAR AS user_id
    FROM orders JOIN dictionary ON o_custkey = k
""")
def decode_ids(spark, sf_dir):
    orders, dictionary = _finished_orders(spark, sf_dir)
    encoded = dictionary.encode(orders, "o_custkey", "user_index").select("o_orderkey", "user_index")
    return dictionary.decode(encoded, "user_index", "user_id")


def _purchases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(interactions, reviews): quantity bought per customer and part, and whether it was accepted.

    Stored as one table, as the silver tables are, so that the join behind both runs once.
    """
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    accepted = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "A")
    pairs = bought.groupBy("o_custkey", "l_partkey").agg(
        F.sum("l_quantity").alias("playtime_minutes"), F.bool_or(accepted).alias("voted_up")
    )
    named = pairs.select(
        _text("o_custkey").alias("steam_id"), _text("l_partkey").alias("app_id"), "playtime_minutes", "voted_up"
    )
    stored = materialize(named, "purchases")
    return stored.drop("voted_up"), stored.where(F.col("voted_up").isNotNull()).drop("playtime_minutes")


def _gold(spark: SparkSession, sf_dir: str) -> gold.GoldTables:
    return gold.interaction_matrix(gold.score_interactions(*_purchases(spark, sf_dir)))


@_register("""
    WITH bought AS (SELECT o_custkey, l_partkey, l_quantity, l_returnflag
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    pairs AS (SELECT o_custkey, l_partkey, sum(l_quantity) AS q FROM bought GROUP BY ALL),
    votes AS (SELECT o_custkey, l_partkey, bool_or(l_returnflag = 'A') AS up
              FROM bought WHERE l_returnflag <> 'N' GROUP BY ALL),
    scored AS (SELECT o_custkey, l_partkey,
                      ln(1 + q) * CASE WHEN up THEN 1.5 WHEN NOT up THEN 0.5 ELSE 1 END::DOUBLE AS score
               FROM pairs LEFT JOIN votes USING (o_custkey, l_partkey)),
    users AS (SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, o_custkey::VARCHAR) - 1 AS i
              FROM scored GROUP BY o_custkey),
    items AS (SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) - 1 AS i
              FROM scored GROUP BY l_partkey)
    SELECT users.i::INT AS user_index, items.i::INT AS item_index, score::FLOAT AS interaction_score
    FROM scored JOIN users USING (o_custkey) JOIN items USING (l_partkey)
""")
def interaction_matrix(spark, sf_dir):
    return _gold(spark, sf_dir).matrix


# --- work lists ----------------------------------------------------------------------------------


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("appid"))
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("appid"), F.col("p_type").alias("tag"))
    return parts.join(lines.agg(F.sum("l_quantity").alias("ccu")), "appid", "left")


_CATALOGUE = """WITH sold AS (SELECT l_partkey, sum(l_quantity) AS ccu FROM lineitem GROUP BY 1),
    catalogue AS (SELECT p_partkey AS appid, p_type AS tag, ccu FROM part LEFT JOIN sold ON l_partkey = p_partkey),
    popular AS (SELECT * FROM catalogue ORDER BY coalesce(ccu, 0) DESC, appid LIMIT 500),
    tagged AS (SELECT * FROM catalogue WHERE tag = 'ECONOMY' ORDER BY coalesce(ccu, 0) DESC, appid LIMIT 200)"""


@_register(f"{_CATALOGUE} SELECT appid, tag, ccu FROM popular")
def top_n_global(spark, sf_dir):
    return top_n(_catalogue(spark, sf_dir), worklists.TOP_GLOBAL, "ccu", "appid")


@_register(f"{_CATALOGUE} SELECT appid, tag, ccu FROM tagged", name="top_n_tagged")
def top_n_tagged_parts(spark, sf_dir):
    return top_n_tagged(_catalogue(spark, sf_dir), "ECONOMY", worklists.TOP_TAGGED, "ccu", "appid", "tag")


def _seed_lists(spark: SparkSession, sf_dir: str) -> worklists.SeedLists:
    catalogue = _catalogue(spark, sf_dir)
    return worklists.seed_worklist(catalogue, catalogue.where(F.col("tag") == "ECONOMY"))


@_register(f"""
    {_CATALOGUE} SELECT appid::VARCHAR AS app_id FROM popular UNION SELECT appid::VARCHAR FROM tagged
""")
def union_distinct_top_n(spark, sf_dir):
    return _seed_lists(spark, sf_dir).combined


@_register(f"""
    {_CATALOGUE} SELECT (SELECT count(*) FROM popular) AS popular, (SELECT count(*) FROM tagged) AS tagged,
        (SELECT count(*) FROM (SELECT appid FROM popular UNION SELECT appid FROM tagged)) AS combined
""")
def worklist_stats(spark, sf_dir):
    return _seed_lists(spark, sf_dir).sizes()


@_register("""
    SELECT DISTINCT word AS id FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> ''
""")
def discover_ids(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select(F.split("text", " ").alias("words"))
    return distinct_ids(explode_items(documents, "words", "word"), "word")


@_register("""
    SELECT DISTINCT source AS steam_id FROM documents WHERE source <> ''
    UNION SELECT lang FROM documents WHERE lang <> ''
""")
def discover_reviewers(spark, sf_dir):
    authors = [F.col("source"), F.col("lang"), F.lit(""), F.lit(None).cast("string")]
    reviews = F.array(*[_struct(steam_id=author) for author in authors])
    return worklists.users_in_reviews(_table(spark, sf_dir, "documents").select(reviews.alias("reviews")))


@_register("""
    SELECT DISTINCT id::VARCHAR AS app_id FROM (SELECT unnest([l_partkey, l_suppkey]) AS id FROM lineitem)
    ORDER BY app_id LIMIT 5
""")
def harvest_ids(spark, sf_dir):
    games = F.array(_struct(appid=F.col("l_partkey")), _struct(appid=F.col("l_suppkey")))
    return worklists.harvest(_table(spark, sf_dir, "lineitem").select(games.alias("games")))


@_register("""
    SELECT DISTINCT user_id::VARCHAR AS steam_id FROM events WHERE event_type = 'purchase' ORDER BY 1 LIMIT 100
""")
def quota_take(spark, sf_dir):
    bought = F.filter(F.array(_struct(appid=F.col("event_id"))), lambda g: F.col("event_type") == "purchase")
    profiles = _table(spark, sf_dir, "events").select(_text("user_id").alias("steam_id"), bought.alias("games"))
    return worklists.quota(profiles)


# --- splits, error, factors ----------------------------------------------------------------------


@_register("""
    SELECT o_orderkey, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 100 < 80 AS in_train FROM orders
""", name="hash_split")
def hash_split_orders(spark, sf_dir):
    train, test = hash_split(_table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


@_register("""
    SELECT round(sqrt(avg(power(l_extendedprice - l_extendedprice * (1 - l_discount), 2))), 4) AS rmse FROM lineitem
""")
def rmse_by_sql(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_discount")
    predicted = lines.withColumn("prediction", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return rmse(predicted, "l_extendedprice", "prediction").select(F.round("rmse", 4).alias("rmse"))


@_register("""
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    s AS (SELECT u.vec_id AS user_id, i.vec_id AS item_id, round(list_dot_product(u.e, i.e), 9) AS score
          FROM v u CROSS JOIN v i)
    SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)::INT AS "rank"
    FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) <= 5
""", name="factor_topk")
def factor_top5(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    dim = vectors.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    lists = factor_topk(vectors, vectors, 5, dim, vector_col="embedding", id_col="vec_id", decimals=9)
    return lists.select(F.col("user").alias("user_id"), F.col("item").alias("item_id"), "rank")


@_register("""
    WITH w AS (SELECT vec_id, embedding::DOUBLE[] AS e, (1 + vec_id % 50)::DOUBLE AS d FROM embeddings),
    v AS (SELECT vec_id, e, [x / d for x in e] AS f FROM w),
    s AS (SELECT u.vec_id AS user_id, i.vec_id AS item_id, round(list_dot_product(u.e, i.f), 9) AS score FROM v u CROSS JOIN v i)
    SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)::INT AS "rank"
    FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) <= 10
""")
def factor_topk_by_norm(spark, sf_dir):
    """Items of very different lengths, as popular ones are, in blocks cut by norm: most cells cannot reach a floor."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    dim = vectors.agg(F.max(F.size("e")).alias("n")).first()["n"]
    shrink = (1 + F.col("vec_id") % 50).cast("double")
    items = vectors.select("vec_id", F.transform("e", lambda x: x / shrink).alias("e"))
    lists = factor_topk(vectors, items, 10, dim, vector_col="e", id_col="vec_id", decimals=9, item_rows=100)
    return lists.select(F.col("user").alias("user_id"), F.col("item").alias("item_id"), "score", "rank")


@_register("""
    WITH m AS (""" + ORACLES["interaction_matrix"] + """),
    parts AS (SELECT *, ('0x' || substr(md5(user_index || ':' || item_index), 1, 8))::BIGINT % 100 < 80 AS train FROM m),
    fit AS (SELECT * FROM parts WHERE train), rest AS (SELECT * FROM parts WHERE NOT train)
    SELECT (SELECT count(DISTINCT user_index) FROM fit) AS train_users, (SELECT count(DISTINCT item_index) FROM fit) AS train_items,
        (SELECT count(*) FROM fit) AS train_pairs,
        (SELECT count(*) FROM rest WHERE user_index IN (SELECT user_index FROM fit) AND item_index IN (SELECT item_index FROM fit))
            AS scored_pairs,
        0::BIGINT AS negative, 0::BIGINT AS not_finite, TRUE AS error_in_range
""")
def als_holdout(spark, sf_dir):
    """What can be known of a fit without fitting: who has factors, which held-out pairs get a score, and the scores' range.

    error_in_range: the hold-out error is below the root mean square of the held-out scores, that is, better than
    predicting nothing.
    """
    matrix = materialize(_gold(spark, sf_dir).matrix, "matrix")
    trained = train_and_evaluate(matrix)
    scored = predict(trained.model, trained.test)
    label, guess = F.col("interaction_score").cast("double"), F.col("prediction").cast("double")
    facts = scored.agg(
        F.count(F.lit(1)).alias("scored_pairs"),
        F.count_if(guess < 0).alias("negative"),
        F.count_if(F.isnan(guess) | guess.isNull()).alias("not_finite"),
        (F.sum((label - guess) ** 2) < F.sum(label**2)).alias("error_in_range"),
    )
    sizes = {
        "train_users": trained.model.userFactors.count(),
        "train_items": trained.model.itemFactors.count(),
        "train_pairs": trained.train.count(),
    }
    return facts.select("*", *[F.lit(n).cast("bigint").alias(name) for name, n in sizes.items()])


@_register("""
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    asked AS (SELECT * FROM v WHERE vec_id % 3 <> 0),
    s AS (SELECT u.vec_id AS u, i.vec_id AS i, list_dot_product(u.e, i.e) AS score FROM asked u CROSS JOIN v i),
    best AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, i) AS r FROM s
             QUALIFY row_number() OVER (PARTITION BY u ORDER BY score DESC, i) <= 5)
    SELECT 'user ' || u AS steam_id, i::VARCHAR AS app_id, p_name AS game_name,
           CASE WHEN p_partkey IS NOT NULL THEN [p_type] END AS genres, r::INT AS "rank"
    FROM best LEFT JOIN part ON p_partkey = i
""", name="recommend_topk")
def recommend_all(spark, sf_dir):
    """Batch serving with the embeddings as factors of users and items; an asked user without factors has no list."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    users = fit_dictionary(vectors.select(F.concat(F.lit("user "), _text("vec_id")).alias("u")), "u")
    items = fit_dictionary(vectors.select(_text("vec_id").alias("i")), "i")
    width = vectors.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    factors = vectors.select(_text("vec_id").alias("item"), F.concat(F.lit("user "), _text("vec_id")).alias("user"), F.col("embedding").alias("features"))
    by_user = users.encode(factors.where(F.col("item").cast("bigint") % 3 != 0), "user", "id").select("id", "features")
    # Ties by item go by index; equal frequencies are numbered by label, so the item order is that of vec_id only as text.
    by_item = items.encode(factors, "item", "id").select("id", "features")
    bundle = ModelBundle("query", by_user, by_item, width, users, items)
    asked = users.frame.select(F.col("label").alias("steam_id"))
    metadata = _table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("app_id"), F.col("p_name").alias("game_name"), F.array("p_type").alias("genres")
    )
    return recommend_topk(bundle, asked, metadata, k=5, ordered=False).drop("predicted_affinity_score")


# --- stores and landed documents -----------------------------------------------------------------


def _landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event landed as a line of text, ids and numbers in changing spellings, every tenth line broken; scanned."""
    even = F.col("event_id") % 2 == 0
    number, text = F.round("value", 2).cast("string"), F.concat(F.lit('"'), F.round("value", 2).cast("string"), F.lit('"'))
    item = F.concat(
        F.lit('{"appid": '), F.when(even, F.col("user_id").cast("string")).otherwise(F.concat(F.lit('"'), "user_id", F.lit('"'))),
        F.lit(', "playtime_forever": '), F.when(F.col("event_id") % 3 == 0, text).otherwise(number), F.lit("}"),
    )
    document = F.concat(
        F.lit('{"ingested_at": "2024-01-01T00:00:00", "steam_id": '), F.when(even, F.concat(F.lit('"'), "event_id", F.lit('"'))).otherwise(_text("event_id")),
        F.lit(', "games": ['), item, F.lit(', {"appid": null, "playtime_forever": 1}, {"appid": 1, "playtime_forever": "none"}]}'),
    )
    line = F.when(F.col("event_id") % 10 == 0, F.lit("{ not json")).otherwise(document)
    base = intermediate_path(spark, "landed")
    _table(spark, sf_dir, "events").select(line).write.text(f"{base}/raw/user_profiles/{DAY}=2024-01-01")
    return scan_documents(spark, base, "user_profiles", schemas.USER_PROFILES_READ, layout="hive", files="*.txt")


@_register("""
    SELECT event_id::VARCHAR AS steam_id, user_id::VARCHAR AS app_id, trunc(round(value, 2))::BIGINT AS playtime_minutes
    FROM events WHERE event_id % 10 <> 0 AND trunc(round(value, 2)) > 0
""")
def scan_mixed_documents(spark, sf_dir):
    return silver.silver_interactions(silver.typed_profiles(_landed_events(spark, sf_dir)), tie_breakers=("source_file",))


@_register("""
    SELECT count(*) AS documents, count(*) FILTER (event_id % 10 = 0) AS corrupt, 0::BIGINT AS partial, 0::BIGINT AS unstamped
    FROM events
""")
def reject_counts(spark, sf_dir):
    return corrupt_report(_landed_events(spark, sf_dir))


@_register("""
    SELECT o_orderkey::VARCHAR AS steam_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at,
           o_custkey AS appid, DATE '1995-03-01' AS ingest_date
    FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1995-03-01'
""")
def stored_documents(spark, sf_dir):
    """Documents written under their month, with a stamp, and one month read back."""
    games = F.array(_struct(appid=F.col("o_custkey"), playtime_forever=F.lit(1).cast("bigint")))
    stamp = utc_stamp(F.col("o_orderdate").cast("timestamp"))
    docs = _table(spark, sf_dir, "orders").select(stamp.alias("ingested_at"), _text("o_orderkey").alias("steam_id"), games.alias("games"), "o_orderdate")
    base, month = intermediate_path(spark, "documents"), F.trunc("o_orderdate", "month")
    write_documents(docs.withColumn("month", month).repartition("month").drop("month"), base, "user_profiles", month)
    read = readable(scan_documents(spark, base, "user_profiles", schemas.USER_PROFILES, layout="hive", day="1995-03-01"))
    return explode_items(read, "games", {"appid": "appid"}, carry=("steam_id", "ingested_at", DAY))


@_register("""
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT o_orderkey, 0, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
""")
def stored_table(spark, sf_dir):
    """A partitioned table of which one partition is replaced, read back."""
    path = intermediate_path(spark, "table")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_table(orders, path, ["o_orderstatus"])
    again = orders.where("o_orderstatus = 'F' and o_totalprice > 100000").withColumn("o_totalprice", F.lit(0.0))
    write_table(again, path, ["o_orderstatus"])
    return read_table(spark, path)


@_register(f"""
    {_FINISHED} SELECT o_orderkey, o_custkey, i AS user_index FROM orders JOIN dictionary ON o_custkey = k
""")
def stored_dictionary(spark, sf_dir):
    """Ids encoded with a dictionary that was saved and loaded."""
    orders, dictionary = _finished_orders(spark, sf_dir)
    path = intermediate_path(spark, "dictionary")
    save_dictionary(dictionary, path)
    return load_dictionary(spark, path).encode(orders, "o_custkey", "user_index")


@_register("""
    SELECT 'user_interactions' AS part, event_id || '/' || user_id AS entity, trunc(round(value, 2))::BIGINT AS playtime_minutes
    FROM events WHERE event_id % 10 <> 0 AND trunc(round(value, 2)) > 0
    UNION ALL SELECT CASE event_id % 10 WHEN 0 THEN 'not JSON' ELSE 'value of another kind' END, event_id::VARCHAR, 0::BIGINT
    FROM events WHERE event_id % 10 < 2
""")
def silver_run(spark, sf_dir):
    """The whole silver job over landed lines: every tenth is not JSON, every tenth has an element of another kind."""
    line = F.format_string(
        '{"steam_id": "%d", "ingested_at": "2024-01-01T00:00:00", "games": [%s{"appid": %d, "playtime_forever": %s}]}',
        "event_id", F.when(F.col("event_id") % 10 == 1, '"odd", ').otherwise(""), "user_id", F.round("value", 2).cast("string"),
    )
    text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{ not json "), _text("event_id"))).otherwise(line)
    base = intermediate_path(spark, "landed")
    _table(spark, sf_dir, "events").select(text).write.text(f"{base}/raw/user_profiles/{DAY}=2024-01-01")
    written = silver.run_silver(spark, base, "hive")["user_interactions"]
    played = read_table(spark, written.path).select(
        F.lit("user_interactions").alias("part"), F.concat_ws("/", "steam_id", "app_id").alias("entity"), "playtime_minutes"
    )
    rejects = spark.read.schema("reason STRING, text STRING").json(written.rejects)
    return played.union(rejects.select("reason", F.regexp_extract("text", r"(\d+)", 1), F.lit(0).cast("bigint")))


@_register("""
    SELECT count(*) AS documents, count(*) FILTER (event_id % 10 = 0) AS corrupt, count(*) FILTER (event_id % 10 <> 0 AND event_id % 3 = 0) AS partial,
           count(*) FILTER (event_id % 10 <> 0 AND event_id % 7 = 0) AS unstamped
    FROM events
""")
def reject_counts_partial(spark, sf_dir):
    """Counts over lines of which some are not JSON, some have a field of another kind and some have no stamp."""
    stamp = F.when(F.col("event_id") % 7 == 0, "").otherwise(', "ingested_at": "2024-01-01T00:00:00"')
    games = F.when(F.col("event_id") % 3 == 0, '{"appid": 1}').otherwise("[]")
    line = F.format_string('{"steam_id": "%d", "games": %s%s}', "event_id", games, stamp)
    base = intermediate_path(spark, "landed")
    text = F.when(F.col("event_id") % 10 == 0, F.lit("{ not json")).otherwise(line)
    _table(spark, sf_dir, "events").select(text).write.text(f"{base}/raw/user_profiles/{DAY}=2024-01-01")
    return corrupt_report(scan_documents(spark, base, "user_profiles", schemas.USER_PROFILES_READ, layout="hive"))


@_register("""
    SELECT p_partkey::VARCHAR AS app_id, p_name AS game_name,
           CASE p_partkey % 4 WHEN 0 THEN p_type || ',' || p_brand WHEN 1 THEN p_brand WHEN 2 THEN '' ELSE p_type END AS genres,
           CASE WHEN p_partkey % 4 < 2 THEN p_brand ELSE p_type END AS categories
    FROM part
""")
def silver_metadata_mixed(spark, sf_dir):
    """Metadata whose nested arrays hold elements of other kinds: those go, their neighbours stay."""
    case = F.col("p_partkey") % 4
    kind, brand = (F.format_string('{"id": "1", "description": "%s"}', c) for c in ("p_type", "p_brand"))
    genres = (
        F.when(case == 0, F.format_string('["Action", %s, 7, %s]', kind, brand))
        .when(case == 1, F.format_string("[%s, [1, 2]]", brand))
        .when(case == 2, F.lit('["none", true]'))
        .otherwise(F.format_string("[%s]", kind))
    )
    categories = F.when(case < 2, F.format_string("[3.5, %s]", brand)).otherwise(F.format_string("[%s]", kind))
    line = F.format_string(
        '{"app_id": %d, "ingested_at": "2024-01-01T00:00:00", "metadata": {"name": "%s", "genres": %s, "categories": %s}}',
        "p_partkey", "p_name", genres, categories,
    )
    base = intermediate_path(spark, "landed")
    _table(spark, sf_dir, "part").select(line).write.text(f"{base}/raw/app_metadata/{DAY}=2024-01-01")
    docs = scan_documents(spark, base, "app_metadata", schemas.APP_METADATA_READ, layout="hive")
    flat = silver.silver_metadata(silver.typed_metadata(docs), (SOURCE,))
    return flat.select("app_id", "game_name", *[F.array_join(c, ",").alias(c) for c in ("genres", "categories")])


@_register("""
    SELECT 'user_profiles' AS dataset, count(*) AS documents, 0::BIGINT AS played, 4 AS fields FROM customer
    UNION ALL SELECT 'app_reviews', 0::BIGINT, 0::BIGINT, 4
""")
def scan_missing_dataset(spark, sf_dir):
    """One dataset that has landed and one that has not: typed columns and no rows, not an error."""
    base = intermediate_path(spark, "landed")
    line = F.format_string('{"steam_id": "%d", "games": []}', "c_custkey")
    _table(spark, sf_dir, "customer").select(line).write.text(f"{base}/raw/user_profiles/{DAY}=2024-01-01")
    found = []
    for dataset, schema, items in (
        ("user_profiles", "steam_id STRING, games ARRAY<STRUCT<appid: STRING>>", "games"),
        ("app_reviews", "app_id STRING, reviews ARRAY<STRUCT<review_id: STRING>>", "reviews"),
    ):
        docs = readable(scan_or_empty(spark, base, dataset, schema, layout="hive"))
        facts = docs.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.size(items).cast("bigint")), F.lit(0).cast("bigint")).alias("played"))
        found.append(facts.select(F.lit(dataset).alias("dataset"), "documents", "played", F.lit(len(docs.columns)).alias("fields")))
    return found[0].union(found[1])


FILES_PER_TASK = 100  # of documents that are landed one to a file


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, day, s_suppkey): two pretty-printed snapshots of every supplier, and a third of every other one on the first day."""
    copies = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1), F.lit(3)))
    rows = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.explode(copies).alias("copy"))
    text = F.format_string(
        '{\n  "steam_id": "%d",\n  "ingested_at": "2024-01-0%dT00:00:0%d",\n  "games": [\n    {"appid": %d, "playtime_forever": %d}\n  ]\n}',
        "s_suppkey", F.when(F.col("copy") == 3, 2).otherwise(1), "copy", "s_nationkey", "copy",
    )
    return rows.select(text.alias("text"), F.when(F.col("copy") == 3, "2024-01-02").otherwise("2024-01-01").alias("day"))


@_register("""
    SELECT 'before' AS state, s_suppkey::VARCHAR AS steam_id, s_nationkey::VARCHAR AS app_id, 3::BIGINT AS playtime_minutes, 2 * count(*) OVER () + count(*) FILTER (s_suppkey % 2 = 0) OVER () AS documents FROM supplier
    UNION ALL SELECT 'after', s_suppkey::VARCHAR, s_nationkey::VARCHAR, 3::BIGINT, 2 * count(*) OVER () FROM supplier
""")
def compacted_documents(spark, sf_dir):
    """One file per document on two days, packed into lines by day: the same silver rows from fewer documents."""
    base, out = intermediate_path(spark, "landed"), intermediate_path(spark, "packed")
    snapshots = materialize(_snapshots(spark, sf_dir), "snapshots")
    # A file costs the same however short its text is, so tasks are cut by their number of files, and each moves its own into place.
    tasks = -(-snapshots.count() // FILES_PER_TASK)
    for day in ("2024-01-01", "2024-01-02"):
        files = snapshots.where(F.col("day") == day).repartition(max(1, tasks)).select("text").write.option("maxRecordsPerFile", 1)
        files.option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(f"{base}/raw/user_profiles/{day}")
    compact_documents(spark, base, "user_profiles", "steam_id", out, files="*.txt")
    states = []
    for state, root, layout in (("before", base, "dated"), ("after", out, "hive")):
        docs = scan_documents(spark, root, "user_profiles", schemas.USER_PROFILES_READ, layout, files="*.txt")
        rows = silver.silver_interactions(silver.typed_profiles(docs), (SOURCE,))
        states.append(rows.select(F.lit(state).alias("state"), "*", F.lit(docs.count()).alias("documents")))
    return states[0].union(states[1])


@_register("""
    SELECT o_orderkey::VARCHAR AS steam_id, CASE WHEN o_orderkey % 3 = 0 THEN '2024-01-01T00:00:02' ELSE '2024-01-01T00:00:01' END AS ingested_at,
           o_custkey AS appid, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS playtime_forever
    FROM orders WHERE o_custkey % 2 = 0
    UNION ALL SELECT 'stored', NULL, count(*) FILTER (o_custkey % 2 = 0), (count(*) FILTER (o_custkey % 2 = 0 AND o_orderkey % 3 = 0))::BIGINT FROM orders
""")
def rewritten_documents(spark, sf_dir):
    """A day that a rerun has appended to, rewritten to the latest document per key; the last row counts stored and replaced ones."""
    base = intermediate_path(spark, "landed")
    orders = _table(spark, sf_dir, "orders").where("o_custkey % 2 = 0")
    for run, rows in ((1, orders), (2, orders.where("o_orderkey % 3 = 0"))):
        games = F.array(_struct(appid=F.col("o_custkey"), playtime_forever=F.lit(run).cast("bigint")))
        stamp = F.lit(f"2024-01-01T00:00:0{run}").alias("ingested_at")
        write_documents(rows.select(stamp, _text("o_orderkey").alias("steam_id"), games.alias("games")), base, "user_profiles")
    landed = scan_documents(spark, base, "user_profiles", schemas.USER_PROFILES, layout="hive").count()
    rewrite_documents(spark, base, "user_profiles", "steam_id", day="2024-01-01")
    docs = scan_documents(spark, base, "user_profiles", schemas.USER_PROFILES, layout="hive")
    stored = docs.count()
    rows = explode_items(readable(docs), "games", {"appid": "appid", "playtime_forever": "playtime_forever"}, carry=("steam_id", "ingested_at"))
    facts = spark.createDataFrame([("stored", None, stored, landed - stored)], "steam_id STRING, ingested_at STRING, appid BIGINT, playtime_forever BIGINT")
    return rows.union(facts)


@_register("""
    WITH m AS (""" + ORACLES["interaction_matrix"] + """)
    SELECT count(DISTINCT user_index) AS users, count(DISTINCT user_index) * least(5, count(DISTINCT item_index)) AS listed, 0::BIGINT AS different,
           'second' AS run_id
    FROM m
""")
def stored_model(spark, sf_dir):
    """Factors that were trained, saved and loaded serve the same lists; the newest published bundle is the one that serves."""
    tables = _gold(spark, sf_dir)
    model = train_and_evaluate(materialize(tables.matrix, "matrix"), AlsSettings(rank=4, max_iter=2, num_blocks=4), train_percent=100).model
    base = intermediate_path(spark, "store")
    bundles = [ModelBundle.of_model(run, model, tables.users, tables.items) for run in ("first", "second")]
    for bundle in bundles:
        save_bundle(bundle, base)
    loaded = load_bundle(spark, base)
    asked = tables.users.frame.select(F.col("label").alias("steam_id"))
    metadata = _table(spark, sf_dir, "part").select(_text("p_partkey").alias("app_id"), F.col("p_name").alias("game_name"), F.array("p_type").alias("genres"))
    lists = [materialize(recommend_topk(b, asked, metadata, k=5, ordered=False), "lists") for b in (bundles[1], loaded)]
    different = lists[0].exceptAll(lists[1]).union(lists[1].exceptAll(lists[0])).count()
    facts = lists[1].agg(F.countDistinct("steam_id").alias("users"), F.count(F.lit(1)).alias("listed"))
    return facts.select("*", F.lit(different).cast("bigint").alias("different"), F.lit(loaded.run_id).alias("run_id"))
