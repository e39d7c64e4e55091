"""Raw API payloads (JSON text) to bronze documents.

Input rows are (id, payload text). Nothing is fetched here: a payload table is whatever a crawler landed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge import schemas
from tasteforge.functions.parsing import flag, lenient_double, or_empty, truthy, utc_stamp, whole_number
from tasteforge.operators.nested import compute_once, map_rows
from tasteforge.sources.documents import write_documents


def _stamp(ingested_at: Column | None) -> Column:
    return (utc_stamp() if ingested_at is None else ingested_at).alias("ingested_at")


def _or_zero(text: Column) -> Column:
    """A missing count is 0; a present one is converted, and NULL if it is no number."""
    return F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(whole_number(text))


def shape_libraries(
    raw: DataFrame, id_col: str = "steam_id", payload: str = "payload", ingested_at: Column | None = None
) -> DataFrame:
    """Owned-items payloads to user profiles; private and empty libraries are dropped."""
    response = F.from_json(payload, schemas.LIBRARY_PAYLOAD).getField("response")
    parsed = compute_once(raw, response, "response", lambda r: F.size(r["games"]) > 0)
    games = F.transform(
        "response.games",
        lambda g: F.struct(
            whole_number(g["appid"]).alias("appid"), _or_zero(g["playtime_forever"]).alias("playtime_forever")
        ),
    )
    return parsed.select(
        _stamp(ingested_at),
        F.col(id_col).cast("string").alias("steam_id"),
        F.size("response.games").cast("bigint").alias("game_count"),
        games.alias("games"),
    )


def shape_friends(raw: DataFrame, id_col: str = "steam_id", payload: str = "payload") -> DataFrame:
    """Friend-list payloads to an array of ids; a payload without a list gives an empty array."""
    friends = F.from_json(payload, schemas.FRIENDS_PAYLOAD).getField("friendslist").getField("friends")
    ids = F.transform(friends, lambda f: f["steamid"])
    return raw.select(F.col(id_col).cast("string").alias("steam_id"), or_empty(ids, "ARRAY<STRING>").alias("friends"))


def shape_metadata(
    raw: DataFrame, id_col: str = "app_id", payload: str = "payload", ingested_at: Column | None = None
) -> DataFrame:
    """App-details envelopes, keyed by app id, to metadata documents; unsuccessful ones are dropped."""
    app_id = F.col(id_col).cast("string")
    envelope = F.try_element_at(F.from_json(payload, schemas.METADATA_PAYLOAD), app_id)
    opened = compute_once(raw, envelope, "envelope", lambda e: e["success"])
    data = F.col("envelope.data")
    fields = [or_empty(data.getField(name), ddl).alias(name) for name, ddl in schemas.METADATA_FIELDS.items()]
    return opened.select(_stamp(ingested_at), app_id.alias("app_id"), F.struct(*fields).alias("metadata"))


def shape_reviews(
    raw: DataFrame,
    id_col: str = "app_id",
    payload: str = "payload",
    language: str = "english",
    ingested_at: Column | None = None,
) -> DataFrame:
    """Review payloads to review documents in one language.

    Payloads without success or reviews are dropped; a payload whose reviews are all in another
    language still gives a document, with an empty array.
    """
    answer = F.from_json(payload, schemas.REVIEWS_PAYLOAD)
    parsed = compute_once(raw, answer, "answer", lambda a: truthy(a["success"]) & (F.size(a["reviews"]) > 0))
    wanted = F.filter("answer.reviews", lambda r: r["language"] == language)
    reviews = F.transform(
        wanted,
        lambda r: F.struct(
            r["recommendationid"].alias("review_id"),
            r["author"]["steamid"].alias("steam_id"),
            _or_zero(r["author"]["playtime_at_review"]).alias("playtime_minutes"),
            flag(r["voted_up"]).alias("voted_up"),
            whole_number(r["votes_up"]).alias("votes_up"),
            lenient_double(r["weighted_vote_score"]).alias("weighted_score"),
            flag(r["steam_purchase"]).alias("steam_purchase"),
            r["review"].alias("review_text"),
        ),
    )
    shaped = parsed.select(
        _stamp(ingested_at), F.col(id_col).cast("string").alias("app_id"), reviews.alias("reviews")
    )
    return shaped.select("ingested_at", "app_id", F.size("reviews").cast("bigint").alias("review_count"), "reviews")


def shape_catalogue(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Catalogue listings, a JSON object of items, to rows of (appid, ccu)."""
    listing = raw.select(F.from_json(payload, schemas.CATALOGUE_PAYLOAD).alias("items"))
    return map_rows(listing, "items", {"appid": "appid", "ccu": "ccu"})


#: Payload tables that a crawler lands, and the documents they become: table -> (dataset, shaping).
PAYLOADS = {
    "library_payloads": ("user_profiles", shape_libraries),
    "metadata_payloads": ("app_metadata", shape_metadata),
    "review_payloads": ("app_reviews", shape_reviews),
}


def run_bronze(spark: SparkSession, base_path: str) -> list[str]:
    """Shape every landed payload table, ``{base}/payloads/{table}`` of (id, payload), into documents of today.

    Returns the datasets written. A table that has not landed is skipped. The documents are appended under their day; a
    rerun lands newer snapshots, which latest-per-key prefers.
    """
    written = []
    for table, (dataset, shape) in PAYLOADS.items():
        try:
            raw = spark.read.parquet(f"{base_path.rstrip('/')}/payloads/{table}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        write_documents(shape(raw, id_col="id"), base_path, dataset)
        written.append(dataset)
    return written
