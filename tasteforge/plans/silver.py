"""Bronze documents to silver tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge import schemas
from tasteforge.functions.parsing import flag, id_token, lenient_double, whole_number
from tasteforge.functions.text import clean_text, long_enough
from tasteforge.operators.latest import latest_per_key
from tasteforge.operators.nested import explode_items, pick_fields
from tasteforge.sources.documents import (
    OUTCOME,
    SOURCE,
    compact_documents,
    document_counts,
    readable,
    rejected,
    rescue,
    rewrite_documents,
    scan_documents,
    store_outcomes,
)
from tasteforge.sources.tables import table_path, write_table


def silver_interactions(profiles: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """(steam_id, app_id, playtime_minutes) of each user's latest profile, played items only."""
    # Unplayed items go before the shuffle that finds the latest profile, not after it.
    played = profiles.withColumn("games", F.filter("games", lambda game: game["playtime_forever"] > 0))
    latest = latest_per_key(played, ["steam_id"], "ingested_at", tie_breakers)
    fields = {"app_id": "appid", "playtime_minutes": "playtime_forever"}
    rows = explode_items(latest, "games", fields, carry=("steam_id",))
    # Item ids are text everywhere after this point, as they are in reviews and metadata.
    return rows.withColumn("app_id", F.col("app_id").cast("string"))


def silver_metadata(metadata: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The latest metadata of each app, flattened."""
    latest = latest_per_key(metadata, ["app_id"], "ingested_at", tie_breakers)
    return pick_fields(
        latest,
        {
            "app_id": "app_id",
            "game_name": "metadata.name",
            "is_free": "metadata.is_free",
            "price_formatted": "metadata.price_overview.final_formatted",
            "release_date": "metadata.release_date.date",
            "metacritic_score": "metadata.metacritic.score",
            "genres": "metadata.genres.description",
            "categories": "metadata.categories.description",
        },
    )


def silver_reviews(
    reviews: DataFrame, tie_breakers: Sequence[str] = (), keys: Sequence[str] = ("app_id",)
) -> DataFrame:
    """The reviews in each app's latest document, with clean texts; too short texts are dropped.

    A review that falls to the length filter takes its vote with it.
    """
    latest = latest_per_key(reviews, keys, "ingested_at", tie_breakers)
    # Cleaned and filtered inside the array: once per text, and no row for a text that falls.
    cleaned = latest.withColumn(
        "reviews", F.transform("reviews", lambda r: r.withField("review_text", clean_text(r["review_text"])))
    )
    return explode_items(
        cleaned,
        "reviews",
        {c: c for c in ("review_id", "steam_id", "playtime_minutes", "voted_up", "weighted_score", "review_text")},
        keep=lambda r: long_enough(r["review_text"]),
        carry=("app_id",),
    )


def typed_profiles(docs: DataFrame) -> DataFrame:
    """Profiles as scanned, their values typed; an item without a usable id or playtime is dropped, its profile kept."""
    docs = readable(rescue(docs, schemas.USER_PROFILES_READ))
    items = F.transform(
        "games",
        lambda g: F.struct(id_token(g["appid"]).alias("appid"), whole_number(g["playtime_forever"]).alias("playtime_forever")),
    )
    usable = F.filter(items, lambda g: g["appid"].isNotNull() & g["playtime_forever"].isNotNull())
    return docs.withColumns({"steam_id": id_token(F.col("steam_id")), "games": usable})


def typed_metadata(docs: DataFrame) -> DataFrame:
    """Metadata as scanned, its values typed; a genre or category of another kind is dropped, the others kept."""
    docs = readable(rescue(docs, schemas.APP_METADATA_READ))
    score = whole_number(F.col("metadata.metacritic.score"))
    metadata = (
        F.col("metadata")
        .withField("is_free", flag(F.col("metadata.is_free")))
        .withField("metacritic", F.struct(score.alias("score")))
    )
    return docs.withColumns({"app_id": id_token(F.col("app_id")), "metadata": metadata})


def typed_reviews(docs: DataFrame) -> DataFrame:
    """Reviews as scanned, their values typed; a value that cannot be read is NULL, its review kept."""
    docs = readable(rescue(docs, schemas.APP_REVIEWS_READ))
    reviews = F.transform(
        "reviews",
        lambda r: F.struct(
            r["review_id"].alias("review_id"),
            id_token(r["steam_id"]).alias("steam_id"),
            whole_number(r["playtime_minutes"]).alias("playtime_minutes"),
            flag(r["voted_up"]).alias("voted_up"),
            lenient_double(r["weighted_score"]).alias("weighted_score"),
            r["review_text"].alias("review_text"),
        ),
    )
    return docs.withColumns({"app_id": id_token(F.col("app_id")), "reviews": reviews})


#: The field of a document that names its entity.
KEYS = {"user_profiles": "steam_id", "app_metadata": "app_id", "app_reviews": "app_id"}

_JOBS = {
    "user_profiles": ("user_interactions", schemas.USER_PROFILES_READ, typed_profiles, silver_interactions),
    "app_metadata": ("app_metadata", schemas.APP_METADATA_READ, typed_metadata, silver_metadata),
    "app_reviews": ("app_reviews", schemas.APP_REVIEWS_READ, typed_reviews, silver_reviews),
}


@dataclass(frozen=True)
class SilverTable:
    """Where a silver table was written, and what its documents were like."""

    path: str
    documents: int
    corrupt: int
    partial: int
    unstamped: int
    rejects: str | None = field(default=None)

    def __str__(self) -> str:
        counts = f"{self.documents} documents, {self.corrupt} not JSON, {self.partial} read in part, {self.unstamped} without stamp"
        return f"{self.path} ({counts}{'; see ' + self.rejects if self.rejects else ''})"


def run_silver(spark: SparkSession, base_path: str, layout: str = "dated") -> dict[str, SilverTable | None]:
    """Write all three silver tables; returns what was written, with None for a dataset that has not landed.

    Each dataset is parsed once, into stored documents by outcome: the table is made from what could be read, and
    documents that were lost or read in part are written, with the reason, to ``rejects/{dataset}``.
    """
    written: dict[str, SilverTable | None] = {}
    for dataset, (table, schema, typed, job) in _JOBS.items():
        documents = scan_documents(spark, base_path, dataset, schema, layout)
        if documents is None:
            written[table] = None
            continue
        path, rejects = table_path(base_path, table), None
        stored, counts = store_outcomes(documents, *document_counts(documents))
        write_table(job(typed(stored.where(F.col(OUTCOME) != "lost").drop(OUTCOME)), tie_breakers=(SOURCE,)), path)
        if counts["corrupt"] + counts["partial"]:
            rejects = f"{base_path.rstrip('/')}/rejects/{dataset}"
            flagged = rejected(stored.where(F.col(OUTCOME) != "whole").drop(OUTCOME))
            flagged.write.mode("overwrite").json(rejects)
        written[table] = SilverTable(path, **counts, rejects=rejects)
    return written


def run_compaction(spark: SparkSession, base_path: str, out_base: str, day: str | None = None) -> list[str]:
    """Pack all landed datasets into the hive layout under ``out_base``; returns those that were there.

    The silver tables of ``out_base`` equal those of ``base_path``.
    """
    return [dataset for dataset, key in KEYS.items() if compact_documents(spark, base_path, dataset, key, out_base, day)]


def run_rewrite(spark: SparkSession, base_path: str, day: str | None = None) -> list[str]:
    """Rewrite the hive layout of all datasets, or one day of it, to the latest document per key; returns those that were there."""
    return [dataset for dataset, key in KEYS.items() if rewrite_documents(spark, base_path, dataset, key, day)]
