"""Which ids to collect next."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge import schemas
from tasteforge.functions.parsing import present
from tasteforge.operators.nested import explode_items
from tasteforge.operators.topn import distinct_ids, first_n, list_sizes, top_n, union_ids
from tasteforge.plans.bronze import shape_catalogue
from tasteforge.plans.silver import typed_profiles, typed_reviews
from tasteforge.sources.documents import scan_documents
from tasteforge.sources.tables import table_path, write_table

# How long each seed list is, and how many ids a harvest takes.
TOP_GLOBAL = 500
TOP_TAGGED = 200
HARVEST_LIMIT = 5
PROFILE_QUOTA = 100


@dataclass(frozen=True)
class SeedLists:
    popular: DataFrame
    tagged: DataFrame
    combined: DataFrame

    def sizes(self) -> DataFrame:
        return list_sizes({"popular": self.popular, "tagged": self.tagged, "combined": self.combined})


def seed_worklist(
    catalogue: DataFrame, tagged_catalogue: DataFrame, n: int = TOP_GLOBAL, n_tagged: int = TOP_TAGGED
) -> SeedLists:
    """The most used items, the most used of a tag, and their union, each as ids in text."""

    def ids(listing: DataFrame, limit: int) -> DataFrame:
        best = top_n(listing.where(F.col("appid").isNotNull()), limit, "ccu", "appid")
        return best.select(F.col("appid").cast("string").alias("app_id"))

    popular, tagged = ids(catalogue, n), ids(tagged_catalogue, n_tagged)
    return SeedLists(popular, tagged, union_ids(popular, tagged))


def items_in_libraries(profiles: DataFrame) -> DataFrame:
    """Distinct item ids in the given profiles."""
    return distinct_ids(explode_items(profiles, "games", {"appid": "appid"}), "appid", "app_id")


def users_in_reviews(reviews: DataFrame) -> DataFrame:
    """Distinct reviewer ids in the given review documents."""
    return distinct_ids(explode_items(reviews, "reviews", {"steam_id": "steam_id"}), "steam_id", "steam_id")


def harvest(profiles: DataFrame, limit: int = HARVEST_LIMIT) -> DataFrame:
    """The first item ids to collect."""
    return first_n(items_in_libraries(profiles), limit, "app_id")


def quota(profiles: DataFrame, target: int = PROFILE_QUOTA) -> DataFrame:
    """The first users, up to ``target``, whose profile is public."""
    public = present(F.col("steam_id")) & (F.size("games") > 0)
    return first_n(profiles.where(public).select("steam_id").distinct(), target, "steam_id")


def run_worklists(spark: SparkSession, base_path: str, day: str, layout: str = "hive") -> dict[str, str]:
    """Write the lists of what to collect next to ``gold/worklist_*``; returns where, without those that have no input.

    ``seeds`` from the catalogue payloads (``popular`` and ``tagged``), ``reviewers`` from all reviews, ``harvest`` and
    ``quota`` from the profiles of ``day`` only.
    """
    lists: dict[str, DataFrame] = {}
    catalogues = [_catalogue(spark, base_path, name) for name in ("popular", "tagged")]
    if all(c is not None for c in catalogues):
        lists["seeds"] = seed_worklist(*catalogues).combined
    reviews = scan_documents(spark, base_path, "app_reviews", schemas.APP_REVIEWS_READ, layout)
    if reviews is not None:
        lists["reviewers"] = users_in_reviews(typed_reviews(reviews))
    profiles = scan_documents(spark, base_path, "user_profiles", schemas.USER_PROFILES_READ, layout, day)
    if profiles is not None:
        typed = typed_profiles(profiles)
        lists["harvest"], lists["quota"] = harvest(typed), quota(typed)
    written = {}
    for name, rows in lists.items():
        written[name] = table_path(base_path, f"worklist_{name}")
        write_table(rows, written[name])
    return written


def _catalogue(spark: SparkSession, base_path: str, name: str) -> DataFrame | None:
    try:
        return shape_catalogue(spark.read.parquet(f"{base_path.rstrip('/')}/payloads/catalogue_{name}"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
