"""Serving: top-k lists for any number of users, with names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge.operators.factors import factor_topk
from tasteforge.operators.joins import enrich
from tasteforge.session import materialize
from tasteforge.sources.bundle import ModelBundle, load_bundle
from tasteforge.sources.tables import read_table, table_path, write_table


def users_frame(spark: SparkSession, user_ids: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(u,) for u in user_ids], "steam_id STRING")


def recommend_topk(
    bundle: ModelBundle, asked: DataFrame, metadata: DataFrame, k: int = 5, ordered: bool = True
) -> DataFrame:
    """(steam_id, app_id, game_name, genres, predicted_affinity_score, rank) for each asked user (runs jobs).

    Users without factors have no rows; ``unserved_users`` tells why. ``ordered`` sorts the
    whole result by score, which a large batch will want to leave out.
    """
    wanted = bundle.users.encode(asked.select("steam_id").distinct(), "steam_id", "id")
    # Stored, because it is counted, scored and joined back for the names.
    users = materialize(bundle.user_factors.join(wanted, "id"), "asked")
    lists = factor_topk(users.select("id", "features"), bundle.item_factors, k, bundle.rank)
    named = lists.join(users.select(F.col("id").alias("user"), "steam_id"), "user")
    decoded = bundle.items.decode(named, "item", "app_id")
    full = enrich(decoded, metadata.select("app_id", "game_name", "genres"))
    result = full.select(
        "steam_id",
        "app_id",
        "game_name",
        "genres",
        F.col("score").cast("float").alias("predicted_affinity_score"),
        "rank",
    )
    if ordered:
        result = result.orderBy(F.col("predicted_affinity_score").desc(), "steam_id", "rank")
    return result


def unserved_users(bundle: ModelBundle, asked: DataFrame) -> DataFrame:
    """(steam_id, reason) for asked users who get no list: never seen, or held out of training."""
    ids = asked.select("steam_id").distinct()
    seen = bundle.users.encode(ids, "steam_id", "id")
    unknown = ids.join(seen.select("steam_id"), "steam_id", "left_anti")
    held_out = seen.join(bundle.user_factors.select("id"), "id", "left_anti").select("steam_id")
    return unknown.withColumn("reason", F.lit("unknown")).unionByName(
        held_out.withColumn("reason", F.lit("no factors"))
    )


def run_recommend(
    spark: SparkSession, base_path: str, user_ids: Sequence[str], k: int = 5, run_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Lists for the given users and the users left without one."""
    bundle = load_bundle(spark, base_path, run_id)
    asked = users_frame(spark, user_ids)
    metadata = read_table(spark, table_path(base_path, "app_metadata"))
    return recommend_topk(bundle, asked, metadata, k), unserved_users(bundle, asked)


def run_recommend_batch(
    spark: SparkSession, base_path: str, users_path: str, out_path: str, k: int = 5, run_id: str | None = None
) -> tuple[str, str]:
    """Lists for a Parquet table of users (steam_id), written to ``out_path``/lists; those without one to /unserved."""
    bundle = load_bundle(spark, base_path, run_id)
    asked = spark.read.parquet(users_path).select(F.col("steam_id").cast("string").alias("steam_id"))
    metadata = read_table(spark, table_path(base_path, "app_metadata"))
    out = out_path.rstrip("/")
    write_table(recommend_topk(bundle, asked, metadata, k, ordered=False), f"{out}/lists")
    write_table(unserved_users(bundle, asked), f"{out}/unserved")
    return f"{out}/lists", f"{out}/unserved"
