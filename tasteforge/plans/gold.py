"""Silver tables to the interaction matrix and its id dictionaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge import schemas
from tasteforge.functions.scoring import hybrid_score
from tasteforge.operators.dictionary import (
    BROADCAST_ROWS,
    IdDictionary,
    fit_dictionary,
    load_dictionary,
    save_dictionary,
)
from tasteforge.operators.joins import left_join_feedback, one_per_key
from tasteforge.session import materialize
from tasteforge.sources.tables import read_table, table_path, write_table

MAX_INDEX = 2**31 - 1


@dataclass(frozen=True)
class GoldTables:
    matrix: DataFrame
    users: IdDictionary
    items: IdDictionary


def score_interactions(interactions: DataFrame, reviews: DataFrame) -> DataFrame:
    """(steam_id, app_id, interaction_score): engagement weighted by the user's own review, if any."""
    joined = left_join_feedback(interactions, reviews)
    score = hybrid_score(F.col("playtime_minutes"), F.col("voted_up"))
    return joined.select("steam_id", "app_id", score.alias("interaction_score"))


def interaction_matrix(
    scored: DataFrame,
    user_col: str = "steam_id",
    item_col: str = "app_id",
    score_col: str = "interaction_score",
    broadcast_rows: int = BROADCAST_ROWS,
) -> GoldTables:
    """Number users and items, then express the scores in those numbers (runs the fitting jobs).

    ``scored`` is stored first, as three narrow columns: both fits and the encoding read that
    table instead of repeating the join behind it.
    """
    stored = materialize(scored.select(user_col, item_col, score_col), "scored")
    # Rows that lose their user have no say in the item frequencies either.
    users = fit_dictionary(stored, user_col)
    items = fit_dictionary(stored.where(F.col(user_col).isNotNull()), item_col)
    if max(users.size, items.size) > MAX_INDEX:
        raise ValueError("more ids than an integer index can number")
    # What later steps do not need leaves before the next lookup stores or shuffles it.
    by_item = items.encode(stored, item_col, "item_index", broadcast_rows, stored=True)
    by_item = by_item.select(user_col, F.col("item_index").cast("int"), F.col(score_col).cast("float"))
    encoded = users.encode(by_item, user_col, "user_index", broadcast_rows)
    matrix = encoded.select(
        F.col("user_index").cast("int"), F.col("item_index").cast("int"), F.col(score_col).cast("float")
    )
    return GoldTables(matrix, users, items)


def run_gold(spark: SparkSession, base_path: str, one_review: bool = False) -> GoldTables:
    """Write the matrix and both dictionaries; returns them as stored.

    ``one_review`` keeps one review per user and item; otherwise several of them multiply the
    interaction.
    """
    interactions = read_table(spark, table_path(base_path, "user_interactions"), schemas.SILVER_INTERACTIONS)
    reviews = read_table(spark, table_path(base_path, "app_reviews"), schemas.SILVER_REVIEWS)
    if one_review:
        reviews = materialize(one_per_key(reviews), "one-review")
    gold = interaction_matrix(score_interactions(interactions, reviews))
    write_table(gold.matrix, table_path(base_path, "ml_interaction_matrix"))
    save_dictionary(gold.users, table_path(base_path, "user_dictionary"))
    save_dictionary(gold.items, table_path(base_path, "item_dictionary"))
    return GoldTables(
        read_table(spark, table_path(base_path, "ml_interaction_matrix"), schemas.GOLD_MATRIX),
        load_dictionary(spark, table_path(base_path, "user_dictionary")),
        load_dictionary(spark, table_path(base_path, "item_dictionary")),
    )
