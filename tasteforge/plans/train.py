"""Training and hold-out evaluation."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge import schemas
from tasteforge.operators.dictionary import load_dictionary
from tasteforge.operators.factors import AlsSettings, als_blocks, fit_als, predict, set_blocks
from tasteforge.operators.splits import hash_split, random_split, rmse
from tasteforge.sources.bundle import ModelBundle, load_bundle, save_bundle
from tasteforge.sources.tables import read_table, table_path


@dataclass(frozen=True)
class Trained:
    model: ALSModel
    error: DataFrame
    train: DataFrame
    test: DataFrame
    num_blocks: int


def train_and_evaluate(
    matrix: DataFrame, settings: AlsSettings = AlsSettings(), split: str = "hash", train_percent: int = 80
) -> Trained:
    """Fit on the training share and relate the hold-out error (runs the fit; the error is lazy).

    ``matrix`` should be a stored table. The hash split holds whatever its file layout;
    "random" is Spark's own seeded split.
    """
    if split == "hash":
        train, test = hash_split(matrix, ["user_index", "item_index"], train_percent)
    else:
        train, test = random_split(matrix, train_percent)
    n_ratings = train.count()
    model = fit_als(train, settings, n_ratings=n_ratings)
    error = rmse(predict(model, test), "interaction_score", "prediction")
    # The manifest tells what the start factors depended on.
    blocks = set_blocks(settings.num_blocks, n_ratings) if settings.num_blocks else als_blocks(n_ratings)
    return Trained(model, error, train, test, blocks)


def run_training(
    spark: SparkSession,
    base_path: str,
    run_id: str | None = None,
    settings: AlsSettings = AlsSettings(),
    split: str = "hash",
) -> ModelBundle:
    """Train on the gold matrix and save model and dictionaries as one bundle; returns it as stored."""
    matrix = read_table(spark, table_path(base_path, "ml_interaction_matrix"), schemas.GOLD_MATRIX)
    users = load_dictionary(spark, table_path(base_path, "user_dictionary"))
    items = load_dictionary(spark, table_path(base_path, "item_dictionary"))
    last = matrix.agg(F.max("user_index").alias("user"), F.max("item_index").alias("item")).first()
    if last["user"] is None or last["user"] >= users.size or last["item"] >= items.size:
        raise ValueError("the matrix is empty or was not numbered by the stored dictionaries; run gold again")
    trained = train_and_evaluate(matrix, settings, split)
    bundle = ModelBundle.of_model(
        run_id or uuid.uuid4().hex, trained.model, users, items, trained.error.first()["rmse"], trained.num_blocks
    )
    save_bundle(bundle, base_path)
    return load_bundle(spark, base_path, bundle.run_id)
