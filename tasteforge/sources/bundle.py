"""Model bundles: the factors and both dictionaries of one training run.

A bundle's parts are written to a fresh folder of their own, which nobody reads yet. It is published by one commit record,
a single appended file that names the folder. Until that file is there, readers are served the bundle published before, so
a crash between parts, or a second run under the same id, never leaves a mixture. Parts whose sizes differ from the record
are refused.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tasteforge.functions.parsing import utc_stamp
from tasteforge.operators.dictionary import IdDictionary, load_dictionary, save_dictionary

MANIFEST = (
    "run_id STRING, created_at STRING, rank INT, users BIGINT, items BIGINT, rmse DOUBLE, num_blocks INT, folder STRING, fitted BOOLEAN"
)
FACTORS = "id BIGINT, features ARRAY<DOUBLE>"


@dataclass(frozen=True)
class ModelBundle:
    """Factor frames (id, features) and dictionaries. ``als`` is there if the factors come from a fitted model."""

    run_id: str
    user_factors: DataFrame
    item_factors: DataFrame
    rank: int
    users: IdDictionary
    items: IdDictionary
    rmse: float | None = None
    num_blocks: int | None = None
    als: ALSModel | None = None

    @classmethod
    def of_model(
        cls, run_id: str, als: ALSModel, users: IdDictionary, items: IdDictionary, rmse: float | None = None, num_blocks: int | None = None
    ) -> ModelBundle:
        return cls(run_id, als.userFactors, als.itemFactors, als.rank, users, items, rmse, num_blocks, als)


def _root(base_path: str) -> str:
    return f"{base_path.rstrip('/')}/models"


def save_bundle(bundle: ModelBundle, base_path: str) -> str:
    """Write the parts, then publish them; returns their folder."""
    spark = bundle.users.frame.sparkSession
    name = f"{bundle.run_id}/{uuid.uuid4().hex}"
    folder = f"{_root(base_path)}/parts/{name}"
    if bundle.als is not None:
        bundle.als.write().save(f"{folder}/als")
    else:
        for side, factors in (("user", bundle.user_factors), ("item", bundle.item_factors)):
            factors.selectExpr("cast(id AS BIGINT) AS id", "cast(features AS ARRAY<DOUBLE>) AS features").write.parquet(f"{folder}/{side}-factors")
    save_dictionary(bundle.users, f"{folder}/users")
    save_dictionary(bundle.items, f"{folder}/items")
    row = (bundle.run_id, None, bundle.rank, bundle.users.size, bundle.items.size, bundle.rmse, bundle.num_blocks, name, bundle.als is not None)
    record = spark.createDataFrame([row], MANIFEST).withColumn("created_at", utc_stamp())
    record.coalesce(1).write.mode("append").json(f"{_root(base_path)}/commits")
    return folder


def list_bundles(spark: SparkSession, base_path: str) -> DataFrame:
    """The newest commit record of every run, newest first."""
    try:
        records = spark.read.schema(MANIFEST).json(f"{_root(base_path)}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        records = spark.createDataFrame([], MANIFEST)
    newest = Window.partitionBy("run_id").orderBy(F.col("created_at").desc(), F.col("folder").desc())
    current = records.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")
    return current.orderBy(F.col("created_at").desc(), F.col("run_id").desc())


def load_bundle(spark: SparkSession, base_path: str, run_id: str | None = None) -> ModelBundle:
    """The published bundle of ``run_id``, or the newest one."""
    manifests = list_bundles(spark, base_path)
    manifest = (manifests if run_id is None else manifests.where(F.col("run_id") == run_id)).first()
    if manifest is None:
        raise ValueError(f"no complete model bundle for run {run_id!r}")
    folder = f"{_root(base_path)}/parts/{manifest['folder']}"
    users = load_dictionary(spark, f"{folder}/users")
    items = load_dictionary(spark, f"{folder}/items")
    als = ALSModel.load(f"{folder}/als") if manifest["fitted"] else None
    rank = als.rank if als else manifest["rank"]
    if (rank, users.size, items.size) != (manifest["rank"], manifest["users"], manifest["items"]):
        raise ValueError(f"the parts of bundle {manifest['run_id']!r} come from different runs")
    if als is not None:
        return ModelBundle.of_model(manifest["run_id"], als, users, items, manifest["rmse"], manifest["num_blocks"])
    factors = [spark.read.schema(FACTORS).parquet(f"{folder}/{side}-factors") for side in ("user", "item")]
    return ModelBundle(manifest["run_id"], *factors, rank, users, items, manifest["rmse"], manifest["num_blocks"])
