"""Columnar tables (silver and gold) under one base path, local or on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Where each table lives under the base path.
TABLES = {
    "user_interactions": "silver/user_interactions.parquet",
    "app_metadata": "silver/app_metadata.parquet",
    "app_reviews": "silver/app_reviews.parquet",
    "ml_interaction_matrix": "gold/ml_interaction_matrix.parquet",
    "user_dictionary": "gold/user_dictionary.parquet",
    "item_dictionary": "gold/item_dictionary.parquet",
}
# Our own: where the lists of what to collect next go.
TABLES |= {f"worklist_{name}": f"gold/worklist_{name}.parquet" for name in ("seeds", "reviewers", "harvest", "quota")}


def table_path(base_path: str, table: str) -> str:
    return f"{base_path.rstrip('/')}/{TABLES[table]}"


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite the table, or, when partitioned, only the partitions that ``df`` holds."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
