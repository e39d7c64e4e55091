"""Hold-out splits and the hold-out error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(keys: Sequence[str], seed: int | None = None) -> Column:
    """A percentile 0..99 that depends on the key values only."""
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def hash_split(
    df: DataFrame, keys: Sequence[str], train_percent: int = 80, seed: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key hash: no shuffle, and the same rows whatever the file layout.

    Rows are disjoint and complete even when a task is rerun elsewhere, and copies of a key never
    fall on both sides.
    """
    bucket = hash_bucket(keys, seed)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def random_split(df: DataFrame, train_percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own seeded split. It depends on the partition layout, so give it a stored table."""
    train, test = df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed=seed)
    return train, test


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: the root of the mean squared difference."""
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))
