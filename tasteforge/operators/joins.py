"""Joins of interactions, feedback, recommendations and metadata.

None of them is hinted: Spark broadcasts a side only when its size is known to be small (AQE checks
the real size at run time) and otherwise sorts and merges, splitting skewed partitions. The sides
of each join are bare exchanges so that the skew split applies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_text(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join keys as text, so that 400 meets "400" and a non-numeric id cannot fail the query."""
    casts = {k: F.col(k).cast("string") for k in keys if df.schema[k].dataType.typeName() != "string"}
    return df.withColumns(casts) if casts else df


def left_join_feedback(
    interactions: DataFrame,
    feedback: DataFrame,
    keys: Sequence[str] = ("steam_id", "app_id"),
    columns: Sequence[str] = ("voted_up",),
) -> DataFrame:
    """Every interaction, with the feedback for the same keys or NULL.

    Several reviews for one key give several rows, as a join does; see ``one_per_key``.
    """
    right = _as_text(feedback.select(*keys, *columns), keys)
    return _as_text(interactions, keys).join(right, list(keys), "left")


def one_per_key(
    feedback: DataFrame, keys: Sequence[str] = ("steam_id", "app_id"), columns: Sequence[str] = ("voted_up",)
) -> DataFrame:
    """One row per key, a positive review winning, so that no interaction is counted twice.

    Store the result before joining it: a bare scan leaves the join open to the skew split.
    """
    return feedback.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def enrich(recs: DataFrame, metadata: DataFrame, key: str = "app_id") -> DataFrame:
    """Add metadata to each recommendation; an item without metadata keeps NULLs."""
    return _as_text(recs, [key]).join(_as_text(metadata, [key]), key, "left")


def missing_keys(asked: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The asked rows whose key is not among the known ones.

    Both sides stay bare: an aggregate over the known keys would keep a hot asked key from being split.
    """
    return asked.join(known.select(key), key, "left_anti")
