"""Top-N, quotas and sets of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteforge.functions.parsing import id_text


def top_n(df: DataFrame, n: int, score: str, id_col: str, missing: float = 0) -> DataFrame:
    """The ``n`` rows with the greatest score, a missing score counting as ``missing``; ties by id.

    Each task keeps its own best ``n`` (TakeOrderedAndProject), so nothing is sorted globally.
    """
    ranked = F.coalesce(F.col(score), F.lit(missing))
    return df.orderBy(ranked.desc(), F.col(id_col).asc()).limit(n)


def top_n_tagged(
    df: DataFrame, tag: str, n: int, score: str, id_col: str, tag_col: str, missing: float = 0
) -> DataFrame:
    """Top-N among the rows that carry ``tag``; the tag column holds one tag or an array of tags."""
    is_array = df.schema[tag_col].dataType.typeName() == "array"
    tagged = F.array_contains(tag_col, tag) if is_array else F.col(tag_col) == tag
    return top_n(df.where(tagged), n, score, id_col, missing)


def first_n(df: DataFrame, n: int, id_col: str, where: Column | None = None) -> DataFrame:
    """The first ``n`` rows in id order, out of those that pass ``where``."""
    kept = df if where is None else df.where(where)
    return kept.orderBy(id_col).limit(n)


def distinct_ids(df: DataFrame, id_col: str, out: str = "id") -> DataFrame:
    """Distinct non-empty ids as text; duplicates fall away before the shuffle."""
    return id_text(df, id_col, out).distinct()


def union_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set union of two id lists."""
    return left.unionByName(right).distinct()


def list_sizes(lists: dict[str, DataFrame]) -> DataFrame:
    """One row with the size of each named list."""
    counts = [df.select(F.lit(name).alias("list_name"), F.lit(1).alias("one")) for name, df in lists.items()]
    stacked = counts[0]
    for more in counts[1:]:
        stacked = stacked.unionByName(more)
    return stacked.agg(*[F.count_if(F.col("list_name") == name).alias(name) for name in lists])
