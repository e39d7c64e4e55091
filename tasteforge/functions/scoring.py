"""The interaction score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The weight of a positive and of a negative review.
POSITIVE_WEIGHT = 1.5
NEGATIVE_WEIGHT = 0.5


def hybrid_score(
    engagement: Column,
    voted_up: Column,
    positive: float = POSITIVE_WEIGHT,
    negative: float = NEGATIVE_WEIGHT,
) -> Column:
    """log(1 + engagement), weighted by the vote; no vote leaves it as it is."""
    base = F.log1p(engagement)
    return F.when(voted_up, base * positive).when(~voted_up, base * negative).otherwise(base)
