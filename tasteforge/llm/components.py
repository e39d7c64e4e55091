"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteforge.session import materialize


def _state(edges: DataFrame) -> tuple:
    """Row count and a checksum: two numbers, whatever the size of the graph."""
    code = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(code.bitwiseAND(F.lit((1 << 31) - 1))), F.sum(F.shiftright(code, 33))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that ``edges`` (two bigint columns) touches; component is the smallest node.

    Self-loops, repeated and reversed edges do no harm. Minima are combined before each shuffle, so a node with a third
    of all edges sends one row per task; the joins back to it stand between bare exchanges, where AQE splits it. Each
    round is written to the shared folder, so lineage stays short and the driver sees a count and a checksum only.
    """
    a, b = edges.columns[:2]
    current = edges.select(F.col(f"`{a}`").alias("u"), F.col(f"`{b}`").alias("v")).where("u <> v")
    current = materialize(_small_star(current), "components")
    before, now = None, _state(current)
    while now != before and now[0]:
        before = now
        current = materialize(_small_star(_large_star(current)), "components")
        now = _state(current)
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
