"""Positions in a global order, without a sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteforge.session import materialize

# monotonically_increasing_id: partition number above bit 33, row number within it below.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: list, column: str) -> tuple[DataFrame, int]:
    """``df`` with its 0-based positions in ``order``, and its row count (runs jobs).

    The rows are range-sorted and stored; a sort partition's first position is the number of rows in those before it,
    which takes one count per partition on the driver.
    """
    stored = materialize(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "numbered")
    run = F.shiftright("_place", _ROW_BITS).cast("int")
    rows = {r["run"]: r["rows"] for r in stored.groupBy(run.alias("run")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    starts, size = [], 0
    for number in range(max(rows, default=-1) + 1):
        starts.append(size)
        size += rows.get(number, 0)
    first = F.get(F.split(F.lit(",".join(map(str, starts or [0]))), ",").cast("array<bigint>"), run)
    return stored.withColumn(column, first + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).drop("_place"), size
