"""Bitmaps of a fixed number of bits that stand for sets of 64-bit keys: what is not in them is not in the set."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_bitmap(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` (a power of two) with the bit of every key in ``column`` set.

    Bits are joined by Spark; at most bits / 64 rows reach the driver, however many keys there are.
    """
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("b"))
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().view(np.uint64)
    return out


def may_contain(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set: always for keys of the set, rarely for others."""
    place = keys & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
