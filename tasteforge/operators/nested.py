"""Work on arrays of structs inside one row, and turning them into rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_fields(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Project dotted paths under new names: ``{"price": "metadata.price.final"}``.

    A path through an array of structs gives the array of that field.
    """
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def compute_once(df: DataFrame, value: Column, name: str, keep: Callable[[Column], Column]) -> DataFrame:
    """Add or replace the column ``name`` and drop the rows whose value fails ``keep``.

    For costly values, such as parsed JSON or replaced text. A filter over a projected value would be pushed
    below the projection and work the value out a second time; an explode of zero or one elements is not.
    """
    # The lambda hides any further parameter of keep, which filter would take for the element's position.
    result = F.explode(F.filter(F.array(value), lambda v: keep(v))).alias(name)
    others = [result if c == name else F.col(c) for c in df.columns]
    return df.select(*others) if name in df.columns else df.select(*others, result)


def explode_items(
    df: DataFrame,
    array_col: str,
    fields: Mapping[str, str] | str,
    keep: Callable[[Column], Column] | None = None,
    carry: tuple[str, ...] = (),
    outer: bool = False,
) -> DataFrame:
    """One row per array element, with ``carry`` columns and the element's ``fields``.

    A single name instead of ``fields`` stands for the element itself.
    ``keep`` filters the elements inside the array, before any row exists for them: a filter above
    the explode could not pass below it. NULL and empty arrays give no row unless ``outer``.
    """
    items = F.col(array_col) if keep is None else F.filter(F.col(array_col), lambda item: keep(item))
    explode = F.explode_outer if outer else F.explode
    if isinstance(fields, str):
        return df.select(*carry, explode(items).alias(fields))
    rows = df.select(*carry, explode(items).alias("_item"))
    return rows.select(*carry, *[F.col(f"_item.{path}").alias(name) for name, path in fields.items()])


def map_rows(df: DataFrame, map_col: str, fields: Mapping[str, str]) -> DataFrame:
    """One row per value of a map of structs."""
    rows = df.select(F.explode(F.map_values(map_col)).alias("_value"))
    return rows.select(*[F.col(f"_value.{path}").alias(name) for name, path in fields.items()])
