"""Lenient reading of untyped values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a number in text; Java's own parser would also take "1d" or "0x1p3".
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"


def lenient_double(text: Column, default: float = 0.0) -> Column:
    """Text to double; anything that is not a number, and NULL, gives ``default``."""
    as_number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.coalesce(as_number, F.lit(default))


def whole_number(text: Column) -> Column:
    """Text of a number to bigint, fractions cut off; NULL for anything else and for what does not fit."""
    exact = F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint"))
    other = F.when(text.rlike(_NUMBER), text.try_cast("double").try_cast("bigint"))
    return F.coalesce(exact, other)


def flag(text: Column) -> Column:
    """Text of true, false, 1 or 0 to boolean; NULL for anything else."""
    folded = F.lower(F.trim(text))
    return F.when(folded.isin("true", "1", "1.0"), True).when(folded.isin("false", "0", "0.0"), False)


def id_token(text: Column) -> Column:
    """An id as text, a whole number written as 400.0 like 400; NULL for the empty string and for objects and arrays."""
    plain = F.regexp_replace(F.trim(text), r"^([+-]?\d+)\.0+$", "$1")
    return F.when((plain != "") & ~plain.rlike(r"^[\[{]"), plain)


def present(value: Column) -> Column:
    """Neither NULL nor the empty string."""
    return value.isNotNull() & (value != "")


def truthy(text: Column) -> Column:
    """A flag that was read as text: 1 and true are on; NULL, 0, false and the empty string are off."""
    return F.coalesce(~F.lower(text).isin("0", "false", ""), F.lit(False))


def or_empty(value: Column, ddl: str) -> Column:
    """A missing array becomes ``[]``, a missing object ``{}`` (a struct of NULLs), a missing scalar stays NULL."""
    if ddl.startswith("ARRAY"):
        return F.coalesce(value, F.array().cast(ddl))
    if ddl.startswith("STRUCT"):
        return F.coalesce(value, F.from_json(F.lit("{}"), ddl))
    return value


def utc_stamp(moment: Column | None = None) -> Column:
    """ISO-8601 text of an instant (now by default) in UTC, with microseconds and no zone."""
    instant = F.current_timestamp() if moment is None else moment
    in_utc = F.to_utc_timestamp(instant, F.current_timezone())
    return F.date_format(in_utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def utc_day(stamp: Column) -> Column:
    """The day of an ISO-8601 text stamp."""
    return F.to_date(F.substring(stamp, 1, 10))


def id_text(df: DataFrame, id_col: str, out: str = "id") -> DataFrame:
    """Ids as text; missing and empty ids are dropped rather than turned into words."""
    ids = df.select(F.col(id_col).cast("string").alias(out))
    return ids.where(present(F.col(out)))
