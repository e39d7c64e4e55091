"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning rules that decide which texts survive.
LINE_BREAK_RUN = r"[\r\n]+"
MIN_TEXT_LENGTH = 10


def clean_text(text: Column) -> Column:
    """One space for every run of line breaks, then strip spaces (and only spaces) at both ends."""
    return F.trim(F.regexp_replace(text, LINE_BREAK_RUN, " "))


def long_enough(text: Column, min_length: int = MIN_TEXT_LENGTH) -> Column:
    """True for texts of at least ``min_length`` code points; NULL for NULL, so a filter drops it."""
    return F.length(text) >= min_length
