"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() whitespace set (ASCII part), used by cleaning.
_WS = r"[\s\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0]"


def strip_all(c: Column) -> Column:
    """Strip every kind of leading/trailing whitespace, not only spaces."""
    return F.regexp_replace(c, rf"^{_WS}+|{_WS}+$", "")


def contains_any(c: Column, pattern: str) -> Column:
    """Case-insensitive regex search; null text counts as no match."""
    return F.coalesce(F.lower(c).rlike(pattern), F.lit(False)).cast("int")


def word_count(c: Column) -> Column:
    """Words split on whitespace; empty or blank text has 0 words."""
    trimmed = strip_all(c)
    return (
        F.when(c.isNull() | (trimmed == ""), F.lit(0))
        .otherwise(F.size(F.split(trimmed, r"\s+")))
        .cast("int")
    )
