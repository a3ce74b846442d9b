"""Time column expressions (instants are UTC ``TIMESTAMP``; calendar parts use a named zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds (floor), as the look-back features count them."""
    return F.floor(epoch_micros(ts) / F.lit(1_000_000)).cast("bigint")


def local_time(ts: Column, zone: str) -> Column:
    return F.from_utc_timestamp(ts, zone)


def hours_between(later: Column, earlier: Column) -> Column:
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(3_600_000_000.0)


def minutes_between(later: Column, earlier: Column) -> Column:
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(60_000_000.0)
