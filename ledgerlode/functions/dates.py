"""Strict dates and times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(value: Column) -> Column:
    """A date from a zero-padded YYYY-MM-DD that exists; otherwise null."""
    return F.when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(value, "yyyy-MM-dd"))


def acceptance_utc(value: Column) -> Column:
    """A timestamp from a time with an offset or Z; null where it has none."""
    return F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9:.]+(Z|[+-][0-9]{2}:?[0-9]{2})$"), F.try_to_timestamp(value))


def exclusive_end(value: Column) -> Column:
    return F.date_add(value, 1)


def shard_year(filed: Column) -> Column:
    return F.coalesce(F.year(filed).cast("string"), F.lit("unknown"))


def backoff(attempt: Column, first: float = 0.5, most: float = 8.0) -> Column:
    """Seconds to wait before an attempt, counted from 1: doubled from ``first`` up to ``most``."""
    return F.least(F.lit(first) * F.pow(F.lit(2.0), attempt.cast("double") - 1), F.lit(most))
