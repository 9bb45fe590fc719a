"""Earliest date per key, and its use as a replacement value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_event(df: DataFrame, key: str, date: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(date).alias(out))


def first_touch(dim: DataFrame, facts: DataFrame, key: str, date: str) -> DataFrame:
    """``dim`` with ``date`` replaced by the key's earliest fact date, if it has one."""
    seen = first_event(facts, key, date, "_first_seen")
    return (
        dim.join(seen, key, "left")
        .withColumn(date, F.coalesce("_first_seen", date))
        .select(*dim.columns)
    )
