"""Levels of categorical columns as a dense dictionary, and one-hot columns from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dense_positions

MAX_LEVELS = 1000  # a model has a weight for each; more is a key, not a category


class TooManyLevels(ValueError):
    pass


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, level, place) of every distinct value, numbered from 0 in the order of their texts.

    Stored once, in as many parts as it needs; nulls are no level.
    """
    each = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")).distinct() for c in columns],
    )
    return dense_positions(each.filter("level is not null"), ["level"], by=["feature"], out="place")


def levels(df: DataFrame, columns: Sequence[str], most: int = MAX_LEVELS) -> dict[str, tuple[str, ...]]:
    """{column: its levels in order}; raises before anything is collected where a column has more than ``most``."""
    if not columns:
        return {}
    table = level_table(df, columns)
    for r in table.groupBy("feature").agg(F.max("place").alias("last")).filter(F.col("last") >= most).collect():
        raise TooManyLevels(f"{r['feature']} has {r['last'] + 1} levels; at most {most} are encoded")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in table.orderBy("feature", "place").collect():
        out[r["feature"]].append(r["level"])
    return {c: tuple(v) for c, v in out.items()}


def one_hot(df: DataFrame, known: Mapping[str, Sequence[str]]) -> DataFrame:
    """``df`` with an array of 0 and 1 per column, ``<column>_hot``; null and unknown levels are all zeros."""
    hot = {}
    for c, values in known.items():
        flags = [F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for v in values]
        hot[f"{c}_hot"] = F.array(*flags) if flags else F.array().cast("array<int>")
    return df.withColumns(hot) if hot else df
