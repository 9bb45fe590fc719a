"""Stage durations, one column per stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import days_between


def stage_pivot(df: DataFrame, key: str, stage: str, start: str, end: str, stages: Sequence[str]) -> DataFrame:
    """One row per ``key``: longest stay in each stage, first start, last end, rows.

    The stage list is fixed, so this is one hash aggregate. Every measure
    combines on the map side, and a hot key shrinks to one row per map task
    before the shuffle.
    """
    stay = days_between(end, start)
    return df.groupBy(key).agg(
        *[F.max(F.when(F.col(stage) == s, stay)).alias(f"days_in_{s}") for s in stages],
        F.min(start).alias("first_start"),
        F.max(end).alias("last_end"),
        F.count(F.lit(1)).alias("stages_recorded"),
    )
