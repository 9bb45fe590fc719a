"""Compare the share of hits in a flagged group with the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import percent

_FINE = 10  # digits kept before the gap is rounded


def group_contrast(
    df: DataFrame,
    flag: Column,
    hits: Column,
    flagged: str,
    rest: str,
    scale: int = 1,
    rows: Column | None = None,
) -> DataFrame:
    """Two rows (grp, n, value, gap): percent of hits per group, gap in points.

    One global aggregate of four sums. ``hits`` is a condition, or the number of
    hits among the ``rows`` a row stands for. A null flag belongs to neither
    group; an empty group has a null value.
    """
    one = F.lit(1) if rows is None else rows

    def total(where: Column, amount: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, amount.cast("long"))), F.lit(0).cast("long"))

    counts = df.agg(
        total(flag, one).alias("n1"),
        total(flag, hits).alias("h1"),
        total(~flag, one).alias("n0"),
        total(~flag, hits).alias("h0"),
    )

    def share(group: int, digits: int) -> Column:
        return percent(F.col(f"h{group}"), F.col(f"n{group}"), digits)

    gap = F.round(share(1, _FINE) - share(0, _FINE), scale).cast("double").alias("gap")
    rows = [
        F.struct(
            F.lit(name).alias("grp"),
            F.col(f"n{group}").alias("n"),
            share(group, scale).cast("double").alias("value"),
            gap,
        )
        for group, name in ((1, flagged), (0, rest))
    ]
    return counts.select(F.inline(F.array(*rows)))
