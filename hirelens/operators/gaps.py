"""Days between consecutive events of a key, ordered by round.

A plain ``lag`` over the key would sort every row of a hot key in one task.
Rows that share (key, round, date) can only have gaps of zero between them, so
both operators first shrink to those slots, with map-side combine, and run the
window over slots: at most rounds x calendar days of them per key, however many
rows the key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import days_between


def _gap_to_previous_slot(key: str, order: str, date: str) -> Column:
    in_order = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last(), F.col(date).asc_nulls_last())
    return days_between(date, F.lag(date).over(in_order))


def round_gaps(
    df: DataFrame, key: str, order: str, date: str, tiebreak: str, out: str = "gap_from_prev_round"
) -> DataFrame:
    """Every row of ``df`` with the days since the row before it.

    Order within a key is (order, date, tiebreak); ``tiebreak`` must be unique.
    """
    slots = (
        df.groupBy(key, order, date)
        .agg(F.min(tiebreak).alias("_head"))
        .withColumn("_gap", _gap_to_previous_slot(key, order, date))
    )
    rows, slots = df.alias("rows"), slots.alias("slots")
    same_slot = [F.col(f"rows.{c}").eqNullSafe(F.col(f"slots.{c}")) for c in (key, order, date)]
    gap = F.when(F.col(f"rows.{tiebreak}") == F.col("_head"), F.col("_gap")).when(
        F.col(f"rows.{date}").isNotNull(), F.lit(0)
    )
    return rows.join(slots, same_slot, "inner").select("rows.*", gap.alias(out))


def max_round_gap(
    df: DataFrame, key: str, order: str, date: str, out: str, rows: str | None = None
) -> DataFrame:
    """One row per ``key``: the longest gap of ``round_gaps``, without the row-level join.

    ``rows`` says how many rows each row of ``df`` stands for, one by default.
    """
    slots = df.groupBy(key, order, date).agg((F.sum(rows) if rows else F.count(F.lit(1))).alias("_rows"))
    inside = F.when((F.col("_rows") > 1) & F.col(date).isNotNull(), F.lit(0))
    return (
        slots.withColumn("_gap", _gap_to_previous_slot(key, order, date))
        .groupBy(key)
        .agg(F.max(F.greatest("_gap", inside)).alias(out))
    )
