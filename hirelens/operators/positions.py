"""Places and running sums over a whole sorted table, without a task that sorts all of it.

Rows are spread by ranges of the sort key and stored; what a partition adds to the ones after it
is one number per group, so only those numbers are ordered across the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_ALL = "_all"


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(by)) if by else (df.withColumn(_ALL, F.lit(0)), [_ALL])


def _offsets(stored: DataFrame, group: list[str], held: Column) -> DataFrame:
    """(group, _part, _before, _total): what earlier partitions of a group hold, and all of them."""
    sums = stored.groupBy(*group, "_part").agg(held.alias("_held"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *group,
        "_part",
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_held").over(Window.partitionBy(*group)).alias("_total"),
    )


def dense_positions(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), out: str = "pos", total: str | None = None
) -> DataFrame:
    """``df`` with each row's place from 0 by ``order``, inside its group of ``by`` if given, and the group's size.

    The place depends on the rows alone where ``order`` is unique in a group. Groups may fill any
    number of partitions; their columns must not be null.
    """
    df, group = _grouped(df, by)
    spread = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    stored = cut_lineage(spread.withColumn("_row", F.monotonically_increasing_id()))
    stored = stored.withColumn("_part", F.shiftright("_row", 33))
    first = stored.groupBy(*group, "_part").agg(F.min("_row").alias("_first"))
    shift = _offsets(stored, group, F.count(F.lit(1))).join(first, [*group, "_part"])
    placed = stored.join(shift, [*group, "_part"]).withColumn(out, F.col("_row") - F.col("_first") + F.col("_before"))
    if total:
        placed = placed.withColumn(total, F.col("_total"))
    return placed.drop("_row", "_part", "_first", "_before", "_total", _ALL)


def sum_before(df: DataFrame, order: str, value: str, by: Sequence[str] = (), out: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the same group that come earlier by ``order``.

    ``order`` is unique in a group. ``df`` is computed once; a task sorts one range of it.
    """
    df, group = _grouped(df, by)
    stored = cut_lineage(df.repartitionByRange(*group, order).withColumn("_part", F.spark_partition_id()))
    within = Window.partitionBy(*group, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(within), F.lit(0))
    offsets = _offsets(stored, group, F.sum(value)).drop("_total")
    return stored.join(offsets, [*group, "_part"]).withColumn(out, inside + F.col("_before")).drop("_part", "_before", _ALL)
