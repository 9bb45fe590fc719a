"""How many of an owner's spans are open at a point in time.

The textbook form joins each point to every span of its owner and counts. That
pairs every application with every requisition of its recruiter. Here the spans
become +1/-1 events, the distinct (owner, day) points become zero events, and
one running sum per owner reads the answer off at each point. The work grows
with spans + points, never with their product.

Skew: events and points are summed per (owner, day) before the window, so an
owner with a third of all spans still brings at most one row per calendar day
to its task.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _is_open(opened: str, closed: str, at: Column) -> Column:
    """Opened on or before ``at`` and not yet closed then; null dates never open."""
    started = F.coalesce(F.col(opened) <= at, F.lit(False))
    return started & F.coalesce(F.col(closed) > at, F.lit(True))


def open_load_curve(
    spans: DataFrame, points: DataFrame, owner: str, opened: str, closed: str, at: str, out: str = "open_count"
) -> DataFrame:
    """(owner, at, out) at every distinct point: spans open then, own span included.

    A span is open from ``opened`` until the day before ``closed``; a null
    ``closed`` never closes, one on or before ``opened`` never counts.
    """
    known = spans.filter(F.col(owner).isNotNull() & F.col(opened).isNotNull())
    events = known.select(
        owner,
        F.explode(
            F.array(
                F.struct(F.col(opened).alias("day"), F.lit(1).alias("step")),
                F.struct(F.greatest(opened, closed).alias("day"), F.when(F.col(closed).isNotNull(), -1).alias("step")),
            )
        ).alias("e"),
    ).filter("e.step is not null")
    asked = points.filter(F.col(owner).isNotNull() & F.col(at).isNotNull())
    steps = events.select(owner, "e.day", "e.step", F.lit(False).alias("asked")).unionByName(
        asked.select(owner, F.col(at).alias("day"), F.lit(0).alias("step"), F.lit(True).alias("asked"))
    )
    by_day = steps.groupBy(owner, "day").agg(F.sum("step").alias("step"), F.bool_or("asked").alias("asked"))
    up_to = Window.partitionBy(owner).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        by_day.withColumn(out, F.sum("step").over(up_to))
        .filter("asked")
        .select(owner, F.col("day").alias(at), out)
    )


def attach_open_load(
    df: DataFrame, curve: DataFrame, owner: str, opened: str, closed: str, at: str, out: str
) -> DataFrame:
    """``df`` plus the owner's load at ``at``, the row's own span excluded.

    ``df`` carries its own span's ``opened`` and ``closed``. Rows without an
    owner or a date get 0.
    """
    own = F.when(F.col(owner).isNotNull() & _is_open(opened, closed, F.col(at)), 1).otherwise(0)
    load = F.coalesce(F.col("open_count"), F.lit(0)) - own
    return df.join(curve, [owner, at], "left").withColumn(out, load.cast("long")).drop("open_count")


def lifetime_load(spans: DataFrame, owner: str, out: str) -> DataFrame:
    """Spans the owner ever had, less one: the query-time approximation of load."""
    return spans.groupBy(owner).agg((F.count(F.lit(1)) - 1).alias(out))


def load_as_of(spans: DataFrame, owner: str, opened: str, closed: str, day: datetime.date, out: str) -> DataFrame:
    """Spans each owner has open on one given day."""
    return spans.groupBy(owner).agg(F.count_if(_is_open(opened, closed, F.lit(day))).alias(out))
