"""Exact numeric measures: decimals throughout, half rounds away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))


def exact_avg(c: Column | str, scale: int) -> Column:
    """Aggregate: mean of an integer column, rounded once.

    Rows add up as longs; one decimal division per group carries eighteen digits
    into the only rounding.
    """
    c = _col(c).cast("long")
    return F.round(F.try_divide(F.sum(c).cast("decimal(20,0)"), F.count(c).cast("decimal(20,0)")), scale)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """100 * part / whole over counts, null when ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("decimal(18,0)") * F.lit(100), whole.cast("decimal(18,0)")), scale)


def rate(cond: Column, base: Column | None = None, scale: int = 2) -> Column:
    """Aggregate: percentage of ``base`` rows (default all) that satisfy ``cond``."""
    if base is None:
        return percent(F.count_if(cond), F.count(F.lit(1)), scale)
    return percent(F.count_if(base & cond), F.count_if(base), scale)


def ratio_or_null(num: Column | str, den: Column | str, scale: int) -> Column:
    """Rounded quotient, null when the divisor is null or zero."""
    return F.round(F.try_divide(_col(num), _col(den)), scale)


def share_below(value: Column | str, reference: Column | str, share: str) -> Column:
    """``value < share * reference`` in decimals, null when reference is null or zero."""
    reference = _col(reference)
    return F.when(reference != 0, _col(value) < F.lit(share).cast("decimal(3,2)") * reference)
