"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..domain import NULL_KEY_SENTINEL


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the dash-joined text of ``cols``; nulls hash as a fixed sentinel."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY_SENTINEL)) for c in cols
    ]
    return F.md5(F.concat_ws("-", *parts))


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer, by arithmetic instead of text formatting."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
