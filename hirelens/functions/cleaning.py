"""Casting and text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Strip spaces (not tabs); an empty remainder becomes null."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """``trimmed`` in lower case."""
    return F.lower(trimmed(c))


def as_type(c: Column | str, dtype: DataType | str, lenient: bool = False) -> Column:
    """Cast; a bad value raises under ANSI mode, or becomes null when lenient."""
    return _col(c).try_cast(dtype) if lenient else _col(c).cast(dtype)


def bool_default(c: Column | str, default: bool = False) -> Column:
    return F.coalesce(as_type(c, "boolean"), F.lit(default))
