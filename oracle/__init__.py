"""SQL oracles: the same results from plain SQL over the driver's tables."""

from .sql import oracle_sql

__all__ = ["oracle_sql"]
