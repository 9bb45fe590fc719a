"""Data-quality checks, the two suites and the blocking gate."""

from .checks import (
    Check,
    accepted_values,
    between,
    expression_true,
    implies,
    not_null,
    orphans,
    relationship,
    row_count,
    run_suite,
    unique,
    with_values,
)
from .gate import QualityGateError, gate, summarise
from .suites import FEATURE_CHECKS, MART_CHECKS, MART_EXPECTATIONS, OWN_CHECKS, STAGING_CHECKS

__all__ = [
    "FEATURE_CHECKS",
    "MART_CHECKS",
    "MART_EXPECTATIONS",
    "OWN_CHECKS",
    "STAGING_CHECKS",
    "Check",
    "QualityGateError",
    "accepted_values",
    "between",
    "expression_true",
    "gate",
    "implies",
    "not_null",
    "orphans",
    "relationship",
    "row_count",
    "run_suite",
    "summarise",
    "unique",
    "with_values",
]
