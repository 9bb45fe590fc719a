"""Column expressions. Everything here is built-in and stays inside codegen."""

from .cleaning import as_type, bool_default, clean_text, trimmed
from .keys import date_key, surrogate_key
from .measures import days_between, exact_avg, percent, rate, ratio_or_null, share_below

__all__ = [
    "as_type",
    "bool_default",
    "clean_text",
    "date_key",
    "days_between",
    "exact_avg",
    "percent",
    "rate",
    "ratio_or_null",
    "share_below",
    "surrogate_key",
    "trimmed",
]
