"""Generic operators: they take column names and know nothing about hiring."""

from .contrast import group_contrast
from .first_event import first_event, first_touch
from .gaps import max_round_gap, round_gaps
from .open_load import attach_open_load, lifetime_load, load_as_of, open_load_curve
from .positions import dense_positions, sum_before
from .stage_pivot import stage_pivot

__all__ = [
    "attach_open_load",
    "dense_positions",
    "first_event",
    "first_touch",
    "group_contrast",
    "lifetime_load",
    "load_as_of",
    "max_round_gap",
    "open_load_curve",
    "round_gaps",
    "stage_pivot",
    "sum_before",
]
