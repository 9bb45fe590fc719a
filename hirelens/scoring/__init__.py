"""Risk scores in bulk, with rule-based recommendations."""

from .recommend import recommend_dropout, recommend_fill, recommend_offer, risk_band
from .score import (
    at_risk_view,
    missing_ids,
    open_requisitions,
    rank_at_risk,
    score_applications,
    score_offers,
    score_open_requisitions,
)

__all__ = [
    "at_risk_view",
    "missing_ids",
    "open_requisitions",
    "rank_at_risk",
    "recommend_dropout",
    "recommend_fill",
    "recommend_offer",
    "risk_band",
    "score_applications",
    "score_offers",
    "score_open_requisitions",
]
