"""Recommended actions: fixed rules over a score and the features behind it.

Every rule returns a struct (risk_band, recommendation, rationale, is_heuristic).
A low band always means no action and an empty rationale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..domain import (
    BELOW_BAND_SHARE,
    ELEVATED_RISK,
    HEAVY_RECRUITER_LOAD,
    HIGH_RISK,
    SENIOR_LEVELS,
    STALLED_STAGE_DAYS,
)

# Wording of the advice, by rule and case.
ADVICE = {
    "fill_low": "No action: this role is on pace.",
    "fill_niche": "Search a wider area, allow remote work, or relax the fill target.",
    "fill_other": "Check sourcing channels and tighten interview scheduling.",
    "dropout_low": "No action: the candidate is engaged.",
    "dropout_stalled": "Follow up now or bring the next step forward.",
    "dropout_other": "Check in and agree on a timeline.",
    "offer_low": "No action: acceptance is likely.",
    "offer_below_band": "Raise the offer or stress equity, growth and flexibility.",
    "offer_other": "Close in person and stress what matters to the candidate.",
}


def risk_band(score: Column) -> Column:
    return F.when(score >= HIGH_RISK, "high").when(score >= ELEVATED_RISK, "elevated").otherwise("low")


def _action(score: Column, calm: str, advice: Column, *reasons: Column) -> Column:
    """Assemble the struct; reasons that evaluate to null are left out, order kept."""
    band = risk_band(score)
    nothing = F.array().cast("array<string>")
    return F.struct(
        band.alias("risk_band"),
        F.when(band == "low", F.lit(calm)).otherwise(advice).alias("recommendation"),
        F.when(band == "low", nothing).otherwise(F.array_compact(F.array(*reasons))).alias("rationale"),
        F.lit(True).alias("is_heuristic"),
    )


def recommend_fill(score: Column, is_niche_location: Column, seniority_level: Column, load: Column) -> Column:
    niche = F.coalesce(is_niche_location, F.lit(False))
    return _action(
        score,
        ADVICE["fill_low"],
        F.when(niche, ADVICE["fill_niche"]).otherwise(ADVICE["fill_other"]),
        F.when(niche, "niche location with few candidates").otherwise("slow profile against its target"),
        F.when(seniority_level.isin(*SENIOR_LEVELS), F.concat(seniority_level, F.lit(" roles take longer to fill"))),
        F.when(
            load >= HEAVY_RECRUITER_LOAD,
            F.concat(F.lit("recruiter has "), load.cast("string"), F.lit(" other open requisitions")),
        ),
    )


def recommend_dropout(score: Column, max_stage_dwell_days: Column, rounds: Column) -> Column:
    stalled = F.coalesce(max_stage_dwell_days >= STALLED_STAGE_DAYS, F.lit(False))
    days = max_stage_dwell_days.cast("int").cast("string")
    return _action(
        score,
        ADVICE["dropout_low"],
        F.when(stalled, ADVICE["dropout_stalled"]).otherwise(ADVICE["dropout_other"]),
        F.when(stalled, F.concat(F.lit("one stage has lasted "), days, F.lit(" days"))).otherwise(
            "profile withdraws more often"
        ),
        F.when(rounds == 0, "no interview yet"),
    )


def recommend_offer(score: Column, offer_to_band_ratio: Column, is_referral: Column) -> Column:
    """The percentage in the rationale rounds half to even."""
    ratio = offer_to_band_ratio.cast("decimal(20,4)")
    below = F.coalesce(ratio < F.lit(BELOW_BAND_SHARE).cast("decimal(3,2)"), F.lit(False))
    shown = F.bround(ratio * 100, 0).cast("int").cast("string")
    return _action(
        score,
        ADVICE["offer_low"],
        F.when(below, ADVICE["offer_below_band"]).otherwise(ADVICE["offer_other"]),
        F.when(below, F.concat(F.lit("offer is "), shown, F.lit("% of the band midpoint"))).otherwise(
            "profile declines more often"
        ),
        F.when(~is_referral, "not a referral"),
    )
