"""Domain constants shared by the plans, the quality suites and the fixtures.

Fixed values: the lists, thresholds and sentinel below are part of the data
contract and must stay exactly as written for results to be comparable.
"""

from __future__ import annotations

from dataclasses import dataclass

SOURCES = ("referral", "job_board", "linkedin", "university", "agency")
SENIORITY = ("junior", "mid", "senior", "staff", "principal")  # ordinal, lowest first
STAGES = ("applied", "screen", "phone_interview", "onsite", "final")
OUTCOMES = ("hired", "rejected", "withdrawn", "in_progress")
DECISIONS = ("accepted", "declined", "expired")
FEEDBACK_SCORES = (1, 2, 3, 4, 5)

NICHE_LOCATIONS = ("boise", "reno", "berlin")
SENIOR_LEVELS = ("senior", "staff", "principal")

DATE_SPINE_START = "2024-01-01"
DATE_SPINE_END = "2026-01-01"  # exclusive

NULL_KEY_SENTINEL = "_dbt_utils_surrogate_key_null_"

BELOW_BAND_SHARE = "0.90"
HIGH_RISK = 0.60
ELEVATED_RISK = 0.40
STALLED_STAGE_DAYS = 10
HEAVY_RECRUITER_LOAD = 250
LONG_DWELL_DAYS = 10
MAX_FILL_DAYS = 1000
MAX_RESPONSE_DAYS = 365


@dataclass(frozen=True)
class Vocabulary:
    """The value lists and dates of one company's data; the defaults are those of the contract."""

    sources: tuple[str, ...] = SOURCES
    seniority: tuple[str, ...] = SENIORITY
    outcomes: tuple[str, ...] = OUTCOMES
    decisions: tuple[str, ...] = DECISIONS
    niche_locations: tuple[str, ...] = NICHE_LOCATIONS
    first_day: str = DATE_SPINE_START
    end_day: str = DATE_SPINE_END  # exclusive

    def values(self) -> dict[str, tuple[str, ...]]:
        """The accepted values of each column that has a list."""
        return {
            "source": self.sources,
            "candidate_source": self.sources,
            "seniority_level": self.seniority,
            "final_outcome": self.outcomes,
            "decision": self.decisions,
        }


CONTRACT_VOCABULARY = Vocabulary()
