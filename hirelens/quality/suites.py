"""The checks of each layer."""

from __future__ import annotations

from ..domain import (
    DECISIONS,
    FEEDBACK_SCORES,
    MAX_FILL_DAYS,
    MAX_RESPONSE_DAYS,
    OUTCOMES,
    SENIORITY,
    SOURCES,
)
from .checks import Check, accepted_values, between, expression_true, implies, not_null, relationship, unique


def _key(table: str, *columns: str) -> list[Check]:
    return [check(table, c) for c in columns for check in (not_null, unique)]


def _filled(table: str, *columns: str) -> list[Check]:
    return [not_null(table, c) for c in columns]


def _foreign(table: str, **parents: tuple[str, str]) -> list[Check]:
    return [relationship(table, column, *parent) for column, parent in parents.items()]


APPLICANT = ("dim_applicant", "applicant_key")
REQUISITION = ("dim_requisition", "requisition_key")
RECRUITER = ("dim_recruiter", "recruiter_key")
DATE = ("dim_date", "date_key")
APPLICATION = ("fact_applications", "application_id")

# Declared on the staging layer: 27 checks.
STAGING_CHECKS: list[Check] = [
    *_key("stg_applicants", "applicant_id"),
    accepted_values("stg_applicants", "source", SOURCES),
    *_filled("stg_applicants", "is_referral"),
    *_key("stg_requisitions", "req_id"),
    accepted_values("stg_requisitions", "seniority_level", SENIORITY),
    *_filled("stg_requisitions", "target_time_to_fill_days"),
    *_key("stg_applications", "application_id"),
    *_filled("stg_applications", "applicant_id", "req_id"),
    accepted_values("stg_applications", "final_outcome", OUTCOMES),
    *_filled("stg_stage_history", "application_id", "stage_name"),
    *_key("stg_interviews", "interview_id"),
    *_filled("stg_interviews", "application_id"),
    accepted_values("stg_interviews", "feedback_score", FEEDBACK_SCORES),
    *_key("stg_offers", "offer_id"),
    *_filled("stg_offers", "application_id"),
    accepted_values("stg_offers", "decision", DECISIONS),
    *_key("stg_hires", "hire_id", "offer_id"),
]

# Declared on the star schema: 48 checks.
MART_CHECKS: list[Check] = [
    *_key("dim_applicant", "applicant_key", "applicant_id"),
    *_key("dim_requisition", "requisition_key", "req_id"),
    accepted_values("dim_requisition", "seniority_level", SENIORITY),
    *_key("dim_recruiter", "recruiter_key", "recruiter_id"),
    *_key("dim_date", "date_key", "date_day"),
    *_key("fact_applications", "application_id"),
    *_filled("fact_applications", "applicant_key", "requisition_key", "recruiter_key", "applied_date_key"),
    *_foreign(
        "fact_applications",
        applicant_key=APPLICANT,
        requisition_key=REQUISITION,
        recruiter_key=RECRUITER,
        applied_date_key=DATE,
    ),
    accepted_values("fact_applications", "final_outcome", OUTCOMES),
    *_key("fact_offers", "offer_id"),
    *_filled("fact_offers", "application_id", "requisition_key", "recruiter_key", "offer_date_key"),
    *_foreign(
        "fact_offers",
        application_id=APPLICATION,
        requisition_key=REQUISITION,
        recruiter_key=RECRUITER,
        offer_date_key=DATE,
    ),
    accepted_values("fact_offers", "decision", DECISIONS),
    *_key("fact_requisitions", "req_id", "requisition_key"),
    *_filled("fact_requisitions", "recruiter_key", "opened_date_key"),
    *_foreign(
        "fact_requisitions", requisition_key=REQUISITION, recruiter_key=RECRUITER, opened_date_key=DATE
    ),
]

# Declared on the feature mart: 12 checks.
FEATURE_CHECKS: list[Check] = [
    expression_true(
        "mart_ml_features",
        "label_offer_declined iff reached_offer_stage",
        "(label_offer_declined is not null) = reached_offer_stage",
    ),
    expression_true(
        "mart_ml_features",
        "offer_to_band_ratio iff reached_offer_stage",
        "(offer_to_band_ratio is not null) = reached_offer_stage",
    ),
    *_key("mart_ml_features", "application_id"),
    accepted_values("mart_ml_features", "candidate_source", SOURCES),
    accepted_values("mart_ml_features", "seniority_level", SENIORITY),
    *_filled(
        "mart_ml_features",
        "referral_flag",
        "interview_rounds_completed",
        "recruiter_concurrent_open_reqs",
        "max_stage_dwell_days",
        "reached_offer_stage",
        "label_was_dropped",
    ),
]

# The blocking expectations on the star schema: 46 and the flag implication.
MART_EXPECTATIONS: list[Check] = [
    *_key("dim_applicant", "applicant_key"),
    *_filled("dim_applicant", "applicant_id"),
    *_key("dim_requisition", "requisition_key"),
    *_filled("dim_requisition", "req_id"),
    *_key("dim_recruiter", "recruiter_key"),
    *_key("dim_date", "date_key"),
    *_key("fact_applications", "application_id"),
    *_filled("fact_applications", "applicant_key", "requisition_key", "recruiter_key", "applied_date_key"),
    *_foreign(
        "fact_applications",
        applicant_key=APPLICANT,
        requisition_key=REQUISITION,
        recruiter_key=RECRUITER,
        applied_date_key=DATE,
    ),
    between("fact_applications", "actual_time_to_fill_days", 0, MAX_FILL_DAYS),
    between("fact_applications", "min_feedback_score", FEEDBACK_SCORES[0], FEEDBACK_SCORES[-1]),
    between("fact_applications", "avg_feedback_score", FEEDBACK_SCORES[0], FEEDBACK_SCORES[-1]),
    accepted_values("fact_applications", "final_outcome", OUTCOMES),
    *_key("fact_offers", "offer_id"),
    *_filled("fact_offers", "application_id", "requisition_key", "recruiter_key", "offer_date_key"),
    *_foreign(
        "fact_offers",
        requisition_key=REQUISITION,
        recruiter_key=RECRUITER,
        offer_date_key=DATE,
        application_id=APPLICATION,
    ),
    between("fact_offers", "days_to_respond", 0, MAX_RESPONSE_DAYS),
    accepted_values("fact_offers", "decision", DECISIONS),
    *_key("fact_requisitions", "req_id"),
    *_filled("fact_requisitions", "requisition_key", "recruiter_key", "opened_date_key"),
    *_foreign(
        "fact_requisitions", requisition_key=REQUISITION, recruiter_key=RECRUITER, opened_date_key=DATE
    ),
    between("fact_requisitions", "avg_time_to_fill_days", 0, MAX_FILL_DAYS),
    between("fact_requisitions", "max_time_to_fill_days", 0, MAX_FILL_DAYS),
    implies("fact_requisitions", "all_hires_missed_target", "any_hire_missed_target"),
]

# Ours: the one foreign key that no other suite covers.
OWN_CHECKS: list[Check] = [*_foreign("fact_offers", applicant_key=APPLICANT)]
