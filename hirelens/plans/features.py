"""The feature mart: one row per application, three labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..domain import NICHE_LOCATIONS, STAGES
from ..operators import attach_open_load, open_load_curve
from .dims import is_niche

LOAD = "recruiter_concurrent_open_reqs"


def load_curve(windows: DataFrame, apps: DataFrame) -> DataFrame:
    """Open requisitions per (recruiter, day) at every day someone applied to them.

    Application dates shrink to distinct (requisition, day) before the join.
    """
    owners = windows.select("req_id", "recruiter_id")
    points = apps.select("req_id", "applied_date").distinct().join(owners, "req_id")
    return open_load_curve(windows, points, "recruiter_id", "opened_date", "filled_date", "applied_date")


def recruiter_load(apps: DataFrame, windows: DataFrame) -> DataFrame:
    """Per application: the recruiter's other requisitions open on the day it came in."""
    own = windows.select("req_id", "recruiter_id", "opened_date", "filled_date")
    located = apps.select("application_id", "req_id", "applied_date").join(own, "req_id", "left")
    curve = load_curve(windows, apps)
    loaded = attach_open_load(located, curve, "recruiter_id", "opened_date", "filled_date", "applied_date", LOAD)
    return loaded.select("application_id", "recruiter_id", "applied_date", LOAD)


def ml_features(
    funnel: DataFrame,
    applicants: DataFrame,
    windows: DataFrame,
    rollup: DataFrame,
    curve: DataFrame,
    outcomes: DataFrame,
    pace: DataFrame,
    niche: tuple[str, ...] = NICHE_LOCATIONS,
) -> DataFrame:
    """Candidate, process, requisition and offer features with their labels.

    All inputs keyed by application join on one partitioning; then the row, cut to
    the columns of the mart, moves once per lookup: applicant, requisition,
    (recruiter, day), the widest last. ``windows``
    holds requisitions with their first fill date, ``rollup`` and ``curve`` are
    ``interview_rollup`` and ``load_curve``, which other plans read too.
    """
    visited = rollup.select(
        "application_id",
        F.col("interview_count").alias("interview_rounds_completed"),
        "avg_feedback_score",
        "min_feedback_score",
        F.col("distinct_interviewers").alias("interviewer_count"),
        "max_gap_between_rounds_days",
    )
    offered = outcomes.select(
        "application_id", "offer_id", "decision", "offer_to_band_ratio", "days_to_respond"
    )
    by_application = (
        funnel.join(visited, "application_id", "left")
        .join(offered, "application_id", "left")
        .join(pace.select("application_id", "missed_target"), "application_id", "left")
        .withColumn("max_stage_dwell_days", F.greatest(*[F.coalesce(f"days_in_{s}", F.lit(0)) for s in STAGES]))
        .drop(*[f"days_in_{s}" for s in STAGES])
    )
    role = windows.select(
        "req_id", "recruiter_id", "department", "seniority_level", "location", "opened_date", "filled_date"
    )
    candidate = applicants.select("applicant_id", "source", "is_referral", "resume_years_experience")
    located = by_application.join(candidate, "applicant_id", "left").join(role, "req_id", "left")
    loaded = attach_open_load(located, curve, "recruiter_id", "opened_date", "filled_date", "applied_date", LOAD)
    has_offer = F.col("offer_id").isNotNull()
    return loaded.select(
        "application_id",
        F.col("source").alias("candidate_source"),
        F.col("is_referral").alias("referral_flag"),
        "resume_years_experience",
        F.coalesce("interview_rounds_completed", F.lit(0).cast("long")).alias("interview_rounds_completed"),
        "avg_feedback_score",
        "min_feedback_score",
        F.coalesce("interviewer_count", F.lit(0).cast("long")).alias("interviewer_count"),
        "max_gap_between_rounds_days",
        "max_stage_dwell_days",
        "department",
        "seniority_level",
        "location",
        is_niche("location", niche).alias("is_niche_location"),
        LOAD,
        "offer_to_band_ratio",
        "days_to_respond",
        has_offer.alias("reached_offer_stage"),
        "current_stage",
        "final_outcome",
        "applied_date",
        F.col("missed_target").alias("label_missed_target"),
        F.col("was_dropped").alias("label_was_dropped"),
        F.when(has_offer, F.col("decision") == "declined").alias("label_offer_declined"),
    )
