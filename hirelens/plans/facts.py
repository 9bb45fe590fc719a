"""The three facts.

Joins on the grain's own key come first, so their inputs share one exchange; the
requisition lookup comes last. That lookup is the one that can be skewed (one
requisition may receive a third of all applications): AQE broadcasts the
requisitions when their measured size allows it and splits the hot partition of
the sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..domain import STAGES
from ..functions import date_key, exact_avg, surrogate_key
from ..operators import max_round_gap


def interview_visits(interviews: DataFrame) -> DataFrame:
    """(application, round, date, interviewer) with counts and score sums: the only scan of the interviews."""
    score = F.col("feedback_score").cast("long")
    return interviews.groupBy("application_id", "interview_round", "scheduled_date", "interviewer_id").agg(
        F.count(F.lit(1)).alias("visits"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("scores"),
        F.min("feedback_score").alias("least_score"),
    )


def interview_rollup(visits: DataFrame) -> DataFrame:
    """All that both marts need of an application's interviews, from ``interview_visits``; unfinished ones count.

    Sums go by (application, interviewer) first and gaps by (application, round, date), so a hot
    application is spread before anything gathers it.
    """
    people = visits.groupBy("application_id", "interviewer_id").agg(
        F.sum("visits").alias("visits"),
        F.max("interview_round").alias("last_round"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("scores").alias("scores"),
        F.min("least_score").alias("least_score"),
    )
    mean = F.try_divide(F.sum("score_sum").cast("decimal(20,0)"), F.sum("scores").cast("decimal(20,0)"))
    totals = people.groupBy("application_id").agg(
        F.sum("visits").alias("interview_count"),
        F.max("last_round").alias("max_interview_round"),
        F.round(mean, 3).alias("avg_feedback_score"),
        F.min("least_score").alias("min_feedback_score"),
        F.count("interviewer_id").alias("distinct_interviewers"),
    )
    gaps = max_round_gap(
        visits, "application_id", "interview_round", "scheduled_date", "max_gap_between_rounds_days", rows="visits"
    )
    return totals.join(gaps, "application_id")


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)


def fact_applications(funnel: DataFrame, reqs: DataFrame, rollup: DataFrame, pace: DataFrame) -> DataFrame:
    """Applications with their stages, interviews (``interview_rollup``) and fill."""
    fill = pace.select("application_id", "actual_time_to_fill_days", "days_over_target", "missed_target")
    return (
        funnel.join(rollup.drop("max_gap_between_rounds_days"), "application_id", "left")
        .join(fill, "application_id", "left")
        .join(reqs.select("req_id", "recruiter_id"), "req_id", "left")
        .select(
            "application_id",
            surrogate_key("applicant_id").alias("applicant_key"),
            surrogate_key("req_id").alias("requisition_key"),
            surrogate_key("recruiter_id").alias("recruiter_key"),
            date_key("applied_date").alias("applied_date_key"),
            "applicant_id",
            "req_id",
            "recruiter_id",
            "applied_date",
            "current_stage",
            "final_outcome",
            *[f"days_in_{s}" for s in STAGES],
            "total_days_to_decision",
            "stages_recorded",
            "was_dropped",
            "drop_stage",
            _or_zero("interview_count"),
            "max_interview_round",
            "avg_feedback_score",
            "min_feedback_score",
            _or_zero("distinct_interviewers"),
            (F.col("final_outcome") == "hired").alias("is_hired"),
            "actual_time_to_fill_days",
            "days_over_target",
            "missed_target",
        )
    )


def fact_offers(outcomes: DataFrame, apps: DataFrame, reqs: DataFrame) -> DataFrame:
    measures = [c for c in outcomes.columns if c not in ("offer_id", "application_id")]
    return (
        outcomes.join(apps.select("application_id", "applicant_id", "req_id"), "application_id", "left")
        .join(reqs.select("req_id", "recruiter_id"), "req_id", "left")
        .select(
            "offer_id",
            surrogate_key("applicant_id").alias("applicant_key"),
            surrogate_key("req_id").alias("requisition_key"),
            surrogate_key("recruiter_id").alias("recruiter_key"),
            date_key("offer_date").alias("offer_date_key"),
            "application_id",
            "applicant_id",
            "req_id",
            "recruiter_id",
            *measures,
        )
    )


def pace_rollup(pace: DataFrame) -> DataFrame:
    """Hires aggregated to their requisition; both flags and all days combine map-side."""
    days = "actual_time_to_fill_days"
    return pace.groupBy("req_id").agg(
        F.count(F.lit(1)).alias("hire_count"),
        exact_avg(days, 1).alias("avg_time_to_fill_days"),
        F.min(days).alias("min_time_to_fill_days"),
        F.max(days).alias("max_time_to_fill_days"),
        F.bool_or("missed_target").alias("any_hire_missed_target"),
        F.bool_and("missed_target").alias("all_hires_missed_target"),
    )


def activity_rollup(funnel: DataFrame) -> DataFrame:
    """Applications per requisition, by outcome, in one pass."""
    outcome = F.col("final_outcome")
    return funnel.groupBy("req_id").agg(
        F.count(F.lit(1)).alias("applications_received"),
        F.count_if(outcome == "hired").alias("hired_count"),
        F.count_if(outcome == "rejected").alias("rejected_count"),
        F.count_if(outcome == "withdrawn").alias("withdrawn_count"),
        F.count_if(outcome == "in_progress").alias("in_progress_count"),
        F.count_if("was_dropped").alias("dropped_count"),
    )


def fact_requisitions(reqs: DataFrame, funnel: DataFrame, pace: DataFrame) -> DataFrame:
    """One row per requisition. ``funnel`` needs req_id, final_outcome and was_dropped."""
    return (
        reqs.join(activity_rollup(funnel), "req_id", "left")
        .join(pace_rollup(pace), "req_id", "left")
        .select(
            "req_id",
            surrogate_key("req_id").alias("requisition_key"),
            surrogate_key("recruiter_id").alias("recruiter_key"),
            date_key("opened_date").alias("opened_date_key"),
            "recruiter_id",
            "hiring_manager_id",
            "department",
            "seniority_level",
            "location",
            "opened_date",
            "target_time_to_fill_days",
            _or_zero("applications_received"),
            _or_zero("hired_count"),
            _or_zero("rejected_count"),
            _or_zero("withdrawn_count"),
            _or_zero("in_progress_count"),
            _or_zero("dropped_count"),
            _or_zero("hire_count"),
            F.col("hire_count").isNotNull().alias("is_filled"),
            "avg_time_to_fill_days",
            "min_time_to_fill_days",
            "max_time_to_fill_days",
            "any_hire_missed_target",
            "all_hires_missed_target",
        )
    )
