"""Business entities between staging and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..domain import BELOW_BAND_SHARE, STAGES
from ..functions import days_between, ratio_or_null, share_below
from ..operators import first_event, stage_pivot


def with_drop_flags(apps: DataFrame) -> DataFrame:
    """A drop is a withdrawal by the candidate; a rejection is not."""
    withdrawn = F.col("final_outcome") == "withdrawn"
    return apps.withColumns({"was_dropped": withdrawn, "drop_stage": F.when(withdrawn, F.col("current_stage"))})


def application_funnel(apps: DataFrame, history: DataFrame) -> DataFrame:
    """One row per application with its days in each stage and overall.

    An application without history spans 0 days and has null stage columns.
    """
    stages = stage_pivot(history, "application_id", "stage_name", "entered_date", "exited_date", STAGES)
    span = days_between(
        F.coalesce("last_end", "applied_date"), F.coalesce("first_start", "applied_date")
    )
    return (
        with_drop_flags(apps)
        .join(stages, "application_id", "left")
        .select(
            *apps.columns,
            *[f"days_in_{s}" for s in STAGES],
            span.alias("total_days_to_decision"),
            "stages_recorded",
            "was_dropped",
            "drop_stage",
        )
    )


def _hired_applications(hires: DataFrame, offers: DataFrame, apps: DataFrame) -> DataFrame:
    """Hire events resolved to their application and requisition."""
    return hires.join(offers.select("offer_id", "application_id"), "offer_id").join(
        apps.select("application_id", "req_id"), "application_id"
    )


def hire_pace(hires: DataFrame, offers: DataFrame, apps: DataFrame, reqs: DataFrame) -> DataFrame:
    """One row per hire: how long its requisition had been open, against target."""
    fill_days = days_between("start_date", "opened_date")
    return _hired_applications(hires, offers, apps).join(reqs, "req_id").select(
        "hire_id",
        "offer_id",
        "application_id",
        "req_id",
        "department",
        "seniority_level",
        "location",
        "recruiter_id",
        "hiring_manager_id",
        "opened_date",
        F.col("start_date").alias("filled_date"),
        "target_time_to_fill_days",
        fill_days.alias("actual_time_to_fill_days"),
        (fill_days - F.col("target_time_to_fill_days")).alias("days_over_target"),
        (fill_days > F.col("target_time_to_fill_days")).alias("missed_target"),
    )


def req_first_fill(hires: DataFrame, offers: DataFrame, apps: DataFrame) -> DataFrame:
    """Earliest start date per requisition."""
    return first_event(_hired_applications(hires, offers, apps), "req_id", "start_date", "filled_date")


def first_fill(pace: DataFrame) -> DataFrame:
    """``req_first_fill`` from hire pace, for requisitions that exist."""
    return first_event(pace, "req_id", "filled_date", "filled_date")


def req_windows(reqs: DataFrame, fills: DataFrame) -> DataFrame:
    """Requisitions with the date they were first filled, null while open."""
    return reqs.join(fills, "req_id", "left")


def offer_outcomes(offers: DataFrame) -> DataFrame:
    """Offer economics against the band midpoint, response time and outcome flags."""
    return offers.select(
        "offer_id",
        "application_id",
        "offer_date",
        "response_date",
        "offer_salary",
        "band_midpoint",
        (F.col("offer_salary") - F.col("band_midpoint")).alias("offer_vs_band_delta"),
        ratio_or_null("offer_salary", "band_midpoint", 4).alias("offer_to_band_ratio"),
        share_below("offer_salary", "band_midpoint", BELOW_BAND_SHARE).alias("is_below_band"),
        days_between("response_date", "offer_date").alias("days_to_respond"),
        "decision",
        (F.col("decision") == "accepted").alias("is_accepted"),
        F.col("decision").isin("declined", "expired").alias("is_declined"),
    )
