"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..domain import DATE_SPINE_END, DATE_SPINE_START, NICHE_LOCATIONS
from ..functions import date_key, surrogate_key


def is_niche(location: Column | str, niche: tuple[str, ...] = NICHE_LOCATIONS) -> Column:
    return (F.col(location) if isinstance(location, str) else location).isin(*niche)


def dim_applicant(applicants: DataFrame) -> DataFrame:
    return applicants.select(
        surrogate_key("applicant_id").alias("applicant_key"),
        "applicant_id",
        F.col("source").alias("applicant_source"),
        "resume_years_experience",
        "education_level",
        "is_referral",
    )


def dim_requisition(reqs: DataFrame, niche: tuple[str, ...] = NICHE_LOCATIONS) -> DataFrame:
    return reqs.select(
        surrogate_key("req_id").alias("requisition_key"),
        "req_id",
        "department",
        "seniority_level",
        "location",
        is_niche("location", niche).alias("is_niche_location"),
        "recruiter_id",
        "hiring_manager_id",
        "target_time_to_fill_days",
        "opened_date",
    )


def dim_recruiter(reqs: DataFrame) -> DataFrame:
    """Recruiters as they appear on requisitions, with the number they own."""
    owned = reqs.filter(F.col("recruiter_id").isNotNull()).groupBy("recruiter_id")
    return owned.agg(F.count(F.lit(1)).alias("total_requisitions_owned")).select(
        surrogate_key("recruiter_id").alias("recruiter_key"), "recruiter_id", "total_requisitions_owned"
    )


def dim_date(
    spark: SparkSession, start: str = DATE_SPINE_START, end_exclusive: str = DATE_SPINE_END, pad: bool = False
) -> DataFrame:
    """Every day from ``start`` to the day before ``end_exclusive``; Sunday is day 0."""
    first, last = F.lit(start).cast("date"), F.date_sub(F.lit(end_exclusive).cast("date"), 1)
    return _calendar(spark.range(1).select(F.sequence(first, last).alias("days")), pad)


def dim_date_covering(dates: DataFrame, column: str, pad: bool = False) -> DataFrame:
    """The calendar years that ``column`` touches, whole."""
    span = dates.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    end = F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
    return _calendar(span.select(F.sequence(F.trunc("first", "year"), end).alias("days")), pad)


def _calendar(spine: DataFrame, pad: bool) -> DataFrame:
    """Calendar columns per day; ``pad`` blank-pads both names to nine characters."""
    days = spine.select(F.explode("days").alias("date_day"))
    weekday = F.dayofweek("date_day") - 1

    def name(pattern: str) -> Column:
        text = F.date_format("date_day", pattern)
        return F.rpad(text, 9, " ") if pad else text

    return days.select(
        date_key("date_day").alias("date_key"),
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        name("MMMM").alias("month_name"),
        F.dayofmonth("date_day").alias("day_of_month"),
        weekday.alias("day_of_week"),
        name("EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.trunc("date_day", "month").alias("first_day_of_month"),
    )
