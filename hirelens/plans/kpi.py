"""Headline figures and the small reports around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg, percent, rate

COUNTS = ("total_applications", "total_offers", "total_hires", "total_requisitions")
RATES = (
    "overall_hire_rate",
    "overall_offer_accept_rate",
    "overall_dropout_rate",
    "avg_time_to_fill_days",
    "target_miss_rate",
    "referral_accept_rate",
    "non_referral_accept_rate",
)


def _rows() -> Column:
    return F.count(F.lit(1))


def _applications(facts: DataFrame) -> DataFrame:
    missed = F.col("missed_target")
    return facts.agg(
        _rows().alias("total_applications"),
        F.count_if(F.col("final_outcome") == "hired").alias("total_hires"),
        rate(F.col("final_outcome") == "hired").alias("overall_hire_rate"),
        rate(F.col("was_dropped")).alias("overall_dropout_rate"),
        exact_avg("actual_time_to_fill_days", 1).alias("avg_time_to_fill_days"),
        rate(missed, missed.isNotNull()).alias("target_miss_rate"),
    )


def _offers(facts: DataFrame, applicants: DataFrame) -> DataFrame:
    """Offer counts; acceptance by referral looks the applicant up.

    Offers shrink to one row per applicant before that lookup, so an applicant
    with very many offers is combined on the map side. Offers of unknown
    applicants still count in the totals.
    """
    per_applicant = facts.groupBy("applicant_key").agg(
        _rows().alias("offers"), F.count_if("is_accepted").alias("accepted")
    )
    known = applicants.select("applicant_key", "is_referral")
    joined = per_applicant.join(known, "applicant_key", "left")

    def total(column: str, where: Column | None = None) -> Column:
        value = F.col(column) if where is None else F.when(where, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0).cast("long"))

    referral = F.col("is_referral")
    return joined.agg(
        total("offers").alias("total_offers"),
        percent(total("accepted"), total("offers")).alias("overall_offer_accept_rate"),
        percent(total("accepted", referral), total("offers", referral)).alias("referral_accept_rate"),
        percent(total("accepted", ~referral), total("offers", ~referral)).alias("non_referral_accept_rate"),
    )


def kpi_summary(
    fact_apps: DataFrame, fact_offers: DataFrame, fact_reqs: DataFrame, dim_applicant: DataFrame
) -> DataFrame:
    """One row of totals and percentages; a rate over nothing is null.

    Each fact is read once; the three one-row results fold into one row.
    """
    parts = (
        _applications(fact_apps)
        .unionByName(_offers(fact_offers, dim_applicant), allowMissingColumns=True)
        .unionByName(fact_reqs.agg(_rows().alias("total_requisitions")), allowMissingColumns=True)
    )
    order = (*COUNTS, *RATES)
    folded = parts.agg(*[F.max(c).alias(c) for c in order])
    return folded.select(*COUNTS, *[F.col(c).cast("double").alias(c) for c in RATES])


def kpi_view(kpis: DataFrame) -> DataFrame:
    """The summary as (section, metric, value) rows: totals, rates, the referral pair."""
    pair = {"referral_accept_rate": "referral", "non_referral_accept_rate": "non_referral"}
    rows = (
        [("totals", c, c) for c in COUNTS]
        + [("rates", c, c) for c in RATES if c not in pair]
        + [("accept_rate", label, c) for c, label in pair.items()]
    )
    return kpis.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(section).alias("section"),
                        F.lit(metric).alias("metric"),
                        F.col(c).cast("double").alias("value"),
                    )
                    for section, metric, c in rows
                ]
            )
        )
    )


def outcome_counts(apps: DataFrame) -> DataFrame:
    """Applications per outcome, most frequent first."""
    return (
        apps.groupBy("final_outcome")
        .agg(_rows().alias("application_count"))
        .orderBy(F.desc("application_count"), "final_outcome")
    )
