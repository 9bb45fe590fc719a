"""Do the signals the models rely on show in the data? Group contrasts and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..domain import LONG_DWELL_DAYS, NICHE_LOCATIONS, SENIOR_LEVELS, SENIORITY
from ..functions import exact_avg, percent
from ..operators import group_contrast


def signal_referral(fact_offers: DataFrame, dim_applicant: DataFrame) -> DataFrame:
    """Offers accepted: referred candidates against the rest."""
    per_applicant = fact_offers.groupBy("applicant_key").agg(
        F.count(F.lit(1)).alias("offers"), F.count_if("is_accepted").alias("accepted")
    )
    known = per_applicant.join(dim_applicant.select("applicant_key", "is_referral"), "applicant_key")
    return group_contrast(
        known, F.col("is_referral"), F.col("accepted"), "referral", "non_referral", rows=F.col("offers")
    )


def signal_band(fact_offers: DataFrame) -> DataFrame:
    """Offers declined or expired: below 90 % of the band midpoint against the rest."""
    below = F.coalesce("is_below_band", F.lit(False))
    return group_contrast(fact_offers, below, F.col("is_declined"), "below_band", "at_or_above_band")


def signal_dwell(features: DataFrame) -> DataFrame:
    """Withdrawals: a stage longer than ten days against one to ten days."""
    dwell = F.col("max_stage_dwell_days")
    return group_contrast(
        features.filter(dwell > 0), dwell > LONG_DWELL_DAYS, F.col("label_was_dropped"), "long_dwell", "short_dwell"
    )


def _filled(pace: DataFrame) -> DataFrame:
    return pace.filter(F.col("actual_time_to_fill_days") >= 0)


def signal_niche(pace: DataFrame, niche: tuple[str, ...] = NICHE_LOCATIONS) -> DataFrame:
    """Fill targets missed: senior roles in niche locations against all other hires."""
    hard = F.col("seniority_level").isin(*SENIOR_LEVELS) & F.col("location").isin(*niche)
    return group_contrast(
        _filled(pace), F.coalesce(hard, F.lit(False)), F.col("missed_target"), "senior_niche", "others"
    )


def seniority_pace(pace: DataFrame) -> DataFrame:
    """Target and actual fill days per level, junior first."""
    missed = F.col("missed_target").cast("int")
    order = F.array_position(F.array(*map(F.lit, SENIORITY)), F.col("seniority_level"))
    return (
        _filled(pace)
        .filter(F.col("seniority_level").isin(*SENIORITY))
        .groupBy("seniority_level")
        .agg(
            F.count(F.lit(1)).alias("n_hires"),
            exact_avg("target_time_to_fill_days", 1).cast("double").alias("avg_target"),
            exact_avg("actual_time_to_fill_days", 1).cast("double").alias("avg_actual"),
            exact_avg(missed, 1).cast("double").alias("miss_rate"),
        )
        .orderBy(order)
    )


def outcome_distribution(apps: DataFrame) -> DataFrame:
    """Share of each outcome in percent; the window sees one row per outcome."""
    counted = apps.filter(F.col("final_outcome").isNotNull()).groupBy("final_outcome").agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counted.select("final_outcome", "n", percent(F.col("n"), total, 1).cast("double").alias("value"))


def signal_report(
    fact_offers: DataFrame, dim_applicant: DataFrame, features: DataFrame, pace: DataFrame, apps: DataFrame
) -> DataFrame:
    """All signals as one long frame (signal, grp, n, value, gap)."""
    contrasts = {
        "referral_accept": signal_referral(fact_offers, dim_applicant),
        "below_band_decline": signal_band(fact_offers),
        "long_dwell_withdrawal": signal_dwell(features),
        "senior_niche_miss": signal_niche(pace),
        "outcome_share": outcome_distribution(apps).withColumnRenamed("final_outcome", "grp"),
    }
    levels = seniority_pace(pace)
    for measure in ("avg_target", "avg_actual", "miss_rate"):
        contrasts[f"seniority_{measure}"] = levels.select(
            F.col("seniority_level").alias("grp"), F.col("n_hires").alias("n"), F.col(measure).alias("value")
        )
    no_gap = F.lit(None).cast("double")
    return reduce(
        DataFrame.unionByName,
        [
            df.select(
                F.lit(signal).alias("signal"), "grp", "n", "value", ("gap" if "gap" in df.columns else no_gap.alias("gap"))
            )
            for signal, df in contrasts.items()
        ],
    )
