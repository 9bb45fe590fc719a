"""Apply a model to whole tables; keep, rank or look up rows of the result.

A ``scorer`` adds a probability column to a frame: ``TrainedModel.score`` or any
function of the same shape.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ml.spec import DROP_OFF, OFFER_DECLINE, ModelSpec
from ..operators import lifetime_load, load_as_of
from .recommend import recommend_dropout, recommend_fill, recommend_offer

Scorer = Callable[[DataFrame, str], DataFrame]
LOAD = "recruiter_concurrent_open_reqs"


def open_requisitions(
    fact_reqs: DataFrame,
    dim_req: DataFrame,
    stg_reqs: DataFrame,
    load: str = "lifetime",
    windows: DataFrame | None = None,
    as_of: datetime.date | None = None,
) -> DataFrame:
    """Unfilled requisitions with what the fill model needs.

    ``load="lifetime"`` counts every other requisition the recruiter ever had,
    the approximation at-risk lists use; the model was trained on a point-in-time
    load. ``load="as_of"`` counts those open on ``as_of`` and needs ``windows``,
    requisitions with their first fill date.
    """
    open_reqs = fact_reqs.filter(~F.col("is_filled")).select(
        "req_id",
        "department",
        "seniority_level",
        "location",
        "target_time_to_fill_days",
        "recruiter_id",
        "opened_date",
    )
    if load == "lifetime":
        loads, own = lifetime_load(stg_reqs, "recruiter_id", LOAD), F.lit(0)
    elif load == "as_of" and windows is not None and as_of is not None:
        loads = load_as_of(windows, "recruiter_id", "opened_date", "filled_date", as_of, LOAD)
        own = F.when(F.col("recruiter_id").isNotNull() & (F.col("opened_date") <= F.lit(as_of)), 1).otherwise(0)
    else:
        raise ValueError('load is "lifetime", or "as_of" with windows and a date')
    niche = dim_req.select("req_id", "is_niche_location")
    return (
        open_reqs.join(niche, "req_id")
        .join(loads, "recruiter_id", "left")
        .select(
            "req_id",
            "department",
            "seniority_level",
            "location",
            "is_niche_location",
            "target_time_to_fill_days",
            (F.coalesce(LOAD, F.lit(0).cast("long")) - own).alias(LOAD),
        )
    )


def rank_at_risk(scored: DataFrame, limit: int = 20, score: str = "fill_risk_score") -> DataFrame:
    """The riskiest rows with their recommendation; ties go to the lower id.

    Sort and limit plan as one TakeOrderedAndProject; the rules run on the rows
    that are left.
    """
    top = scored.withColumn(score, F.round(score, 4)).orderBy(F.desc(score), "req_id").limit(limit)
    return top.withColumn(
        "recommended_action",
        recommend_fill(F.col(score), F.col("is_niche_location"), F.col("seniority_level"), F.col(LOAD)),
    )


def score_open_requisitions(open_reqs: DataFrame, scorer: Scorer, limit: int = 20) -> DataFrame:
    return rank_at_risk(scorer(open_reqs, "fill_risk_score"), limit)


def at_risk_view(at_risk: DataFrame) -> DataFrame:
    return at_risk.select(
        "req_id",
        "department",
        F.col("seniority_level").alias("seniority"),
        "location",
        F.col("is_niche_location").alias("niche"),
        F.col("fill_risk_score").alias("fill_risk"),
        F.col("recommended_action.risk_band").alias("band"),
    )


def _plain(df: DataFrame, spec: ModelSpec) -> Column:
    """The features a model saw, decimals as doubles and NaN as null."""

    def plain(name: str, dtype: str) -> Column:
        c = F.col(name)
        if dtype.startswith("decimal"):
            c = c.cast("double")
        elif dtype in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        return c.alias(name)

    types = dict(df.dtypes)
    return F.struct(*[plain(c, types[c]) for c in spec.features])


def _only(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    return df if ids is None else df.join(ids.select(key), key, "left_semi")


def missing_ids(ids: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Requested ids that ``df`` does not have."""
    return ids.select(key).distinct().join(df.select(key), key, "left_anti")


def score_applications(features: DataFrame, scorer: Scorer, ids: DataFrame | None = None) -> DataFrame:
    """Drop-off risk of all applications, or of those in ``ids``."""
    name = "dropout_risk_score"
    scored = scorer(_only(features, ids, "application_id"), name).withColumn(name, F.round(name, 4))
    return scored.select(
        "application_id",
        name,
        _plain(features, DROP_OFF).alias("features"),
        recommend_dropout(
            F.col(name), F.col("max_stage_dwell_days"), F.col("interview_rounds_completed")
        ).alias("recommended_action"),
    )


def score_offers(
    fact_offers: DataFrame, features: DataFrame, scorer: Scorer, ids: DataFrame | None = None
) -> DataFrame:
    """Decline risk of all offers, or of those in ``ids``."""
    name = "decline_risk_score"
    offers = _only(fact_offers.select("offer_id", "application_id"), ids, "offer_id")
    scored = scorer(offers.join(features, "application_id"), name).withColumn(name, F.round(name, 4))
    return scored.select(
        "offer_id",
        "application_id",
        name,
        _plain(features, OFFER_DECLINE).alias("features"),
        recommend_offer(F.col(name), F.col("offer_to_band_ratio"), F.col("referral_flag")).alias(
            "recommended_action"
        ),
    )
