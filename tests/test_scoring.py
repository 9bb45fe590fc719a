"""Rules, ranking, lookups and the at-risk list."""

from datetime import date as D

import pytest
from pyspark.sql import functions as F

from hirelens.scoring import (
    at_risk_view,
    missing_ids,
    open_requisitions,
    rank_at_risk,
    recommend_dropout,
    recommend_fill,
    recommend_offer,
    risk_band,
    score_applications,
    score_offers,
)
from hirelens.scoring.recommend import ADVICE

from .rows import by, warehouse


def constant(score):
    return lambda df, out: df.withColumn(out, F.lit(score))


def one(spark, sql, rule):
    return spark.sql(f"select {sql}").select(rule().alias("r")).first().r


def test_band_edges(spark):
    df = spark.createDataFrame([(0.3999,), (0.40,), (0.5999,), (0.60,)], "s double")
    assert [r[0] for r in df.select(risk_band(F.col("s"))).collect()] == ["low", "elevated", "elevated", "high"]


def fill():
    return recommend_fill(F.col("s"), F.col("n"), F.col("l"), F.col("o"))


def drop():
    return recommend_dropout(F.col("s"), F.col("d"), F.col("r"))


def offer():
    return recommend_offer(F.col("s"), F.col("ratio"), F.col("ref"))


@pytest.mark.parametrize(
    "rule, row, advice, reasons",
    [
        (fill, "0.2d s, true n, 'senior' l, 300 o", "fill_low", 0),
        (fill, "0.5d s, true n, 'senior' l, 249 o", "fill_niche", 2),
        (fill, "0.5d s, false n, 'mid' l, 250 o", "fill_other", 2),
        (fill, "0.5d s, cast(null as boolean) n, cast(null as string) l, cast(null as int) o", "fill_other", 1),
        (drop, "0.1d s, 30 d, 0 r", "dropout_low", 0),
        (drop, "0.7d s, 10 d, 0 r", "dropout_stalled", 2),
        (drop, "0.7d s, 9 d, 1 r", "dropout_other", 1),
        (drop, "0.7d s, cast(null as int) d, cast(null as int) r", "dropout_other", 1),
        (offer, "0.1d s, 0.5 ratio, false ref", "offer_low", 0),
        (offer, "0.6d s, 0.8999 ratio, false ref", "offer_below_band", 2),
        (offer, "0.6d s, 0.9000 ratio, true ref", "offer_other", 1),
        (offer, "0.6d s, cast(null as double) ratio, cast(null as boolean) ref", "offer_other", 1),
    ],
)
def test_rules(spark, rule, row, advice, reasons):
    got = one(spark, row, rule)
    assert got.recommendation == ADVICE[advice] and len(got.rationale) == reasons and got.is_heuristic


def test_reason_texts(spark):
    assert one(spark, "0.6d s, 0.885 ratio, true ref", offer).rationale == ["offer is 88% of the band midpoint"]
    assert one(spark, "0.6d s, 0.875 ratio, true ref", offer).rationale == ["offer is 88% of the band midpoint"]
    assert one(spark, "0.6d s, 12.7d d, 3 r", drop).rationale == ["one stage has lasted 12 days"]
    assert one(spark, "0.6d s, true n, 'staff' l, 300 o", fill).rationale == [
        "niche location with few candidates",
        "staff roles take longer to fill",
        "recruiter has 300 other open requisitions",
    ]


@pytest.fixture(scope="module")
def house(spark):
    return warehouse(spark)


def test_only_open_requisitions_with_both_loads(house):
    facts, dim, stg = house.plan("fact_requisitions"), house.plan("dim_requisition"), house.stg["requisitions"]
    lifetime = by(open_requisitions(facts, dim, stg), "req_id")
    assert set(lifetime) == {"R2", "R4", "R5"}
    loads = {k: r.recruiter_concurrent_open_reqs for k, r in lifetime.items()}
    assert loads == {"R2": 2, "R4": 0, "R5": 0}
    day = D(2024, 1, 20)
    as_of = by(open_requisitions(facts, dim, stg, "as_of", house.plan("int_req_windows"), day), "req_id")
    assert {k: r.recruiter_concurrent_open_reqs for k, r in as_of.items()} == {"R2": 1, "R4": 0, "R5": 0}
    with pytest.raises(ValueError):
        open_requisitions(facts, dim, stg, "as_of")


def test_ties_at_the_cut_go_to_the_lower_id(spark):
    df = spark.range(100).select(
        F.format_string("R%03d", "id").alias("req_id"),
        F.lit("data").alias("department"),
        F.lit("mid").alias("seniority_level"),
        F.lit("reno").alias("location"),
        F.lit(True).alias("is_niche_location"),
        F.lit(40).alias("target_time_to_fill_days"),
        F.lit(3).alias("recruiter_concurrent_open_reqs"),
        F.when(F.col("id") == 50, 0.9).otherwise(0.70001).alias("fill_risk_score"),
    )
    top = rank_at_risk(df.repartition(7), 3).collect()
    assert [r.req_id for r in top] == ["R050", "R000", "R001"]
    assert top[1].fill_risk_score == 0.7
    view = at_risk_view(rank_at_risk(df, 3))
    assert view.columns == ["req_id", "department", "seniority", "location", "niche", "fill_risk", "band"]


def test_scores_for_requested_ids_and_the_missing_ones(spark, house):
    features = house.plan("mart_ml_features")
    ids = spark.createDataFrame([("A1",), ("A1",), ("nobody",)], "application_id string")
    scored = score_applications(features, constant(0.65), ids).collect()
    assert [r.application_id for r in scored] == ["A1"]
    assert scored[0].features.avg_feedback_score == pytest.approx(1.667)
    assert scored[0].recommended_action.risk_band == "high"
    assert [r[0] for r in missing_ids(ids, features, "application_id").collect()] == ["nobody"]
    offers = by(score_offers(house.plan("fact_offers"), features, constant(0.45)), "offer_id")
    assert set(offers) == {"O1", "O2", "O3", "O4", "O5"}
    assert offers["O2"].features.offer_to_band_ratio == 0.9
    assert offers["O2"].recommended_action.recommendation == ADVICE["offer_other"]
