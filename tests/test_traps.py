"""Semantics that are easy to get wrong, on hand-written rows."""

from datetime import date as D
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hirelens.functions import date_key, exact_avg, percent, surrogate_key
from hirelens.plans.dims import dim_date
from hirelens.plans.features import recruiter_load

from .rows import ROWS, by, warehouse


@pytest.fixture(scope="module")
def house(spark):
    return warehouse(spark)


@pytest.fixture(scope="module")
def features(house):
    return by(house.plan("mart_ml_features"), "application_id")


def test_text_is_trimmed_of_spaces_only(house):
    rows = by(house.stg["applicants"], "applicant_id")
    assert rows["P1"].source == "referral" and rows["P1"].education_level == "phd"
    assert rows["P2"].source is None
    assert rows["P3"].source == "\tagency"


def test_missing_flags_are_false(house):
    assert by(house.stg["applicants"], "applicant_id")["P2"].is_referral is False
    visits = by(house.stg["interviews"], "interview_id")
    assert visits["I3"].is_completed is False
    assert visits["I1"].feedback_text == "ok" and visits["I2"].feedback_text is None


def test_funnel_without_history_spans_zero_days(house):
    rows = by(house.plan("int_application_funnel"), "application_id")
    assert rows["A4"].total_days_to_decision == 0
    assert rows["A4"].stages_recorded is None and rows["A4"].days_in_applied is None
    assert rows["A1"].total_days_to_decision == 3


def test_longest_of_repeated_stages_wins(house):
    row = by(house.plan("int_application_funnel"), "application_id")["A2"]
    assert (row.days_in_applied, row.days_in_screen, row.stages_recorded) == (13, 1, 3)


def test_drop_stage_only_for_withdrawals(house):
    rows = by(house.plan("int_application_funnel"), "application_id")
    assert rows["A3"].was_dropped and rows["A3"].drop_stage == "screen"
    assert not rows["A4"].was_dropped and rows["A4"].drop_stage is None


def test_expired_offer_is_declined_but_not_labelled_so(house, features):
    outcomes = by(house.plan("int_offer_outcomes"), "offer_id")
    assert outcomes["O5"].is_declined and features["A7"].label_offer_declined is False
    assert outcomes["O4"].is_declined and features["A6"].label_offer_declined is True
    assert features["A3"].label_offer_declined is None


def test_band_uses_exact_salary_not_rounded_ratio(house):
    rows = by(house.plan("int_offer_outcomes"), "offer_id")
    assert rows["O1"].offer_to_band_ratio == Decimal("0.9") and rows["O1"].is_below_band is False
    assert rows["O2"].offer_to_band_ratio == Decimal("0.9") and rows["O2"].is_below_band is True


def test_ratio_is_null_for_null_or_zero_midpoint(house):
    rows = by(house.plan("int_offer_outcomes"), "offer_id")
    for offer in ("O3", "O4"):
        assert rows[offer].offer_to_band_ratio is None and rows[offer].is_below_band is None


def test_interviews_count_unfinished_and_round_once(features):
    assert features["A1"].interview_rounds_completed == 3
    assert features["A1"].avg_feedback_score == Decimal("1.667")
    assert features["A1"].interviewer_count == 2
    assert features["A1"].max_gap_between_rounds_days == 3
    assert features["A2"].max_gap_between_rounds_days is None
    assert features["A3"].interview_rounds_completed == 0


def test_average_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(x,) for x in [1] * 1999 + [2]], "x int")
    assert df.agg(exact_avg("x", 3).alias("a")).first().a == Decimal("1.001")
    assert percent(F.lit(1), F.lit(0)) is not None
    assert spark.range(1).select(percent(F.lit(1), F.lit(0)).alias("p")).first().p is None


def test_unfilled_requisition_has_null_flags_and_zero_hires(house):
    rows = by(house.plan("fact_requisitions"), "req_id")
    assert rows["R2"].is_filled is False and rows["R2"].hire_count == 0
    assert rows["R2"].any_hire_missed_target is None and rows["R2"].all_hires_missed_target is None
    assert rows["R1"].hire_count == 2 and rows["R1"].is_filled
    assert rows["R1"].any_hire_missed_target is True and rows["R1"].all_hires_missed_target is False
    assert rows["R1"].avg_time_to_fill_days == Decimal("45.5")
    assert rows["R3"].min_time_to_fill_days == -29


def test_null_recruiter_gets_the_sentinel_key(spark, house):
    import hashlib

    sentinel = hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    assert by(house.plan("fact_requisitions"), "req_id")["R4"].recruiter_key == sentinel
    assert sentinel not in by(house.plan("dim_recruiter"), "recruiter_key")
    two = spark.sql("select 'a' x, cast(null as string) y").select(surrogate_key("x", "y").alias("k")).first().k
    assert two == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_unknown_requisition_keeps_the_application(house, features):
    row = by(house.plan("fact_applications"), "application_id")["A8"]
    assert row.recruiter_id is None and row.is_hired is False
    assert features["A8"].department is None and features["A8"].is_niche_location is None
    assert features["A8"].recruiter_concurrent_open_reqs == 0 and features["A8"].referral_flag is None


def brute_force_load(rows):
    reqs = {r[0]: r for r in rows["requisitions"]}
    offers = {o[0]: o[1] for o in rows["offers"]}
    apps = {a[0]: a for a in rows["applications"]}
    filled = {}
    for _, offer, start in rows["hires"]:
        req = apps[offers[offer]][2]
        filled[req] = min(start, filled.get(req, start))
    load = {}
    for app, _, req, at, *_ in rows["applications"]:
        owner = reqs[req][7] if req in reqs else None
        load[app] = sum(
            1
            for other in reqs.values()
            if owner is not None
            and other[7] == owner
            and other[0] != req
            and other[5] <= at
            and (other[0] not in filled or filled[other[0]] > at)
        )
    return load


def test_recruiter_load_equals_the_pairwise_count(house, features):
    expected = brute_force_load(ROWS)
    assert {a: r.recruiter_concurrent_open_reqs for a, r in features.items()} == expected
    loads = recruiter_load(house.stg["applications"], house.plan("int_req_windows"))
    assert {r.application_id: r.recruiter_concurrent_open_reqs for r in loads.collect()} == expected


def test_calendar_ends_before_its_end_and_starts_weeks_on_sunday(spark):
    days = by(dim_date(spark), "date_day")
    assert len(days) == 731 and D(2026, 1, 1) not in days and D(2023, 12, 31) not in days
    sunday = days[D(2024, 1, 7)]
    assert sunday.day_of_week == 0 and sunday.is_weekend and sunday.day_name == "Sunday"
    assert sunday.date_key == 20240107 and sunday.first_day_of_month == D(2024, 1, 1)
    padded = by(dim_date(spark, pad=True), "date_day")[D(2024, 5, 6)]
    assert padded.month_name == "May      " and padded.day_name == "Monday   "


def test_date_key_of_null_is_null(spark):
    assert spark.sql("select cast(null as date) d").select(date_key("d").alias("k")).first().k is None
