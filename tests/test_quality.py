"""Clean rows pass every check; each corruption turns exactly its checks red."""

from datetime import date as D

import pytest
from pyspark.sql import functions as F

from hirelens.quality import (
    FEATURE_CHECKS,
    MART_CHECKS,
    MART_EXPECTATIONS,
    OWN_CHECKS,
    STAGING_CHECKS,
    QualityGateError,
    accepted_values,
    between,
    gate,
    implies,
    not_null,
    orphans,
    relationship,
    row_count,
    run_suite,
    summarise,
    unique,
)
from hirelens.plans.warehouse import Warehouse
from hirelens.sources.tpch_binding import Binding

SF = "/root/testdata/sf0.001"
SUITE_SIZES = {"staging": 27, "marts": 48, "features": 12, "expectations": 47}


def red(frames, checks):
    failed = run_suite(frames, checks).filter("not passed").collect()
    return {(r.table_name, r.check_name, r.column_name): r.unexpected for r in failed}


@pytest.fixture(scope="module")
def marts(spark):
    house = Warehouse(spark, Binding(spark, SF).contract())
    frames = {name: df.cache() for name, df in house.marts().items()}
    yield frames
    for df in frames.values():
        df.unpersist()


def test_suite_sizes():
    sizes = map(len, (STAGING_CHECKS, MART_CHECKS, FEATURE_CHECKS, MART_EXPECTATIONS))
    assert dict(zip(SUITE_SIZES, sizes)) == SUITE_SIZES


def test_clean_data_passes_the_gate(spark, marts):
    assert gate(run_suite(marts, MART_EXPECTATIONS)) == 47
    assert gate(run_suite(marts, [*MART_CHECKS, *OWN_CHECKS, *FEATURE_CHECKS])) == 61
    staged = Warehouse(spark, Binding(spark, SF).contract()).staged()
    results = run_suite(staged, STAGING_CHECKS)
    assert gate(results) == 27
    assert all(r.passed and r.passed_checks == r.total_checks for r in summarise(results).collect())


def swap(marts, table, **columns):
    first = F.col("_n") == 1
    numbered = marts[table].withColumn("_n", F.expr("row_number() over (order by 1)"))
    changed = numbered.withColumns({c: F.when(first, F.expr(v)).otherwise(F.col(c)) for c, v in columns.items()})
    return {**marts, table: changed.drop("_n")}


CORRUPTIONS = [
    ("fact_offers", {"offer_id": "cast(null as string)"}, {("not_null", "offer_id")}),
    ("fact_offers", {"decision": "'lost'"}, {("accepted_values", "decision")}),
    ("fact_offers", {"days_to_respond": "-1"}, {("between", "days_to_respond")}),
    ("fact_offers", {"application_id": "'nobody'"}, {("relationship", "application_id")}),
    ("fact_offers", {"recruiter_key": "'nobody'"}, {("relationship", "recruiter_key")}),
    ("fact_offers", {"offer_date_key": "20231231"}, {("relationship", "offer_date_key")}),
    ("fact_applications", {"min_feedback_score": "6"}, {("between", "min_feedback_score")}),
    ("fact_applications", {"avg_feedback_score": "cast(0.5 as decimal(24,3))"}, {("between", "avg_feedback_score")}),
    ("fact_applications", {"final_outcome": "'maybe'"}, {("accepted_values", "final_outcome")}),
    ("fact_applications", {"applicant_key": "'nobody'"}, {("relationship", "applicant_key")}),
    ("fact_requisitions", {"max_time_to_fill_days": "1001"}, {("between", "max_time_to_fill_days")}),
    (
        "fact_requisitions",
        {"all_hires_missed_target": "true", "any_hire_missed_target": "cast(null as boolean)"},
        {("implies", "all_hires_missed_target")},
    ),
]


@pytest.mark.parametrize("table, change, expected", CORRUPTIONS, ids=lambda x: str(x)[:40])
def test_corruption_is_caught(marts, table, change, expected):
    failed = red(swap(marts, table, **change), [c for c in MART_EXPECTATIONS if c.table == table])
    assert set(failed) == {(table, *e) for e in expected}
    assert set(failed.values()) == {1}


def test_duplicate_key_counts_every_copy(marts):
    twice = marts["dim_applicant"].unionByName(marts["dim_applicant"].limit(1))
    failed = red({**marts, "dim_applicant": twice}, [c for c in MART_EXPECTATIONS if c.table == "dim_applicant"])
    assert failed == {("dim_applicant", "unique", "applicant_key"): 2}


def test_label_without_an_offer(marts):
    frames = {
        "mart_ml_features": marts["mart_ml_features"].withColumn(
            "label_offer_declined",
            F.when(F.col("reached_offer_stage"), F.col("label_offer_declined")).otherwise(F.lit(True)),
        )
    }
    failed = red(frames, FEATURE_CHECKS)
    assert set(failed) == {
        ("mart_ml_features", "expression_true", "label_offer_declined iff reached_offer_stage")
    }


def test_gate_raises_with_the_failures(marts):
    bad = swap(marts, "fact_offers", days_to_respond="400")
    with pytest.raises(QualityGateError, match="fact_offers.days_to_respond between: 1 of"):
        gate(run_suite(bad, MART_EXPECTATIONS))


def test_null_rules_and_empty_tables(spark):
    schema = "k string, v int, a boolean, b boolean"
    rows = [(None, None, True, None), (None, 3, None, None), ("x", 9, False, None)]
    frames = {"t": spark.createDataFrame(rows, schema), "p": spark.createDataFrame([("x",)], "k string")}
    checks = [
        not_null("t", "k"),
        unique("t", "k"),
        accepted_values("t", "v", (3, 9)),
        between("t", "v", 0, 5),
        between("t", "v", 0, 5, mostly=0.5),
        implies("t", "a", "b"),
        relationship("t", "k", "p", "k"),
        row_count("t", 3),
        row_count("t", 10836),
    ]
    got = [(r.check_name, r.evaluated, r.unexpected, r.passed) for r in run_suite(frames, checks).collect()]
    assert sorted(got) == sorted(
        [
            ("not_null", 3, 2, False),
            ("unique", 1, 0, True),
            ("accepted_values", 2, 0, True),
            ("between", 2, 1, False),
            ("between", 2, 1, True),
            ("implies", 1, 1, False),
            ("relationship", 1, 0, True),
            ("row_count", 3, 0, True),
            ("row_count", 3, 10833, False),
        ]
    )
    empty = {**frames, "t": frames["t"].limit(0)}
    assert gate(run_suite(empty, checks[:7])) == 7


def test_orphans_lists_keys_with_their_rows(spark):
    child = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "k string")
    parent = spark.createDataFrame([("x",)], "id string")
    assert [tuple(r) for r in orphans(child, "k", parent, "id").collect()] == [("y", 2)]


def test_date_outside_the_calendar_is_an_orphan(spark):
    from .rows import ROWS, warehouse

    late = [*ROWS["applications"][:1], ("A2", "P2", "R1", D(2026, 1, 1), "offer", "hired")]
    frames = warehouse(spark, applications=late).marts()
    checks = [c for c in MART_EXPECTATIONS if c.table == "fact_applications" and c.kind == "relationship"]
    assert ("fact_applications", "relationship", "applied_date_key") in red(frames, checks)


def test_soiled_tables_and_csv_land_only_what_they_name(spark, tmp_path):
    import __spark_entry__ as registered
    from hirelens.plans.warehouse import Warehouse
    from hirelens.sources import Frames, Tables

    from .rows import warehouse

    whole, landed = warehouse(spark), []

    def land(name):
        landed.append(name)
        return whole.raw[name]

    house = Warehouse(spark, Frames(tuple(whole.raw), land), Tables(spark, str(tmp_path)))
    assert registered._soiled(house)["stg_offers"].count() >= 0 and landed == ["offers"] and not house.stored
    assert set(registered._soiled(house)["dim_applicant"].columns) and set(house.stored) == {"dim_applicant"}

    landed.clear()
    again = Warehouse(spark, Frames(tuple(whole.raw), land), Tables(spark, str(tmp_path)))
    monkey = registered._house
    registered._house = lambda *args, **kw: again
    try:
        got = registered.queries()["csv_round_trip_interviews"](spark, "")
    finally:
        registered._house = monkey
    assert landed == ["interviews"] and got.count() == whole.raw["interviews"].count()
