"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
LAZY = [n for n in QUERIES if not re.match("model_metrics|importance|score|dq_", n)]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def unbroadcast(spark):
    """Plans as they look when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins_and_no_python(unbroadcast, name):
    plan = physical(QUERIES[name](unbroadcast, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|CollectLimit", plan)


def test_scans_read_only_the_columns_they_need(unbroadcast):
    plan = physical(QUERIES["lifetime_load"](unbroadcast, SF))
    assert re.search(r"ReadSchema: struct<recruiter_id:string>", plan)
    labelled = QUERIES["signal_dwell"](unbroadcast, SF)
    plan = physical(labelled)
    assert "struct<max_stage_dwell_days:int,label_was_dropped:boolean>" in plan
    assert "GreaterThan(max_stage_dwell_days,0)" in plan


def test_top_k_keeps_k_rows_per_task(unbroadcast):
    assert "TakeOrderedAndProject" in physical(QUERIES["at_risk_topk"](unbroadcast, SF))


def test_hot_keys_combine_before_they_move(unbroadcast):
    """A partial aggregate stands below the exchange of every rollup."""
    for name in ("max_round_gap", "lifetime_load", "req_first_fill"):
        plan = physical(QUERIES[name](unbroadcast, SF))
        assert "partial_" in plan


def test_shuffles_start_with_partitions_for_the_input(spark):
    from hirelens.session import configure

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        configure(spark, shuffle_bytes=10**12)
        assert spark.conf.get(key) == "3726"
        configure(spark, shuffle_bytes=100 * 10**12)
        assert spark.conf.get(key) == "50000"
        configure(spark, shuffle_bytes=1)
        assert spark.conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.unset(key)


def test_hot_join_key_is_split_at_run_time(spark):
    """A third of all applications on one requisition: AQE splits that partition."""
    from pyspark.sql import functions as F

    from hirelens.plans.facts import fact_offers

    apps = spark.range(60000).select(
        F.concat(F.lit("A"), "id").alias("application_id"),
        F.concat(F.lit("P"), F.col("id") % 999).alias("applicant_id"),
        F.when(F.col("id") % 3 == 0, "R1").otherwise(F.concat(F.lit("R"), F.col("id") % 1000)).alias("req_id"),
    )
    reqs = spark.range(1000).select(F.concat(F.lit("R"), "id").alias("req_id"), F.lit("C1").alias("recruiter_id"))
    outcomes = apps.select(
        F.concat(F.lit("O"), "application_id").alias("offer_id"),
        "application_id",
        F.lit("2024-01-01").cast("date").alias("offer_date"),
        F.sha2("application_id", 512).alias("decision"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = fact_offers(outcomes, apps, reqs)
        assert facts.count() == 60000
        stored = facts.select("offer_id", "recruiter_key", "decision")
        stored.collect()
        assert "skew=true" in physical(stored)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_feature_mart_moves_rows_at_most_twelve_times(unbroadcast):
    plan = physical(QUERIES["ml_features"](unbroadcast, SF))
    assert plan.count("Exchange hashpartitioning") <= 12
    assert len(re.findall(r"FileScan parquet", plan)) <= 8


def test_interviews_are_scanned_once_for_both_marts(unbroadcast):
    house = entry._house(unbroadcast, SF)
    names = ("int_interview_visits", "int_interview_rollup", "fact_applications", "mart_ml_features")
    reads = {name: any("/raw/interviews/" in f for f in house.plan(name).inputFiles()) for name in names}
    assert reads == {name: name == "int_interview_visits" for name in names}
    assert physical(house.plan("int_interview_visits")).count("FileScan") == 1
