"""Tables stored in buckets of their application are joined and rolled up without moving again."""

import re

import pytest

import __spark_entry__ as entry
from hirelens.sources import Tables
from hirelens.sources.tpch_binding import Binding

from .test_plans import physical


def moves(df):
    return len(re.findall(r"\bExchange\b", physical(df)))


@pytest.fixture(scope="module")
def driver(spark, tmp_path_factory):
    """Driver tables with orders without lines, repeated lines, null keys and a null priority."""
    folder = str(tmp_path_factory.mktemp("driver"))
    orders = [(k, k % 5, "FPO"[k % 3], f"{1 + k % 5}-X") for k in range(1, 60)] + [(None, 1, "F", "1-X")]
    lines = [
        (k, n, (k * 7 + n) % 9, k % 4, float(n + k % 3), "NRA"[k % 3])
        for k in range(1, 56) for n in range(1, 1 + k % 6) for _ in range(1 + (k + n) % 2)
    ] + [(None, 3, 1, 1, 2.0, "N"), (5, None, 1, 1, 2.0, "N"), (9, 4, 2, 1, None, "R")]
    tables = {
        "customer": ([(k, "BUILDING", k % 3) for k in range(5)], "c_custkey long, c_mktsegment string, c_nationkey int"),
        "part": ([(k, 1 + k) for k in range(8)], "p_partkey long, p_size int"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "lineitem": (
            lines,
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_bucketed_table_under_a_root_groups_without_an_exchange(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('k', id % 7) as k")
    stored = Tables(spark, str(tmp_path), buckets=4).write(df, "raw", "things", ("k",))
    again = Tables(spark, str(tmp_path), buckets=4).write(df.filter("id < 50"), "raw", "things", ("k",))
    assert moves(stored.groupBy("k").count()) == 0
    assert rows(again) == rows(Tables(spark, str(tmp_path)).read("raw", "things")) == rows(df.filter("id < 50"))


def test_application_tables_move_once(spark, driver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        house = entry._house(spark, driver)
        for name in ("int_application_funnel", "int_interview_visits", "int_interview_rollup"):
            assert moves(house.plan(name)) == 0, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("dirty", [False, True])
def test_stored_tables_hold_the_rows_of_the_plans(spark, driver, dirty):
    house, lazy = entry._house(spark, driver, dirty), Binding(spark, driver, dirty)
    for name in house.raw:
        assert rows(house.raw[name]) == rows(lazy.contract()[name]), name
    plain = entry.Warehouse(spark, lazy.contract())
    for name in ("int_application_funnel", "int_interview_rollup", "mart_ml_features", "fact_applications"):
        assert rows(house.table(name)) == rows(plain.plan(name)), name


def test_orders_are_joined_with_their_lines_once(spark, driver, tmp_path):
    kept = []
    tables = Tables(spark, str(tmp_path))
    binding = Binding(spark, driver, keep=lambda df: kept.append(df) or tables.write(df, "raw", "orders"))
    for name in ("applications", "offers", "hires"):
        assert "lineitem" not in physical(binding.contract()[name])
    assert len(kept) == 1


def test_the_widest_lookup_of_the_feature_mart_comes_last(spark, driver):
    """Days per stage are one number, and the requisition's texts are not there yet, when a row moves to its applicant."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(entry._house(spark, driver).plan("mart_ml_features"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(applicant_id" in line or "Exchange hashpartitioning(req_id" in line]
    assert len(moved) == 4
    assert plan.index("hashpartitioning(req_id") < plan.index("hashpartitioning(applicant_id")  # the top of a plan is its end


@pytest.mark.parametrize("dirty", [False, True])
def test_lines_move_once_for_all_tables_that_start_from_them(spark, driver, tmp_path, dirty):
    kept = []
    tables = Tables(spark, str(tmp_path), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        binding = Binding(
            spark, driver, dirty,
            keep_lines=lambda df: kept.append(df) or tables.write(df, "raw", "lines", ("application_id",)),
        )
        for name in ("stage_history", "interviews"):
            assert moves(binding.contract()[name]) == 0, name
        assert "lineitem" not in physical(binding.contract()["applications"])
        assert len(kept) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
