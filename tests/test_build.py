"""CSV to marts, re-runnable and gated."""

import csv
import os

import pytest

from hirelens.ml.spec import MODELS
from hirelens.plans.kpi import kpi_summary, kpi_view
from hirelens.plans.warehouse import MARTS, build, open_warehouse
from hirelens.quality import QualityGateError
from hirelens.schemas import CONTRACT
from hirelens.sources import Tables, land_raw, layer_name, read_contract_csv, row_counts, write_csv

from .rows import ROWS, warehouse


def write_inputs(folder, **replace):
    os.makedirs(folder, exist_ok=True)
    for table, rows in {**ROWS, **replace}.items():
        with open(f"{folder}/{table}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(CONTRACT[table].names)
            out.writerows(rows)
    return str(folder)


# rows that pass every check
CLEAN = {
    "applicants": [(*r[:1], "referral", *r[2:]) for r in ROWS["applicants"]],
    "requisitions": [(*r[:7], r[7] or "C3") for r in ROWS["requisitions"]],
    "applications": [r for r in ROWS["applications"] if r[0] in ("A1", "A2", "A3", "A4", "A7")],
    "offers": [r for r in ROWS["offers"] if r[0] in ("O1", "O2", "O5")],
    "hires": [r for r in ROWS["hires"] if r[0] in ("H1", "H2")],
}


def test_build_lands_checks_and_is_idempotent(spark, tmp_path):
    src = write_inputs(tmp_path / "in", **CLEAN)
    tables = Tables(spark, str(tmp_path / "out"))
    assert not tables.is_built()
    landed = build(spark, src, tables)
    assert landed["applications"] == 5 and landed["total"] == sum(v for k, v in landed.items() if k != "total")
    assert build(spark, src, tables) is None
    assert build(spark, src, tables, force=True) == landed
    house = open_warehouse(spark, tables)
    expected = warehouse(spark, **CLEAN)
    for name in MARTS:
        stored = house.table(name)
        assert stored.columns == expected.plan(name).columns
        assert sorted(map(str, stored.collect())) == sorted(map(str, expected.plan(name).collect()))
    kpis = kpi_summary(
        *[house.table(t) for t in ("fact_applications", "fact_offers", "fact_requisitions", "dim_applicant")]
    )
    row = kpis.first()
    assert (row.total_applications, row.total_hires, row.overall_hire_rate) == (5, 2, 40.0)
    assert (row.target_miss_rate, row.avg_time_to_fill_days) == (50.0, 45.5)
    assert kpi_view(kpis).count() == 11
    assert spark.table("stg_hires").count() == 2


def test_strict_build_stops_before_the_marts(spark, tmp_path):
    doubled = {**CLEAN, "hires": CLEAN["hires"] * 2}
    src = write_inputs(tmp_path / "in", **doubled)
    tables = Tables(spark, str(tmp_path / "out"))
    with pytest.raises(QualityGateError, match="stg_hires.hire_id unique"):
        build(spark, src, tables)
    assert not os.path.exists(tmp_path / "out" / "marts")
    assert build(spark, src, tables, strict=False)["hires"] == 4


def test_catalog_tables_may_be_bucketed(spark, tmp_path):
    src = write_inputs(tmp_path / "in", **CLEAN)
    tables = Tables(spark, buckets=4)
    build(spark, src, tables)
    assert spark.table("marts.fact_requisitions").count() == 5
    facts, features = tables.read("marts", "fact_applications"), tables.read("marts", "mart_ml_features")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = facts.select("application_id").join(features.select("application_id"), "application_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for layer in ("raw", "intermediate", "marts", "state"):
            spark.sql(f"drop database {layer} cascade")


def test_missing_file_is_named(spark, tmp_path):
    src = write_inputs(tmp_path / "in", **CLEAN)
    os.remove(f"{src}/hires.csv")
    with pytest.raises(FileNotFoundError, match="hires.csv"):
        build(spark, src, Tables(spark, str(tmp_path / "out")))


def test_malformed_row_fails_the_load(spark, tmp_path):
    src = write_inputs(tmp_path / "in", hires=[("H1", "O1", "not a date")])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_contract_csv(spark, src, "hires").collect()


def test_csv_round_trip_binds_by_position(spark, tmp_path):
    house = warehouse(spark)
    write_csv(house.raw["applicants"], str(tmp_path / "applicants.csv"))
    again = read_contract_csv(spark, str(tmp_path), "applicants")
    assert again.schema == CONTRACT["applicants"]
    rows = {r.applicant_id: r for r in again.collect()}
    assert rows["P1"].referral_flag is True and rows["P2"].referral_flag is None
    with open(tmp_path / "hires.csv", "w") as f:
        f.write("a,b,c\nH1,O1,2024-01-01\nH2,,2024-01-02\n")
    hires = read_contract_csv(spark, str(tmp_path), "hires").collect()
    assert hires[0].hire_id == "H1" and hires[1].offer_id is None


def test_row_counts_and_layer_names(spark):
    house = warehouse(spark)
    counts = {r.table_name: r.row_count for r in row_counts(house.raw).collect()}
    assert counts["applications"] == 8 and counts["total"] == sum(map(len, ROWS.values()))
    assert layer_name(" marts ", "public") == "marts" and layer_name(None, "public") == "public"
    assert set(MODELS) == {"time_to_fill_risk", "drop_off_risk", "offer_decline_risk"}


def test_failed_gate_fails_again(spark, tmp_path):
    bad = [(*r[:5], -1.0, *r[6:]) if i == 0 and isinstance(r[5], float) else r for i, r in enumerate(CLEAN["offers"])]
    broken = {**CLEAN, "applications": [*CLEAN["applications"], CLEAN["applications"][0]], "offers": bad}
    src, tables = write_inputs(tmp_path / "in", **broken), Tables(spark, str(tmp_path / "out"))
    for _ in range(2):
        with pytest.raises(QualityGateError):
            build(spark, src, tables)
    assert not tables.is_built()
    good = write_inputs(tmp_path / "good", **CLEAN)
    assert build(spark, good, tables) is not None and tables.is_built()
    with pytest.raises(QualityGateError):
        build(spark, src, tables, force=True)
    assert not tables.is_built()


def test_csv_keeps_quotes_line_breaks_and_spaces(spark, tmp_path):
    texts = ['said ""great"", hire'.replace('""', '"'), "two\nlines, one field", " lead ", 'a "quoted" end"', "back\\slash"]
    frame = read_contract_csv(spark, write_inputs(tmp_path / "in", **CLEAN), "interviews")
    text = [f.name for f in frame.schema if f.name == "feedback_text"][0]
    row = frame.first().asDict()
    want = [{**row, "interview_id": f"I{i}", text: t} for i, t in enumerate(texts)]
    planted = spark.createDataFrame([tuple(w[c] for c in frame.columns) for w in want], frame.schema)
    write_csv(planted, str(tmp_path / "again" / "interviews.csv"))
    back = read_contract_csv(spark, str(tmp_path / "again"), "interviews")
    assert sorted((r["interview_id"], r[text]) for r in back.collect()) == [(w["interview_id"], w[text]) for w in want]


def test_large_free_text_is_read_by_many_tasks(spark, tmp_path):
    many = [(f"I{i}", *CLEAN.get("interviews", ROWS["interviews"])[0][1:]) for i in range(2000)]
    whole = write_inputs(tmp_path / "whole", **{**CLEAN, "interviews": many})
    parts = write_inputs(tmp_path / "parts", **CLEAN)
    os.remove(f"{parts}/interviews.csv")
    write_csv(read_contract_csv(spark, whole, "interviews").repartition(5), f"{parts}/interviews.csv")

    def landed(src, name, **options):
        tables = Tables(spark, str(tmp_path / name))
        assert land_raw(spark, src, tables, **options)["interviews"] == len(many)
        return sorted(map(str, tables.read("raw", "interviews").collect()))

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(f"{whole}/interviews.csv", lineSep="\n").rdd.getNumPartitions() > 3
        assert landed(whole, "a") == landed(whole, "b", multi_line=()) == landed(parts, "c")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
