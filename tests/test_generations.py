"""Published builds: readers keep a whole one, runs resume where they stopped, content decides."""

import os
import re
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hirelens import job
from hirelens.domain import Vocabulary
from hirelens.ml.spec import MODELS
from hirelens.ml.train import TrainConfig
from hirelens.plans import warehouse as plans
from hirelens.plans.warehouse import MARTS, build, open_warehouse
from hirelens.quality import QualityGateError
from hirelens.sources import Ledger, Tables, fingerprint, inputs_key, signature

from .test_build import CLEAN, write_inputs

MORE = {**CLEAN, "interviews": []}
BAD = {**CLEAN, "applications": [*CLEAN["applications"], CLEAN["applications"][0]]}


def contents(house):
    return {name: sorted(map(str, house.table(name).collect())) for name in (*MARTS, "int_hire_pace")}


def test_readers_keep_the_whole_old_build_after_a_failed_one(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "out"))
    with pytest.raises(LookupError, match="no build is published"):
        open_warehouse(spark, tables)
    build(spark, write_inputs(tmp_path / "good", **CLEAN), tables)
    old = contents(open_warehouse(spark, tables))
    bad = write_inputs(tmp_path / "bad", **BAD)
    held = open_warehouse(spark, tables)
    for force in (True, False, True):
        with pytest.raises(QualityGateError):
            build(spark, bad, tables, force=force)
        assert not tables.is_built()
        assert contents(open_warehouse(spark, tables)) == old == contents(held)
    # the good inputs are published again, though they are not new: a build that failed stands between
    assert build(spark, str(tmp_path / "good"), tables) is not None and tables.is_built()
    assert contents(open_warehouse(spark, tables)) == old == contents(held)
    generations = os.listdir(tmp_path / "out" / "generations")
    assert len(generations) == 2  # the current one and the one before; the failed ones are gone


def test_an_interrupted_build_is_not_seen_and_resumes(spark, tmp_path, monkeypatch):
    src, tables = write_inputs(tmp_path / "in", **CLEAN), Tables(spark, str(tmp_path / "out"))
    stored, store = [], plans.Warehouse.store

    def stop_at(name):
        def run(self, table):
            if table == name:
                raise KeyboardInterrupt
            stored.append(table)
            return store(self, table)

        monkeypatch.setattr(plans.Warehouse, "store", run)

    stop_at(plans.FEATURE_MART)
    with pytest.raises(KeyboardInterrupt):
        build(spark, src, tables)
    assert len(stored) == 13 and not tables.is_built()
    with pytest.raises(LookupError):
        open_warehouse(spark, tables)
    stored.clear()
    landed = []
    monkeypatch.setattr(plans, "land", lambda *a: landed.append(a))
    stop_at(None)
    assert build(spark, src, tables)["applications"] == 5
    assert stored == [plans.FEATURE_MART] and not landed
    whole = Tables(spark, str(tmp_path / "again"))
    monkeypatch.undo()
    build(spark, src, whole)
    assert contents(open_warehouse(spark, tables)) == contents(open_warehouse(spark, whole))


def test_content_decides_whether_to_build(spark, tmp_path):
    src, tables = write_inputs(tmp_path / "in", **CLEAN), Tables(spark, str(tmp_path / "out"))
    assert build(spark, src, tables) is not None
    write_inputs(tmp_path / "in", **{**CLEAN, "applicants": CLEAN["applicants"][::-1]})  # new files, same rows
    assert build(spark, src, tables) is None
    first = tables.current().generation
    changed = [(*r[:3], r[3] + 1, *r[4:]) if r[3] else r for r in CLEAN["applicants"]]
    write_inputs(tmp_path / "in", **{**CLEAN, "applicants": changed})
    assert build(spark, src, tables) is not None
    assert tables.current().generation != first
    years = open_warehouse(spark, tables).table("dim_applicant").agg(F.sum("resume_years_experience")).first()[0]
    assert years == sum(r[3] for r in changed if r[3])
    assert build(spark, src, tables, strict=False) is not None  # other parameters are another build


def test_catalog_generations_and_views(spark, tmp_path):
    tables = Tables(spark, buckets=2)
    try:
        build(spark, write_inputs(tmp_path / "a", **CLEAN), tables)
        first = tables.current()
        assert spark.table("marts.fact_offers").count() == first.read("marts", "fact_offers").count() == 3
        with pytest.raises(QualityGateError):
            build(spark, write_inputs(tmp_path / "b", **BAD), tables)
        assert spark.table("marts.fact_offers").count() == 3 and tables.current() == first
        assert open_warehouse(spark, tables).table("dim_applicant").count() == 3
    finally:
        for db in [d.name for d in spark.catalog.listDatabases() if re.match("raw|intermediate|marts|state", d.name)]:
            spark.sql(f"drop database `{db}` cascade")


def test_fingerprints_see_rows_not_order(spark):
    rows = [(i, None if i % 3 else str(i), float(i)) for i in range(1000)] * 2
    df = spark.createDataFrame(rows, "a int, b string, c double")

    def of(frame):
        return tuple(fingerprint(frame).first())

    assert of(df) == of(df.orderBy(F.desc("c")).repartition(9)) and of(df)[0] == 2000
    assert of(df) != of(df.limit(1999)) and of(df) != of(df.withColumn("c", F.when(F.col("a") != 5, F.col("c"))))
    assert of(df.limit(0)) == (0, "0", "0")
    left, right = (spark.createDataFrame([r], "a string, b string") for r in (("x", None), (None, "x")))
    assert of(left) != of(right)
    assert inputs_key({"x": df}) != inputs_key({"y": df}) != inputs_key({"y": df}, strict=True)
    assert inputs_key({"x": df, "y": left}) == inputs_key({"y": left, "x": df.repartition(3)})


def test_file_signatures_change_with_the_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a").write_text("one")
    first = signature(spark, str(tmp_path / "t"), str(tmp_path / "missing"))
    assert len(first) == 1 and first == signature(spark, str(tmp_path / "t"))
    (tmp_path / "t" / "a").write_text("other")
    assert signature(spark, str(tmp_path / "t")) != first


def test_ledger_resumes_only_the_last_build_of_the_same_inputs(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"), "state.unused")
    one = ledger.begin("a" * 64)
    assert ledger.begin("a" * 64) == one and ledger.begin("a" * 64, fresh=True) != one
    two = ledger.begin("b" * 64)
    ledger.append(two, "published", "b" * 64)
    assert ledger.begin("b" * 64) != two and ledger.current().generation == two
    assert one in ledger.outdated(1) and two not in ledger.outdated(1)


def many(n=160):
    """Clean contract rows with both classes of all three labels."""
    day, rows = date(2024, 2, 1), {t: [] for t in CLEAN} | {t: [] for t in ("stage_history", "interviews")}
    for i in range(n):
        outcome = ("hired", "rejected", "withdrawn", "withdrawn")[i % 4]
        start = day + timedelta(days=i % 30)
        rows["applicants"].append((f"P{i}", ("referral", "agency")[i % 2], start, Decimal(i % 9), "master", i % 2 == 0))
        rows["requisitions"].append((f"R{i}", "Data", "mid", ("remote", "reno")[i % 2], 40, day, "M1", f"C{i % 5}"))
        rows["applications"].append((f"A{i}", f"P{i}", f"R{i}", start, "offer", outcome))
        rows["stage_history"].append((f"A{i}", "applied", start, start + timedelta(days=i % 12)))
        rows["interviews"].append((f"I{i}", f"A{i}", 1, "V1", start + timedelta(days=2), True, 1 + i % 5, "fine"))
        if i % 2:
            rows["interviews"].append((f"J{i}", f"A{i}", 2, "V2", start + timedelta(days=3 + i % 6), True, 2, None))
        if i % 4 < 2:
            decision = "accepted" if i % 4 == 0 else "declined"
            offered = start + timedelta(days=9)
            rows["offers"].append((f"O{i}", f"A{i}", offered, 90_000 + i, 100_000, offered + timedelta(days=4), decision))
        if i % 4 == 0:
            rows["hires"].append((f"H{i}", f"O{i}", start + timedelta(days=20 + i % 60)))
    return rows


def test_a_killed_run_trains_only_what_is_missing(spark, tmp_path, monkeypatch):
    rows = many()
    src, tables = write_inputs(tmp_path / "in", **rows), Tables(spark, str(tmp_path / "out"))
    config = TrainConfig(max_iter=20, rounds=2, repeats=1)
    trained, train = [], job.train

    def killed_at(name):
        def run(mart, spec, config):
            if spec.name == name:
                raise KeyboardInterrupt
            trained.append(spec.name)
            return train(mart, spec, config)

        monkeypatch.setattr(job, "train", run)

    names = list(MODELS)
    killed_at(names[1])
    with pytest.raises(KeyboardInterrupt):
        job.run(spark, src, tables, config)
    assert trained == names[:1] and tables.is_built() and not job.is_complete(tables, config)
    with pytest.raises(LookupError, match=names[1]):
        job.open_models(spark, tables, config)
    killed_at(None)
    assert job.run(spark, src, tables, config) == [f"train {n}" for n in names[1:]]
    assert trained == names and job.is_complete(tables, config)
    assert job.run(spark, src, tables, config) == []
    models = job.open_models(spark, tables, config)
    house = open_warehouse(spark, tables)
    assert models[names[0]].score(house.table(plans.FEATURE_MART)).filter("score between 0 and 1").count() == 160
    report = spark.read.parquet(job.models_folder(house.tables) + f"/{names[2]}/metrics")
    assert report.filter("section = 'selected'").count() == 1
    write_inputs(tmp_path / "in", **{**rows, "interviews": rows["interviews"][1:]})
    assert job.run(spark, src, tables, config) == ["build", *[f"train {n}" for n in names]]


def test_a_build_takes_its_own_vocabulary_and_dates(spark, tmp_path):
    def later(rows):
        return [tuple(v.replace(year=2031) if isinstance(v, date) else v for v in r) for r in rows]

    from .rows import ROWS

    own = {t: later(r) for t, r in {**ROWS, **CLEAN}.items()}
    own["applicants"] = [(*r[:1], "radio", *r[2:]) for r in own["applicants"]]
    src, tables = write_inputs(tmp_path / "in", **own), Tables(spark, str(tmp_path / "out"))
    with pytest.raises(QualityGateError, match="source accepted_values"):
        build(spark, src, tables)
    vocabulary = Vocabulary(sources=("radio",), niche_locations=("remote",), first_day="2030-01-01", end_day="2033-01-01")
    assert build(spark, src, tables, vocabulary=vocabulary) is not None
    house = open_warehouse(spark, tables)
    days = house.table("dim_date").agg(F.min("date_day"), F.max("date_day")).first()
    assert tuple(map(str, days)) == ("2030-01-01", "2032-12-31")
    niche = {r["location"] for r in house.table("dim_requisition").filter("is_niche_location").collect()}
    assert niche == {"remote"}
