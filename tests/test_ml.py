"""Split, metrics, importance and the training job."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from hirelens.ml.importance import permuted, shuffled_variants
from hirelens.ml.metrics import classification_report, roc_auc
from hirelens.ml.prep import class_weights
from hirelens.ml.spec import DROP_OFF, MODELS, OFFER_DECLINE, TIME_TO_FILL, LeakageError
from hirelens.ml.split import stratified_split
from hirelens.ml.train import TrainConfig, importance_view, load, load_models, metrics_frame, save, save_report, train
from hirelens.operators import positions

FAST = TrainConfig(max_iter=50, rounds=5, repeats=2)


def pairwise_auc(rows):
    positives = [s for y, s in rows if y]
    negatives = [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    return wins / (len(positives) * len(negatives))


@pytest.mark.parametrize("levels, parts", [(7, 4), (10**6, 4), (10**6, 61), (1, 4)])
def test_auc_equals_pair_count(spark, levels, parts):
    rng = random.Random(levels)
    rows = [(rng.random() < 0.3, rng.randrange(levels) / levels) for _ in range(1500)]
    df = spark.createDataFrame(rows, "label boolean, score double").repartition(5)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = roc_auc(df, "label", "score").first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got.auc == pytest.approx(pairwise_auc(rows), abs=1e-12)
    assert got.positives + got.negatives == 1500


def test_auc_per_group_and_single_class(spark):
    rows = [("a", True, 0.9), ("a", False, 0.1), ("b", True, 0.1), ("b", False, 0.9), ("c", True, 0.5)]
    df = spark.createDataFrame(rows, "g string, label boolean, score double")
    assert {r.g: r.auc for r in roc_auc(df, "label", "score", ("g",)).collect()} == {"a": 1.0, "b": 0.0, "c": None}


def test_classification_report(spark):
    rows = [(1, 0.9), (1, 0.5), (1, 0.4), (0, 0.6), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = {r.row_name: r for r in classification_report(df, "label", "score", ("no", "yes")).collect()}
    assert (got["yes"].precision, got["yes"].recall, got["yes"].support) == pytest.approx((2 / 3, 2 / 3, 3))
    assert (got["no"].precision, got["no"].recall) == pytest.approx((1 / 2, 1 / 2))
    assert got["accuracy"].f1 == pytest.approx(0.6)
    assert got["macro avg"].f1 == pytest.approx((2 / 3 + 1 / 2) / 2)
    assert got["weighted avg"].f1 == pytest.approx((3 * 2 / 3 + 2 * 1 / 2) / 5)


def test_split_is_stratified_and_stable(spark):
    df = spark.range(20000).select(
        F.concat(F.lit("id"), "id").alias("id"), (F.col("id") % 10 == 0).cast("double").alias("label")
    )
    fit, test = stratified_split(df, "label", "id")
    shares = {r.label: r["count"] for r in test.groupBy("label").count().collect()}
    assert shares[1.0] == pytest.approx(500, abs=2) and shares[0.0] == pytest.approx(4500, abs=4)
    assert fit.count() + test.count() == 20000 and fit.join(test, "id").count() == 0
    again = stratified_split(df.repartition(13, F.rand()), "label", "id")[1]
    assert again.join(test, "id", "left_anti").count() == 0 and again.count() == test.count()


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1.0,)] * 2 + [(0.0,)] * 6, "label double")
    assert {r.label: r.weight for r in class_weights(df, "label").collect()} == {1.0: 2.0, 0.0: 8 / 12}


def test_leaking_features_are_refused():
    for spec in MODELS.values():
        spec.assert_no_leakage()
    for leak in ("final_outcome", "label_was_dropped", "days_to_respond"):
        bad = dataclasses.replace(DROP_OFF, numeric=(*DROP_OFF.numeric, leak))
        with pytest.raises(LeakageError, match=leak):
            bad.assert_no_leakage()
    assert [len(s.features) for s in (TIME_TO_FILL, DROP_OFF, OFFER_DECLINE)] == [5, 14, 8]


@pytest.fixture(scope="module")
def planted(spark):
    """Offers below band decline; nothing else matters."""
    x = F.xxhash64("id")
    ratio = F.lit(0.7) + F.pmod(x, F.lit(600)) / 1000
    noise = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100))
    return spark.range(3000).select(
        F.format_string("APN%05d", "id").alias("application_id"),
        F.when(F.col("id") % 50 != 0, ratio).cast("decimal(6,4)").alias("offer_to_band_ratio"),
        F.pmod(x, F.lit(17)).cast("decimal(5,1)").alias("resume_years_experience"),
        F.element_at(F.array(*map(F.lit, ("referral", "agency"))), (F.col("id") % 2 + 1).cast("int")).alias(
            "candidate_source"
        ),
        F.lit("data").alias("department"),
        F.when(F.col("id") % 9 != 0, F.lit("mid")).alias("seniority_level"),
        F.concat(F.lit("l"), F.col("id") % 5).alias("location"),
        (F.col("id") % 3 == 0).alias("referral_flag"),
        F.lit(False).alias("is_niche_location"),
        ((ratio < 0.9) & (noise < 85) | (noise > 95)).alias("label_offer_declined"),
    )


@pytest.fixture(scope="module")
def trained(planted):
    return train(planted, OFFER_DECLINE, FAST)


def test_training_finds_the_planted_signal(spark, trained, tmp_path):
    assert max(m["auc"] for m in trained.metrics.values()) > 0.85
    assert trained.rows["test"] == pytest.approx(750, abs=3)
    best = max(m["auc"] for m in trained.metrics.values())
    assert trained.metrics[trained.model.kind]["auc"] == best
    ranked = trained.importance(FAST)
    top = importance_view(ranked, 5).collect()
    assert len(top) == 5 and top[0].feature == "offer_to_band_ratio" and top[0]["mean"] > 0.2
    assert top[0].description == "offer relative to the band midpoint"
    assert trained.sample_predictions().count() == 4
    save_report(spark, trained, ranked, str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/{OFFER_DECLINE.name}/importance")
    assert stored.count() == 8
    report = spark.read.parquet(f"{tmp_path}/{OFFER_DECLINE.name}/metrics")
    assert sorted(report.collect()) == sorted(metrics_frame(spark, trained).collect())
    assert report.filter("section = 'selected'").count() == 1


def test_model_survives_saving_and_scores_unseen_and_missing_values(spark, planted, trained, tmp_path):
    save(trained.model, str(tmp_path))
    again = load(spark, str(tmp_path), OFFER_DECLINE.name)
    rows = planted.limit(50)
    assert again.score(rows).collect() == trained.model.score(rows).collect()
    odd = rows.limit(3).withColumns(
        {
            "location": F.lit("nowhere"),
            "department": F.lit(None).cast("string"),
            "offer_to_band_ratio": F.lit(None).cast("decimal(6,4)"),
            "referral_flag": F.lit(None).cast("boolean"),
        }
    )
    scored = again.score(odd, "p").collect()
    assert len(scored) == 3 and all(0 < r.p < 1 for r in scored)
    assert scored[0].offer_to_band_ratio is None and scored[0].referral_flag is None
    with pytest.raises(FileNotFoundError, match="time_to_fill_risk|drop_off_risk"):
        load_models(spark, str(tmp_path))


def test_shuffled_column_keeps_its_values(spark, planted):
    inputs = OFFER_DECLINE.labelled(planted)
    variants = shuffled_variants(inputs, OFFER_DECLINE, 3000, 2, 42).cache()
    assert variants.count() == 3000 * 2 * 8
    one = variants.filter("repeat = 2 and feature = 'resume_years_experience'")
    column = "resume_years_experience"

    def values(df):
        return sorted(df.groupBy(column).count().collect())

    assert values(one) == values(inputs)
    moved = one.alias("a").join(inputs.alias("b"), "application_id")
    assert moved.filter(f"a.{column} <> b.{column}").count() > 2000
    assert moved.filter("a.location <> b.location").count() == 0
    variants.unpersist()


def test_donors_are_any_rows_and_do_not_depend_on_partitions(spark, planted):
    inputs = OFFER_DECLINE.labelled(planted).withColumn("resume_years_experience", F.xxhash64("application_id").cast("double"))
    seen = set()
    for n in (1, 7, 64):
        variants = shuffled_variants(inputs.repartition(n), OFFER_DECLINE, 3000, 2, 42)
        rows = variants.filter("feature = 'resume_years_experience'")
        seen.add(tuple(rows.selectExpr("count(*)", "sum(xxhash64(repeat, application_id, resume_years_experience) % 1000003)").first()))
    assert len(seen) == 1 and next(iter(seen))[0] == 6000
    lent = rows.join(inputs.select("resume_years_experience", F.col("application_id").alias("donor")), "resume_years_experience")
    far = lent.selectExpr("repeat", "abs(int(substr(donor, 4)) - int(substr(application_id, 4))) as d").groupBy("repeat")
    for r in far.agg(F.avg("d").alias("mean"), F.max("d").alias("most"), F.count("*").alias("n")).collect():
        assert r["mean"] == pytest.approx(1000, rel=0.1) and r["most"] > 2700 and r["n"] == 3000  # as for chance


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permuted_places_are_a_permutation(spark, n):
    places = spark.range(n).select(*[permuted(F.col("id"), F.lit(k), n).alias(k) for k in ("a", "b")]).collect()
    for k in ("a", "b"):
        assert sorted(r[k] for r in places) == list(range(n))
    if n > 100:
        assert sum(r["a"] == r["b"] for r in places) < n / 20 and sum(r["a"] == i for i, r in enumerate(places)) < n / 20


def test_running_sums_over_many_values_are_dealt_by_ranges(spark, monkeypatch):
    stored, cut = [], positions.cut_lineage
    monkeypatch.setattr(positions, "cut_lineage", lambda df: stored.append(cut(df)) or stored[-1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.range(1_000_000).selectExpr("id / 1e6 as score", "1L as n", "id").repartition(9)
        got = positions.sum_before(df, "score", "n")
        assert got.filter("before <> id").count() == 0 and got.count() == 1_000_000
        assert stored[0].groupBy("_part").count().agg(F.max("count")).first()[0] < 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_class_is_an_error(spark, planted):
    with pytest.raises(ValueError, match="both classes"):
        train(planted.filter("label_offer_declined"), OFFER_DECLINE, FAST)


def test_split_does_not_depend_on_partitions(spark):
    ids = spark.range(300_000).selectExpr("id", "cast(id % 3 = 0 as double) as label")
    seen = set()
    for n in (1, 7, 64):
        _, test = stratified_split(ids.repartition(n), "label", "id")
        seen.add(tuple(test.selectExpr("count(*) as n", "sum(xxhash64(id) % 1000003) as s").first()))
        assert {r["label"]: r["count"] for r in test.groupBy("label").count().collect()} == {0.0: 50_000, 1.0: 25_000}
    assert len(seen) == 1
