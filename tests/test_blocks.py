"""Codes of several features, walks by masks, trees grown in one task, importance without repeated rows."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hirelens.ml import areas, blocks, boosting, importance
from hirelens.ml import train as training
from hirelens.ml.boosting import Feature, binned, fit_trees
from hirelens.ml.prep import TREES
from hirelens.ml.spec import OFFER_DECLINE
from hirelens.ml.train import TrainConfig, TrainedModel, train

FEATURES = (Feature("a", edges=(1.0, 2.0, 3.0)), Feature("b", edges=(0.5,)), Feature("c", levels=("x", "y", "z")))
LEAF = (None, None, None, None)


def rows_of(n, withheld):
    rng = random.Random(8)
    out = []
    for _ in range(n):
        a = None if rng.random() < 0.2 else rng.randrange(5) + 0.0
        b, c = float(rng.random() < 0.5), rng.choice(["x", "y", "z", "other", None])
        label = float(rng.random() < (0.85 if a is None else 0.2 + 0.3 * (c == "y") + 0.1 * (a > 2)))
        out.append((label, 0.7 if label else 1.3, rng.random() < withheld, a, b, c))
    return out


@pytest.mark.parametrize("withheld, depth", [(0.2, 3), (0.0, 2), (0.3, 7)])
def test_trees_grown_in_one_task_are_those_of_a_job_per_level(spark, monkeypatch, withheld, depth):
    df = spark.createDataFrame(rows_of(1500, withheld), "label double, weight double, withheld boolean, a double, b double, c string")
    data = binned(df.repartition(3), FEATURES)
    by_level = fit_trees(data, FEATURES, 6, 0.3, depth, 10, 4)
    calls, one = [], boosting._sums
    monkeypatch.setattr(boosting, "_sums", lambda *args: calls.append(args) or one(*args))
    in_one = fit_trees(data, FEATURES, 6, 0.3, depth, 10, 4, rows=1500)
    assert in_one == by_level and in_one.losses == by_level.losses and by_level.rounds > 0 and not calls
    monkeypatch.setattr(boosting, "FEW", 100)
    assert fit_trees(data, FEATURES, 1, depth=1, min_rows=5, rows=1500).rounds <= 1 and calls


def test_rows_that_are_alike_are_kept_once_however_many(spark):
    # more rows than one task keeps, but few that differ
    df = spark.range(3_000_000).selectExpr(
        "double(id % 3 = 0) as label", "1.0d as weight", "id % 10 = 0 as withheld", "double(id % 5) as a", "double(id % 2) as b", "'x' as c"
    )
    grown = fit_trees(binned(df, FEATURES), FEATURES, 2, depth=2, rows=3_000_000)
    assert len(grown.losses) == 3


@pytest.mark.parametrize("most", [1, 20, 2000])
def test_sums_over_shared_codes_are_those_of_each_feature(most):
    rng = np.random.default_rng(1)
    bins, n = [7, 3, 5, 2, 19], 4000
    coded = blocks.layout(bins, most)
    assert sorted(f for code in coded for f, *_ in code) == list(range(5))
    assert all(blocks._values(code) <= most for code in coded if len(code) > 1)
    placed = np.array([rng.integers(0, b, n) for b in bins], np.int32)
    g, h, times = rng.integers(-1 << 20, 1 << 20, n), rng.integers(0, 1 << 18, n), rng.integers(1, 9, n)
    feature, bits = np.array([4, -1, -1], np.int16), np.zeros((3, 19), np.uint8)
    bits[0, :8] = 1
    tree = feature, np.packbits(bits, axis=1), np.zeros(3)
    for levels, nodes, counted in itertools.product((0, 1), ([0], [2], [1, 2]), (None, times)):
        if levels == 0 and nodes != [0] or levels and nodes == [0]:
            continue
        at = np.zeros(n, int) if not levels else np.where(placed[4] < 8, 1, 2)
        total = blocks.Sums(tree, levels, nodes, coded)
        for part in np.array_split(np.arange(n), 3):
            total.add(blocks._coded(placed[:, part], coded), g[part], h[part], None if counted is None else counted[part])
        got = total.spread(5, 19)
        for k, node in enumerate(nodes):
            for f, b in enumerate(bins):
                for j in range(b):
                    hit = (at == node) & (placed[f] == j)
                    rows = hit.sum() if counted is None else counted[hit].sum()
                    assert got[k, f, j].tolist() == [g[hit].sum(), h[hit].sum(), rows]


@pytest.mark.parametrize("depth", [1, 3, 5, 6, 8])
def test_walks_end_where_the_splits_lead(depth):
    rng = np.random.default_rng(depth)
    bins, size = [4, 9, 3], (1 << (depth + 1)) - 1
    feature, bits = np.full(size, -1, np.int16), rng.integers(0, 2, (size, 9)).astype(np.uint8)
    for node in range((1 << depth) - 1):
        if (node == 0 or feature[(node - 1) // 2] >= 0) and rng.random() < 0.9:
            feature[node] = rng.integers(0, 3)
    placed = np.array([rng.integers(0, b, 500) for b in bins])
    for most in (1, 200):
        coded = blocks.layout(bins, most)
        walk = blocks.walker((feature, np.packbits(bits, axis=1), None), depth, coded)
        got = np.broadcast_to(walk(blocks._coded(placed, coded)), 500)
        for i in range(500):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + (1 if bits[node, placed[feature[node], i]] else 2)
            assert got[i] == node


def planted(spark, n):
    number = F.col("id") * 7919 % 100
    return spark.range(n).select(
        F.format_string("APP%06d", F.col("id")).alias("application_id"),
        F.when(number > 5, number.cast("double") / 80).alias("offer_to_band_ratio"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 30).alias("resume_years_experience"),
        *[F.element_at(F.array(*map(F.lit, ("x", "y", "it's"))), (F.col("id") % 3 + 1).cast("int")).alias(c) for c in ("candidate_source", "location")],
        F.lit("d").alias("department"),
        F.when(F.col("id") % 7 > 0, F.lit("mid")).alias("seniority_level"),
        (F.col("id") % 3 == 0).alias("referral_flag"),
        F.lit(True).alias("is_niche_location"),
        ((number < 60) & (F.col("id") % 13 > 3)).alias("label_offer_declined"),
    )


@pytest.mark.parametrize("depth", [5, 7])
def test_importance_of_trees_repeats_no_row_and_is_exact(spark, monkeypatch, depth):
    rng, rows = random.Random(3), []
    inner = [("offer_to_band_ratio", t, None, m) for t in (0.2, 0.7, float("inf")) for m in (True, False) if t < 1 or not m]
    inner += [("resume_years_experience", 11.0, None, True), ("location", None, "it's", False), ("seniority_level", None, "mid", False), ("referral_flag", 0.5, None, False)]
    for t in range(9):
        top = (1 << (depth if t else 0)) - 1
        rows += [(t, n, *(rng.choice(inner) if n < top else LEAF), None if n < top else rng.gauss(0, 1)) for n in range(2 * top + 1)]
    model = TrainedModel(OFFER_DECLINE, TREES, tuple(rows), -0.2)
    test, n = OFFER_DECLINE.labelled(planted(spark, 1200)), 1200
    want = importance.permutation_importance(model.score, test, OFFER_DECLINE, n, 0.7, 2).collect()
    result = training.TrainResult(model, {TREES: {"auc": 0.7}}, {"test": n}, 0.5, [], test)
    monkeypatch.setattr(importance, "shuffled_variants", lambda *_: pytest.fail("rows are repeated for every feature"))
    assert result.importance(TrainConfig(repeats=2)).collect() == want
    monkeypatch.setattr(importance, "ROWS", 100)  # many ranges
    assert result.importance(TrainConfig(repeats=2)).collect() == want


def test_areas_do_not_depend_on_bounds_or_blocks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.randrange(1, 3), float(rng.random() < 0.4), [rng.randrange(6) / 7, rng.random(), 0.5]) for _ in range(800)]
    rows += [(3, 1.0, [0.1, 0.2, 0.3])]
    df = spark.createDataFrame(rows, "repeat int, label double, scores array<double>").repartition(4)
    want = {}
    for repeat in (1, 2, 3):
        for place in range(3):
            pos, neg = ([s[place] for r, y, s in rows if r == repeat and y == label] for label in (1.0, 0.0))
            wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
            want[repeat, place] = wins / (len(pos) * len(neg)) if neg else None
    for bounds, size in (([], 1 << 16), ([0.5, 3 / 7, 0.5], 50), ([0.01 * k for k in range(100)], 7)):
        monkeypatch.setattr(areas, "ROWS", size)
        got = {(r["repeat"], r["place"]): r["auc"] for r in areas.areas(df, bounds).collect()}
        assert got == {k: v if v is None else pytest.approx(v, abs=1e-12) for k, v in want.items()}


def test_passes_over_the_training_rows_make_no_digest(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(training, "_fit", lambda rows, *_: seen.append(rows._jdf.queryExecution().optimizedPlan().toString()) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        train(planted(spark, 400), OFFER_DECLINE)
    assert "md5" not in seen[0] and "label" in seen[0]


def test_few_weights_of_a_block_are_stored_once():
    y, w = np.array([0, 1] * 50, np.uint8), np.array([0.7, 1.3] * 50)
    for weights in (w, np.arange(100) / 7, np.full(100, 2.0)):
        stored = blocks._weighed(y, weights)
        batch = pa.RecordBatch.from_pydict({c: [a.tobytes()] for c, a in zip("yw", stored)})
        back = blocks._labels(batch, 0)
        assert back[0].tolist() == y.tolist() and back[1].tolist() == weights.tolist()
    assert len(blocks._weighed(y, w)[1]) == 2
