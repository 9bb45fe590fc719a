"""Boosted trees against a booster in plain Python; ranks, dictionaries and models as tables."""

import math
import random
import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from hirelens.ml import boosting, ranks, vocabulary
from hirelens.ml.boosting import Feature, Trees, binned, fit_trees, margin_sql
from hirelens.ml.linear import Linear
from hirelens.ml.prep import TREES
from hirelens.ml.spec import OFFER_DECLINE
from hirelens.ml.train import TrainedModel, load, save

ODD = [0.0, -0.0, 1.5, -1.5, 1e300, -1e300, 5e-324, math.inf, -math.inf, None, math.nan]


def plain_value(v):
    return None if v is None or math.isnan(v) else v + 0.0


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_ranks_and_medians_are_exact(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice(ODD) if rng.random() < 0.3 else rng.gauss(0, 10) ** 3, float(rng.randrange(4)), None) for _ in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    want = [sorted(v for v in map(plain_value, column) if v is not None) for column in zip(*rows)]
    codes = ranks.order_codes(df, ["a", "b", "c"])
    found = ranks.select_ranks(codes, {i: range(len(w)) for i, w in enumerate(want) if w})
    assert {i: [v for _, v in sorted(f.items())] for i, f in found.items()} == {i: w for i, w in enumerate(want) if w}
    middle, edges = ranks.summaries(codes, ["a", "b", "c"], 4)
    assert middle["b"] == statistics.median(want[1]) and middle["c"] is None and edges["c"] == ()
    assert edges["b"] == tuple(sorted({want[1][math.ceil(n * k / 4) - 1] for k in (1, 2, 3)} - {want[1][-1]} if n >= 4 else set(want[1]) - {want[1][-1]}))
    assert all(e < max(want[0]) for e in edges["a"])


def test_levels_are_dense_and_too_many_are_refused_before_a_collect(spark, monkeypatch):
    rows = [("b", None), ("a", "x"), (None, "x"), ("b'", "y")]
    df = spark.createDataFrame(rows, "u string, v string")
    known = vocabulary.levels(df, ["u", "v"])
    assert known == {"u": ("a", "b", "b'"), "v": ("x", "y")}
    odd = spark.createDataFrame([("a", "new"), (None, None)], "u string, v string")
    hot = [(r["u_hot"], r["v_hot"]) for r in vocabulary.one_hot(odd, known).collect()]
    assert hot == [([1, 0, 0], [0, 0]), ([0, 0, 0], [0, 0])]
    with pytest.raises(vocabulary.TooManyLevels, match="u has 3 levels"):
        vocabulary.levels(df, ["u", "v"], most=2)


def plain_boost(rows, features, rounds, rate, depth, min_rows, patience):
    """rows: (label, weight, withheld, bins). The same trees by loops over rows."""
    unit = boosting.UNIT
    train = [r for r in rows if not r[2]]
    base = math.log(sum(w for y, w, *_ in train if y) / sum(w for y, w, *_ in train if not y))
    margins, trees, losses = [base] * len(rows), [], []

    def goes_left(feature, at, missing_left, bins):
        b = bins[feature]
        if features[feature].levels is not None:
            return b == at
        return missing_left if b == 0 else b <= at

    def grow(node, members, sums, tree, level):
        best = None
        if level < depth:
            for f, feature in enumerate(features):
                number = feature.levels is None
                has_missing = any(rows[i][3][f] == 0 for i in members)
                ats = range(1, feature.bins)
                if not number:
                    options = [(b, False) for b in ats]
                elif has_missing:
                    options = [(b, False) for b in ats] + [(b, True) for b in list(ats)[:-1]]
                else:
                    options = [(b, None) for b in list(ats)[:-1]]
                for b, side in options:
                    left = [i for i in members if goes_left(f, b, bool(side), rows[i][3])]
                    inside = set(left)
                    right = [i for i in members if i not in inside]
                    sl, sr = (tuple(sum(slopes[i][k] for i in part) for k in (0, 1)) for part in (left, right))
                    if min(len(left), len(right)) < min_rows or min(sl[1], sr[1]) / unit <= boosting.MIN_CURVATURE:
                        continue
                    gain = (sl[0] / unit) ** 2 / (sl[1] / unit) + (sr[0] / unit) ** 2 / (sr[1] / unit)
                    gain -= (sums[0] / unit) ** 2 / (sums[1] / unit)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                        best = (gain, f, b, len(left) >= len(right) if side is None else side, left, right, sl, sr)
        if best is None:
            tree[node] = -rate * sums[0] / sums[1]
            return
        _, f, b, side, left, right, sl, sr = best
        tree[node] = (f, b, side)
        grow(2 * node + 1, left, sl, tree, level + 1)
        grow(2 * node + 2, right, sr, tree, level + 1)

    def value(tree, bins):
        node = 0
        while isinstance(tree[node], tuple):
            node = 2 * node + (1 if goes_left(*tree[node], bins) else 2)
        return tree[node]

    for _ in range(rounds + 1):
        slopes = []
        loss = 0
        for (y, w, withheld, _), m in zip(rows, margins):
            p = 1 / (1 + math.exp(-m))
            s = -m if y else m
            if withheld:
                loss += math.floor(w * (max(s, 0.0) + math.log1p(math.exp(-abs(s)))) * unit + 0.5)
            slopes.append((math.floor(w * (p - y) * unit + 0.5), math.floor(w * p * (1 - p) * unit + 0.5)))
        if len(train) < len(rows):
            losses.append(loss / unit)
            best = losses.index(min(losses))
            if len(losses) - 1 - best >= patience or len(losses) > rounds:
                return base, trees[:best], losses
        if len(trees) == rounds:
            return base, trees, losses
        members = [i for i, r in enumerate(rows) if not r[2]]
        tree = {}
        grow(0, members, tuple(sum(slopes[i][k] for i in members) for k in (0, 1)), tree, 0)
        trees.append(tree)
        margins = [m + value(tree, r[3]) for m, r in zip(margins, rows)]


FEATURES = (Feature("a", edges=(1.0, 2.0, 3.0)), Feature("b", edges=(0.5,)), Feature("c", levels=("x", "y", "z")))


def planted_rows(n=300, withheld=0.2):
    rng = random.Random(6)
    out = []
    for _ in range(n):
        a = None if rng.random() < 0.2 else rng.randrange(5) + 0.0
        b, c = float(rng.random() < 0.5), rng.choice(["x", "y", "z", "other", None])
        p = 0.85 if a is None else 0.2 + 0.3 * (c == "y") + 0.1 * (a > 2)
        out.append((float(rng.random() < p), rng.choice([0.7, 1.3]), rng.random() < withheld, a, b, c))
    return out


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "label double, weight double, withheld boolean, a double, b double, c string")


@pytest.mark.parametrize("withheld, rounds, patience", [(0.2, 40, 4), (0.0, 6, 10), (0.2, 5, 10)])
def test_trees_equal_plain_python(spark, withheld, rounds, patience):
    rows = planted_rows(withheld=withheld)
    data = binned(frame_of(spark, rows), FEATURES)
    coded = [tuple(r) for r in data.collect()]
    assert [r[3] for r in coded[:50]] == [
        [0 if a is None else 1 + sum(e < a for e in (1, 2, 3)), 1 + int(b), {"x": 1, "y": 2, "z": 3}.get(c, 0)] for *_, a, b, c in rows[:50]
    ]
    got = fit_trees(data.repartition(5), FEATURES, rounds, 0.3, 3, 10, patience)
    base, trees, losses = plain_boost(coded, FEATURES, rounds, 0.3, 3, 10, patience)
    assert got.base == pytest.approx(base, abs=1e-5) and got.rounds == len(trees)
    assert got.losses == pytest.approx(losses, abs=1e-4)
    for t, tree in enumerate(trees):
        mine = {n.node: n for n in got.nodes if n.tree == t}
        assert set(mine) == set(tree)
        for node, want in tree.items():
            if isinstance(want, tuple):
                assert (mine[node].feature, mine[node].bin, mine[node].missing_left) == want
            else:
                assert mine[node].value == pytest.approx(want, abs=1e-5)


def test_absence_is_split_on_itself_and_partitions_do_not_matter(spark):
    rows = planted_rows(2000, 0.0)
    data = binned(frame_of(spark, rows), FEATURES)
    one, many = (fit_trees(data.repartition(n), FEATURES, 3, depth=2) for n in (1, 9))
    assert one == many
    root = one.rows()[0]
    assert root[2] == "a" and root[3] == math.inf and root[5] is False  # the missing against all others


def test_sql_of_trees_and_weights_is_the_same_in_both_engines(spark):
    rows = planted_rows(400)
    data = frame_of(spark, rows)
    trees = fit_trees(binned(data, FEATURES), FEATURES, 8, 0.3, 3, 5)
    assert trees.rounds > 0
    linear = Linear(((None, None, 0.25, None), ("a", None, -0.5, 1.5), ("c", "x", 0.75, None), ("c", "it's", 2.0, None), ("b", None, 0.1, 0.0)))
    con = duckdb.connect()
    con.execute("create table t (id int, a double, b double, c varchar)")
    con.executemany("insert into t values (?, ?, ?, ?)", [(i, *r[3:]) for i, r in enumerate(rows)])
    numbered = spark.createDataFrame([(i, *r[3:]) for i, r in enumerate(rows)], "id int, a double, b double, c string")
    for text in (margin_sql(trees.base, trees.rows()), linear.margin_sql()):
        theirs = dict(con.execute(f"select id, {text} from t").fetchall())
        ours = {r["id"]: r["m"] for r in numbered.select("id", F.expr(text).alias("m")).collect()}
        assert ours == pytest.approx(theirs)
    walked = {}
    for i, r in enumerate(data.select(F.array(*[f.bin() for f in FEATURES]).alias("bins")).collect()):
        total = trees.base
        for t in range(trees.rounds):
            nodes = {n.node: n for n in trees.nodes if n.tree == t}
            at = 0
            while nodes[at].feature >= 0:
                n, b = nodes[at], r["bins"][nodes[at].feature]
                number = FEATURES[n.feature].levels is None
                left = (n.missing_left if b == 0 else b <= n.bin) if number else b == n.bin
                at = 2 * at + (1 if left else 2)
            total += nodes[at].value
        walked[i] = total
    assert dict(con.execute(f"select id, {margin_sql(trees.base, trees.rows())} from t").fetchall()) == pytest.approx(walked)


def test_stored_tree_models_read_back(spark, tmp_path):
    rows = ((0, 0, "offer_to_band_ratio", 0.9, None, True, None), (0, 1, None, None, None, None, 0.5), (0, 2, None, None, None, None, -0.25))
    model = TrainedModel(OFFER_DECLINE, TREES, rows, 0.1)
    save(model, str(tmp_path))
    assert load(spark, str(tmp_path), OFFER_DECLINE.name) == model
    assert Trees(FEATURES, 0.5, ()).rounds == 0 and margin_sql(0.5, []) == "0.5e0"


def test_margins_are_not_written_tree_by_tree(spark, monkeypatch):
    stored, cut = [], boosting.cut_lineage
    monkeypatch.setattr(boosting, "cut_lineage", lambda df: stored.append(cut(df)) or stored[-1])
    trees = fit_trees(binned(frame_of(spark, planted_rows(400, 0.0)), FEATURES), FEATURES, 2 * boosting.CUT_EVERY + 1, depth=1, min_rows=5)
    assert trees.rounds == 2 * boosting.CUT_EVERY + 1 and len(stored) == 1


def test_many_trees_are_walked_in_blocks_as_their_text_says(spark):
    rng = random.Random(9)
    leaf = (None, None, None, None)
    inner = [("offer_to_band_ratio", math.inf, None, False), ("candidate_source", None, "it's", False), ("candidate_source", None, "agency", False)]
    inner += [("resume_years_experience", t, None, m) for t in (0.0, 2.5, 7.0) for m in (True, False)] + [("referral_flag", 0.5, None, False)]
    rows = []
    for t in range(30):
        if t % 7 == 0:
            rows.append((t, 0, *leaf, rng.gauss(0, 1)))
            continue
        rows += [(t, n, *rng.choice(inner), None) for n in (0, 1, 2, 5)]
        rows += [(t, n, *leaf, rng.gauss(0, 1)) for n in (3, 4, 6, 11, 12)]
    model = TrainedModel(OFFER_DECLINE, TREES, tuple(rows), -0.3)
    odd = [
        (ratio, years, source, flag)
        for ratio in (None, math.nan, 1.0, math.inf, -math.inf)
        for years in (None, math.nan, -0.0, 2.5, 2.6, 8.0)
        for source in (None, "it's", "agency", "new")
        for flag in (None, True, False)
    ]
    df = spark.createDataFrame(odd, "offer_to_band_ratio double, resume_years_experience double, candidate_source string, referral_flag boolean")
    df = df.withColumns({c: F.lit("x") for c in ("department", "seniority_level", "location")} | {"is_niche_location": F.lit(True)}).repartition(3)
    text = OFFER_DECLINE.inputs(df, F.struct(*df.columns).alias("_row")).select("_row.*", (1 / (1 + F.exp(-F.expr(model.margin_sql())))).alias("score"))
    key = lambda r: str(tuple(r))
    scored = model.score(df)
    assert sorted(map(key, scored.collect())) == sorted(map(key, text.collect()))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" not in plan and len(plan) < 10_000  # three hundred trees as text don't compile
    bare = TrainedModel(OFFER_DECLINE, TREES, (), 0.0), TrainedModel(OFFER_DECLINE, TREES, ((0, 0, *leaf, 0.0),), 0.0)
    assert all(r["score"] == 0.5 for m in bare for r in m.score(df).collect())


def test_a_level_reads_four_columns_in_a_plan_that_is_made_once(spark, monkeypatch):
    moved, margins = [], boosting._margins
    read, sums = [], boosting.blocks.sums

    def watched(*args):
        run = sums(*args)

        def checked(batches):
            for batch in batches:
                if batch.schema.names != ["held", "bins", "g", "h"]:
                    raise AssertionError(batch.schema.names)
                yield from run(iter([batch]))

        read.append(args)
        return checked

    monkeypatch.setattr(boosting, "_margins", lambda *args: moved.append(margins(*args)) or moved[-1])
    monkeypatch.setattr(boosting.blocks, "sums", watched)
    fit_trees(binned(frame_of(spark, planted_rows(200, 0.0)), FEATURES), FEATURES, 1, depth=1, min_rows=5)
    assert read and {f.sparkSession.conf.get("spark.sql.adaptive.enabled") for f in moved} == {"false"}
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_blocks_are_read_from_a_folder_whose_name_holds_a_space(spark, tmp_path, monkeypatch):
    from hirelens import session

    data = binned(frame_of(spark, planted_rows(200, 0.0)), FEATURES)
    plain = fit_trees(data, FEATURES, 1, depth=1, min_rows=5)
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "a b%20c"))
    assert fit_trees(data, FEATURES, 1, depth=1, min_rows=5) == plain
