"""Train, compare, explain, save and load one of the three models."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .boosting import ROWS_SCHEMA as NODES
from .boosting import binned, fit_trees, margin_column, margin_sql, swapped_margins
from .importance import permutation_importance
from .linear import ROWS_SCHEMA as WEIGHTS
from .linear import Linear, fit_linear
from .metrics import classification_report, roc_auc
from .prep import LINEAR, TREES, prepare, weight_column
from .spec import MODELS, PLAIN_LANGUAGE, ModelSpec
from .split import hash_position, stratified_split

SHORT_ROWS = 64  # trees of up to so many nodes in all are scored as compiled text, more in blocks of rows
METRICS_SCHEMA = "model string, section string, name string, metric string, value double"


@dataclass(frozen=True)
class TrainConfig:
    """How to train; the defaults hold at every size.

    ``validation`` is the share of the training rows withheld from the trees; boosting ends after
    ``patience`` rounds without a lower loss over them, and the best round's trees are kept. With
    None all ``rounds`` are boosted.
    """

    test: float = 0.25
    seed: int = 42
    max_iter: int = 1000
    rounds: int = 300
    repeats: int = 5
    validation: float | None = 0.1
    patience: int = 10
    depth: int = 5
    min_rows: int = 20


@dataclass(frozen=True)
class TrainedModel:
    """A model as plain rows: weights of a linear one, or the nodes of trees and their base margin."""

    spec: ModelSpec
    kind: str
    rows: tuple[tuple, ...]
    base: float = 0.0

    def margin_sql(self) -> str:
        """The log odds as SQL text over the feature columns, flags as 0 and 1; any engine can run it."""
        return Linear(self.rows).margin_sql() if self.kind == LINEAR else margin_sql(self.base, self.rows)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` plus the probability of the positive class.

        The model sees converted copies of the feature columns; the columns of
        ``df`` come back as they were.
        """
        original = F.struct(*df.columns).alias("_row")
        text = self.kind == LINEAR or len(self.rows) <= SHORT_ROWS
        margin = F.expr(self.margin_sql()) if text else margin_column(self.base, self.rows)
        return self.spec.inputs(df, original).select("_row.*", (1 / (1 + F.exp(-margin))).alias(out))

    def swapped(self, seen: Column, donor: Column) -> Column:
        """For each feature the log odds of inputs ``seen`` with that feature from ``donor``; trees only."""
        return swapped_margins(self.base, self.rows, self.spec.features, seen, donor)


@dataclass
class TrainResult:
    model: TrainedModel
    metrics: dict[str, dict[str, float]]
    rows: dict[str, int]
    base_rate: float
    report: list[tuple[str, str, str, str, float]] = field(default_factory=list)
    test: DataFrame | None = None

    def importance(self, config: TrainConfig | None = None) -> DataFrame:
        config = config or TrainConfig()
        return permutation_importance(
            self.model.score,
            self.test,
            self.model.spec,
            self.rows["test"],
            self.metrics[self.model.kind]["auc"],
            config.repeats,
            config.seed,
            self.model.swapped if self.model.kind == TREES and len(self.model.rows) > SHORT_ROWS else None,
        )

    def sample_predictions(self, n: int = 4) -> DataFrame:
        return sample_predictions(self.model, self.test, n)


def _fit(train: DataFrame, spec: ModelSpec, counts: dict[float, int], config: TrainConfig) -> dict[str, TrainedModel]:
    """Both models over rows with ``withheld``, from one pass for fills, bins and dictionaries."""
    known = prepare(train, spec)
    weighted = train.withColumn("weight", weight_column("label", counts))
    linear = fit_linear(weighted, spec, known.medians, known.levels, sum(counts.values()), config.max_iter)
    trees = fit_trees(
        binned(weighted, known.features), known.features, config.rounds,
        depth=config.depth, min_rows=config.min_rows, patience=config.patience, rows=sum(counts.values()),
    )
    return {
        LINEAR: TrainedModel(spec, LINEAR, linear.rows),
        TREES: TrainedModel(spec, TREES, tuple(trees.rows()), trees.base),
    }


def train(features: DataFrame, spec: ModelSpec, config: TrainConfig | None = None) -> TrainResult:
    """Fit the linear and the tree model, keep the one with the higher test AUC.

    The labelled inputs are stored once: both fits pass over them many
    times, and a lost executor must not recompute the feature mart. What is drawn by digests
    of the id is stored with them.
    """
    config = config or TrainConfig()
    withheld = F.lit(False)
    if config.validation is not None:
        withheld = hash_position(spec.id, config.seed + 1) < F.lit(int(config.validation * (1 << 31)))
    data = cut_lineage(spec.labelled(features).withColumns({"position": hash_position(spec.id, config.seed), "withheld": withheld}))
    fit_rows, test_rows = stratified_split(data, "label", spec.id, config.test, config.seed, F.col("position"))
    test_rows = test_rows.drop("position", "withheld")
    counts = {r["label"]: r["count"] for r in fit_rows.groupBy("label").count().collect()}
    test_counts = {r["label"]: r["count"] for r in test_rows.groupBy("label").count().collect()}
    if set(counts) != {0.0, 1.0} or set(test_counts) != {0.0, 1.0}:
        raise ValueError(f"{spec.name} needs both classes in train and test, got {counts} and {test_counts}")

    models = _fit(fit_rows, spec, counts, config)
    scored = cut_lineage(
        reduce(
            DataFrame.unionByName,
            [
                model.score(test_rows).select(F.lit(kind).alias("kind"), "label", "score")
                for kind, model in models.items()
            ],
        )
    )
    aucs = {r["kind"]: r["auc"] for r in roc_auc(scored, "label", "score", ("kind",)).collect()}
    reports = classification_report(scored, "label", "score", spec.classes, by=("kind",)).collect()
    f1 = {r["kind"]: r["f1"] for r in reports if r["row_name"] == spec.classes[1]}
    metrics = {kind: {"auc": aucs[kind], "f1": f1[kind]} for kind in models}
    best = TREES if aucs[TREES] >= aucs[LINEAR] else LINEAR

    sizes = {"train": sum(counts.values()), "test": sum(test_counts.values())}
    base_rate = (counts[1.0] + test_counts[1.0]) / sum(sizes.values())
    rows = [(spec.name, "split", name, "rows", float(n)) for name, n in sizes.items()]
    rows.append((spec.name, "split", "all", "base_rate", base_rate))
    rows += [(spec.name, "test", kind, m, v) for kind, ms in metrics.items() for m, v in ms.items()]
    rows += [
        (spec.name, f"report {r['kind']}", r["row_name"], m, float(r[m]))
        for r in reports
        for m in ("precision", "recall", "f1", "support")
    ]
    rows.append((spec.name, "selected", best, "auc", aucs[best]))
    return TrainResult(models[best], metrics, sizes, base_rate, rows, test_rows)


def sample_predictions(model: TrainedModel, test: DataFrame, n: int = 4) -> DataFrame:
    """The first ``n`` test rows by id: their features, score, and what was predicted and came true by name."""
    spec = model.spec
    # stored first: a projection over the limit would turn the top n into a sort of all rows
    first = model.score(cut_lineage(test.orderBy(spec.id).limit(n)))
    predicted, actual = (F.when(hit, spec.classes[1]).otherwise(spec.classes[0]) for hit in (F.col("score") >= 0.5, F.col("label") == 1.0))
    return first.select(spec.id, *spec.features, "label", "score", predicted.alias("predicted"), actual.alias("actual"))


def metrics_frame(spark: SparkSession, result: TrainResult) -> DataFrame:
    """The report as (model, section, name, metric, value) rows."""
    return spark.createDataFrame(result.report, METRICS_SCHEMA)


def importance_view(importance: DataFrame, top: int = 5) -> DataFrame:
    """The strongest features with a plain-language description."""
    described = F.create_map(*[F.lit(x) for pair in PLAIN_LANGUAGE.items() for x in pair])
    return (
        importance.orderBy(F.desc("mean"), "feature")
        .limit(top)
        .select("feature", F.coalesce(described[F.col("feature")], F.col("feature")).alias("description"), "mean", "sd")
    )


def save_report(spark: SparkSession, result: TrainResult, importance: DataFrame, root: str) -> None:
    """Metrics, described importances and sample predictions as tables next to the model."""
    path = f"{root.rstrip('/')}/{result.model.spec.name}"
    metrics_frame(spark, result).coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")
    features = len(result.model.spec.features)
    importance_view(importance, features).write.mode("overwrite").parquet(f"{path}/importance")
    result.sample_predictions().coalesce(1).write.mode("overwrite").parquet(f"{path}/samples")


def save(model: TrainedModel, root: str) -> None:
    """Write the model's rows as one table and a one-row description next to it."""
    path, spec, spark = f"{root.rstrip('/')}/{model.spec.name}", model.spec, SparkSession.active()
    schema = WEIGHTS if model.kind == LINEAR else NODES
    spark.createDataFrame(list(model.rows), schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/rows")
    about = {
        "name": spec.name,
        "kind": model.kind,
        "base": model.base,
        "label": spec.label,
        "numeric": list(spec.numeric),
        "categorical": list(spec.categorical),
        "boolean": list(spec.boolean),
    }
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/spec"
    )


def load(spark: SparkSession, root: str, name: str) -> TrainedModel:
    path = f"{root.rstrip('/')}/{name}"
    try:
        about = json.loads(spark.read.text(f"{path}/spec").first()["value"])
    except AnalysisException as error:
        raise FileNotFoundError(f"model not found: {path}; train it first") from error
    spec = MODELS[name]
    saved = (about["label"], tuple(about["numeric"]), tuple(about["categorical"]), tuple(about["boolean"]))
    if saved != (spec.label, spec.numeric, spec.categorical, spec.boolean):
        raise ValueError(f"{path} was trained on other features than {name} has now")
    rows = sorted((tuple(r) for r in spark.read.parquet(f"{path}/rows").collect()), key=_row_order)
    return TrainedModel(spec, about["kind"], tuple(rows), about["base"])


def _row_order(row: tuple) -> tuple:
    return tuple((v is not None, v if v is not None else 0) for v in row[:2])


def load_models(spark: SparkSession, root: str) -> dict[str, TrainedModel]:
    return {name: load(spark, root, name) for name in MODELS}
