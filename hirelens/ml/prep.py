"""Class weights, and what both classifiers need to know of the training rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .boosting import Feature
from .ranks import order_codes, summaries
from .spec import ModelSpec
from .vocabulary import levels

LINEAR = "logistic_regression"
TREES = "boosted_trees"
BINS = 255


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, rows, weight) with weight n / (2 n_c): each class weighs the same."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    return counts.select(label, "rows", (total / (F.col("rows") * 2)).alias("weight"))


def weight_column(label: str, counts: dict[float, int]) -> Column:
    """Balanced weight of a row, from the two class counts."""
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, rows in counts.items():
        weight = F.when(F.col(label) == value, total / (len(counts) * rows)).otherwise(weight)
    return weight


@dataclass(frozen=True)
class Prepared:
    """Exact medians, bin edges and levels of a training frame."""

    medians: dict[str, float | None]
    levels: dict[str, tuple[str, ...]]
    features: tuple[Feature, ...]


def prepare(train: DataFrame, spec: ModelSpec) -> Prepared:
    """Learn fills, bins and dictionaries once for both models; the numbers' codes are stored once."""
    middle, edges = summaries(order_codes(train, spec.numeric), spec.numeric, BINS)
    known = levels(train, spec.categorical)
    features = [Feature(c, edges=edges[c]) for c in spec.numeric]
    features += [Feature(c, levels=known[c]) for c in spec.categorical]
    features += [Feature(c, edges=(0.5,)) for c in spec.boolean]
    return Prepared(middle, known, tuple(features))
