"""Exact ranking and threshold metrics as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import sum_before


def score_counts(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Positives and negatives at each distinct score (and group)."""
    positive = F.col(label).cast("double") == 1.0
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def auc_from_counts(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve per group; null where a class is missing.

    Equals the chance that a positive outscores a negative, ties counting half. The negatives
    below each score are a running sum over the distinct scores, which are counted once and
    stored by ranges; a task sorts one range, however many scores there are.
    """
    placed = sum_before(counts, "score", "neg", by, "below")
    wins = F.col("pos").cast("decimal(20,0)") * (F.col("below") * 2 + F.col("neg")).cast("decimal(18,0)")
    summed = placed.groupBy(*by).agg(
        F.sum(wins).alias("twice"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2
    auc = F.try_divide(F.col("twice").cast("double"), pairs).alias("auc")
    return summed.select(*by, auc, "positives", "negatives")


def roc_auc(df: DataFrame, label: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    return auc_from_counts(score_counts(df, label, score, by), by)


def _f1(hit: Column, predicted: Column, actual: Column) -> Column:
    return F.coalesce(F.try_divide(hit * 2.0, predicted + actual), F.lit(0.0))


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per group: true and false positives and negatives."""
    actual = F.col(label).cast("double") == 1.0
    called = F.col(score) >= threshold
    return df.groupBy(*by).agg(
        F.count_if(actual & called).alias("tp"),
        F.count_if(~actual & called).alias("fp"),
        F.count_if(actual & ~called).alias("fn"),
        F.count_if(~actual & ~called).alias("tn"),
    )


def classification_report(
    df: DataFrame,
    label: str,
    score: str,
    names: tuple[str, str] = ("0", "1"),
    threshold: float = 0.5,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """(row_name, precision, recall, f1, support) per class, accuracy, two averages."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    classes = {
        names[0]: (share(tn, tn + fn), share(tn, tn + fp), _f1(tn, tn + fn, tn + fp), tn + fp),
        names[1]: (share(tp, tp + fp), share(tp, tp + fn), _f1(tp, tp + fp, tp + fn), tp + fn),
    }
    (p0, r0, f0, s0), (p1, r1, f1, s1) = classes.values()

    def weighted(a: Column, b: Column) -> Column:
        return share(a * s0 + b * s1, total)

    accuracy = share(tp + tn, total)
    rows = {
        **classes,
        "accuracy": (accuracy, accuracy, accuracy, total),
        "macro avg": ((p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        "weighted avg": (weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    }
    structs = [
        F.struct(
            F.lit(name).alias("row_name"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            s.cast("long").alias("support"),
        )
        for name, (p, r, f, s) in rows.items()
    ]
    return confusion(df, label, score, threshold, by).select(*by, F.inline(F.array(*structs)))
