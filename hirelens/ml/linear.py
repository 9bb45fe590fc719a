"""Balanced logistic regression whose result is a plain table of weights."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import number_text
from .spec import ModelSpec

ROWS_SCHEMA = "term string, level string, weight double, fill double"


@dataclass(frozen=True)
class Linear:
    """Rows (term, level, weight, fill): the intercept has no term, a number or flag no level.

    ``fill`` stands in for a missing number.
    """

    rows: tuple[tuple[str | None, str | None, float, float | None], ...]

    def margin_sql(self) -> str:
        parts = []
        levels: dict[str, list[tuple[str, float]]] = {}
        for term, level, weight, fill in self.rows:
            if term is None:
                parts.append(number_text(weight))
            elif level is not None:
                levels.setdefault(term, []).append((level, weight))
            else:
                parts.append(f"{number_text(weight)} * coalesce({term}, {number_text(fill or 0.0)})")
        for term, known in levels.items():
            whens = " ".join(f"WHEN '{v.replace(chr(39), chr(39) * 2)}' THEN {number_text(w)}" for v, w in known)
            parts.append(f"CASE {term} {whens} ELSE 0e0 END")
        return " + ".join(parts)


def fit_linear(
    data: DataFrame, spec: ModelSpec, medians: Mapping[str, float | None], levels: Mapping[str, Sequence[str]],
    rows: int, max_iter: int = 1000,
) -> Linear:
    """Standardised numbers, one column per level, an L2 penalty of unit inverse strength over ``rows`` unit-mean weights."""
    fills = {c: medians[c] if medians[c] is not None else 0.0 for c in spec.numeric}
    filled = {c: F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(fills[c])) for c in spec.numeric}
    moments = [m for c in spec.numeric for m in (F.avg(filled[c]).alias(f"{c}_mean"), F.stddev_pop(filled[c]).alias(f"{c}_sd"))]
    known = data.agg(*moments).first().asDict() if moments else {}
    scale = {c: (known[f"{c}_mean"], known[f"{c}_sd"] or 1.0) for c in spec.numeric}
    hot = [(c, v) for c in spec.categorical for v in levels[c]]
    columns = [((filled[c] - scale[c][0]) / scale[c][1]).alias(f"x{i}") for i, c in enumerate(spec.numeric)]
    columns += [F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)).alias(f"h{i}") for i, (c, v) in enumerate(hot)]
    inputs = [f"x{i}" for i in range(len(spec.numeric))] + [f"h{i}" for i in range(len(hot))] + list(spec.boolean)
    wide = data.select("label", "weight", *columns, *spec.boolean)
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(wide).select("label", "weight", "features")
    fitted = LogisticRegression(
        maxIter=max_iter, regParam=1.0 / rows, elasticNetParam=0.0, standardization=False, weightCol="weight"
    ).fit(vectors)
    weights = fitted.coefficients.toArray().tolist()
    intercept, table = float(fitted.intercept), []
    for c, w in zip(spec.numeric, weights):
        mean, sd = scale[c]
        intercept -= w * mean / sd
        table.append((c, None, w / sd, fills[c]))
    table += [(c, v, w, None) for (c, v), w in zip(hot, weights[len(spec.numeric) :])]
    table += [(c, None, w, 0.0) for c, w in zip(spec.boolean, weights[len(spec.numeric) + len(hot) :])]
    if not math.isfinite(intercept):
        raise ValueError("the linear fit did not converge")
    return Linear(((None, None, intercept, None), *table))
