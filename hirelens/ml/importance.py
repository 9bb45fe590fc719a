"""Permutation importance as one plan instead of a job per feature and repeat."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import dense_positions
from .areas import ROWS, areas
from .metrics import auc_from_counts, score_counts
from .spec import ModelSpec
from .split import digest_number

ROUNDS = 4
WALKS = 64
MOST_PARTS = 1024


def _mixed(value: Column, key: Column, low: int, high: int) -> Column:
    """A bijection on low x high numbers: halves of a mixed radix are added to by turns, each by a digest of the other."""
    a, b = value % low, F.floor(value / low)
    for turn in range(ROUNDS):
        if turn % 2 == 0:
            a = (a + digest_number(key, F.lit(turn), b)) % low
        else:
            b = (b + digest_number(key, F.lit(turn), a)) % high
    return b * low + a


def permuted(place: Column, key: Column, rows: int) -> Column:
    """Another place for each place below ``rows``, one to one, chosen by ``key``.

    The bijection above covers a few more numbers than ``rows``; what falls beyond is sent
    through it again until it lies below. Beyond are fewer numbers than the lower radix, the square
    root of ``rows``, so more than ``WALKS`` steps are as good as impossible; they raise.
    """
    low = max(1, math.isqrt(rows - 1) + 1) if rows > 1 else 1
    high = -(-rows // low)
    once = _mixed(place, key, low, high)
    again = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        once.cast("long"),
        lambda at, _: F.when(at < rows, at).otherwise(_mixed(at, key, low, high).cast("long")),
    )
    stuck = F.raise_error(F.lit("a permuted place was not found"))
    walked = F.when(again < rows, again).otherwise(stuck.cast("long"))
    return F.when(once < rows, once.cast("long")).otherwise(walked)


def shuffled_variants(df: DataFrame, spec: ModelSpec, rows: int, repeats: int, seed: int) -> DataFrame:
    """Every row once per (repeat, feature), that feature taken from another row.

    Rows have places by id. Per repeat a keyed bijection of the places names the row that a row
    lends its values to, which may be any row; so each column keeps exactly its values, nothing is
    sorted by chance, and the result follows from the ids, ``rows`` and the seed alone.
    """
    paired = _paired(df, spec, rows, repeats, seed).withColumn("feature", F.explode(F.array(*map(F.lit, spec.features))))
    swapped = [
        F.when(F.col("feature") == c, F.col(f"donor.{c}")).otherwise(F.col(c)).alias(c) for c in spec.features
    ]
    return paired.select("repeat", "feature", spec.id, "label", *swapped)


def _paired(df: DataFrame, spec: ModelSpec, rows: int, repeats: int, seed: int) -> DataFrame:
    """Every row once per repeat, with the features of the row that lends to it as ``donor``."""
    placed = dense_positions(df, [spec.id])
    key = F.concat_ws(":", F.lit(seed), F.col("repeat"))
    donors = (
        placed.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
        .withColumn("to", permuted(F.col("pos"), key, rows))
        .select("repeat", F.col("to").alias("pos"), F.struct(*spec.features).alias("donor"))
    )
    return placed.join(donors, "pos")


def permutation_importance(
    score: Callable[[DataFrame], DataFrame],
    test: DataFrame,
    spec: ModelSpec,
    rows: int,
    base_auc: float,
    repeats: int = 5,
    seed: int = 42,
    swapped: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(feature, mean, sd) of the AUC lost when a raw column is shuffled.

    ``score`` adds a ``score`` column to model inputs. ``swapped`` gives the log odds of all variants
    of a row at once, from its features and those lent to it, so rows needn't be repeated to be scored.
    """
    drop = F.lit(base_auc) - F.col("auc")
    if swapped:
        own = F.struct(*[F.col(c) for c in spec.features])
        chances = F.transform(swapped(own, F.col("donor")), lambda margin: 1 / (1 + F.exp(-margin)))
        each = _paired(test, spec, rows, repeats, seed).select("repeat", "label", chances.alias("scores"))
        feature = F.element_at(F.array(*map(F.lit, spec.features)), F.col("place") + 1).alias("feature")
        found = areas(each, _bounds(score, test, spec, rows)).select("repeat", feature, "auc")
    else:
        variants, by = score(shuffled_variants(test, spec, rows, repeats, seed)), ("repeat", "feature")
        found = auc_from_counts(score_counts(variants, "label", "score", by), by)
    return (
        found.groupBy("feature")
        .agg(F.avg(drop).alias("mean"), F.stddev_pop(drop).alias("sd"))
        .orderBy(F.desc("mean"), "feature")
    )


def _bounds(score: Callable[[DataFrame], DataFrame], test: DataFrame, spec: ModelSpec, rows: int) -> list[float]:
    """Scores between which about ``ROWS`` test rows stand, from one row in so many; they only deal the work."""
    parts = min(rows // ROWS, MOST_PARTS)
    if parts < 2:
        return []
    some = score(test.filter(F.pmod(F.xxhash64(spec.id), F.lit(parts)) == 0))
    found = some.agg(F.percentile_approx("score", [k / parts for k in range(1, parts)]).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))
