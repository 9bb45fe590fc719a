"""A stratified hold-out split that needs no sort and no shuffle of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANGE = 1 << 31
_FINE = 1 << 15


def digest_number(*parts: Column) -> Column:
    """A number below 2**31 from the first digits of the MD5 of the parts, joined by colons; any engine finds the same."""
    digits = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % _RANGE


def hash_position(id_col: str, seed: int) -> Column:
    """A row's fixed pseudo-random position, from its id alone."""
    return digest_number(F.lit(seed), F.col(id_col))


def stratified_split(
    df: DataFrame, label: str, id_col: str, test: float = 0.25, seed: int = 42, position: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the same share of every label value in each.

    The cut per label is the exact position of the row at that share, so membership
    depends on the ids only: re-running, repartitioning or losing an executor changes nothing.
    ``position`` is that of the id where ``df`` already has it.
    """
    position = hash_position(id_col, seed) if position is None else position
    cuts = _exact_cuts(df.select(F.col(label).alias("label"), position.alias("position")), test)
    held_out = reduce(
        lambda chain, row: chain | (F.col(label).eqNullSafe(F.lit(row["label"])) & (position <= F.lit(row["cut"]))),
        cuts,
        F.lit(False),
    )
    return df.filter(~held_out), df.filter(held_out)


def _exact_cuts(rows: DataFrame, test: float) -> list:
    """(label, cut): the position of the row at rank ceil(test * rows) of each label.

    Rows are counted by the high bits of the position, then by its low bits where the rank
    falls, so a window sees at most 65,536 counts per label.
    """

    def at_rank(counts: DataFrame, value: str) -> DataFrame:
        running = Window.partitionBy("label").orderBy(value)
        reached = counts.withColumn("reached", F.sum("n").over(running))
        return reached.filter("reached >= wanted and reached - n < wanted")

    high = (F.col("position") / _FINE).cast("long")
    sizes = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) * F.lit(test)).alias("wanted"))
    coarse = rows.groupBy("label", high.alias("high")).agg(F.count(F.lit(1)).alias("n"))
    same = lambda a, b: a["label"].eqNullSafe(b["label"])
    coarse = coarse.join(sizes, same(coarse, sizes)).select(coarse["label"], "high", "n", "wanted")
    spot = at_rank(coarse, "high").select("label", "high", (F.col("wanted") - F.col("reached") + F.col("n")).alias("wanted"))
    fine = rows.withColumn("high", high)
    fine = fine.join(spot, same(fine, spot) & (fine["high"] == spot["high"])).select(fine["label"], "position", "wanted")
    counts = fine.groupBy("label", "position", "wanted").agg(F.count(F.lit(1)).alias("n"))
    return at_rank(counts, "position").select("label", F.col("position").alias("cut")).collect()
