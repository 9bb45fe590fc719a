"""Exact areas under many ROC curves from arrays of scores, sorted in blocks and merged by ranges of the score.

A task sorts its rows' scores and sends them cut at common bounds, equal ones counted; whoever gets a
range adds up the wins inside it. Bounds only deal the work: any give the same areas.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

ROWS = 1 << 16  # rows that a task sorts at once, and scores of a range
CUT = "repeat int, place int, part int, score binary, pos binary, neg binary"
WON = "repeat int, place int, part int, twice long, pos long, neg long"


def _counted(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct scores in order, and the positives and negatives that have them."""
    order = np.argsort(score)
    score = score[order]
    first = np.flatnonzero(np.concatenate(([True], score[1:] != score[:-1])))
    return score[first], np.add.reduceat(pos[order], first), np.add.reduceat(neg[order], first)


def _cut(bounds: Sequence[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ranges between ``bounds`` of each place of ``scores``, by repeat, from rows (repeat, label, scores)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []

        def passed() -> pa.RecordBatch:
            repeat, label, scores = (np.concatenate(arrays) for arrays in zip(*waiting))
            waiting.clear()
            out: list[tuple] = []
            for r in np.unique(repeat).tolist():
                mine = np.flatnonzero(repeat == r)
                positive = (label[mine] == 1.0).astype(np.int64)
                for place in range(scores.shape[1]):
                    arrays = _counted(scores[mine, place], positive, 1 - positive)
                    ends = [0, *np.searchsorted(arrays[0], bounds).tolist(), len(arrays[0])]
                    for part, (a, b) in enumerate(zip(ends, ends[1:])):
                        if a < b:
                            out.append((r, place, part, *(x[a:b].tobytes() for x in arrays)))
            kinds = (*(pa.int32(),) * 3, *(pa.binary(),) * 3)
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["repeat", "place", "part", "score", "pos", "neg"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            repeat, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("repeat", "label"))
            scores = batch.column("scores").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            waiting.append((repeat, label, scores))
            if sum(len(w[0]) for w in waiting) >= ROWS:
                yield passed()
        if waiting:
            yield passed()

    return run


def _won(table: pa.Table) -> pa.Table:
    """Twice the pairs in one range that its positives win, ties counting half, and its rows of each class."""
    score, pos, neg = (
        np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in table.column(c)]) for c, kind in (("score", "f8"), ("pos", "i8"), ("neg", "i8"))
    )
    _, pos, neg = _counted(score, pos, neg)
    twice = int((pos * (2 * (np.cumsum(neg) - neg) + neg)).sum())
    key = [table.column(c)[0].as_py() for c in ("repeat", "place", "part")]
    kinds = (*(pa.int32(),) * 3, *(pa.int64(),) * 3)
    columns = [pa.array([v], kind) for v, kind in zip((*key, twice, int(pos.sum()), int(neg.sum())), kinds)]
    return pa.table(columns, names=["repeat", "place", "part", "twice", "pos", "neg"])


def areas(df: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """(repeat, place, auc) for every place in arrays ``scores`` of rows (repeat, label, scores); null where a class is missing.

    A range has to fit in memory: its distinct scores, once per ``ROWS`` rows at most.
    """
    cut = df.select("repeat", "label", "scores").mapInArrow(_cut(sorted(set(bounds))), CUT)
    won = cut.groupBy("repeat", "place", "part").applyInArrow(_won, WON)
    earlier = Window.partitionBy("repeat", "place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    wins = F.col("twice").cast("decimal(38,0)") + F.col("pos").cast("decimal(19,0)") * (below * 2).cast("decimal(18,0)")
    summed = won.select("repeat", "place", "pos", "neg", wins.alias("wins")).groupBy("repeat", "place").agg(
        F.sum("wins").alias("twice"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2
    return summed.select("repeat", "place", F.try_divide(F.col("twice").cast("double"), pairs).alias("auc"))
