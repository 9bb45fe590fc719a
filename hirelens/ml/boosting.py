"""Gradient boosted trees for two classes, as aggregates over binned rows.

Numbers are cut into bins once, nulls have a bin of their own; rows are stored in blocks of bytes. A
tree grows level by level: tasks sum gradients and curvatures per (node, feature, bin) over their
blocks, one aggregate adds them up, and its result, whose size depends on nodes, features and bins
only, tells the driver every node's best split. A split says which side a missing value takes, so
absence is learned where it matters.

Rows of the same bins, label and weight move alike. Where few such rows are possible, each is kept once with
its number of times, and one task grows all trees.

Sums are of whole numbers (units of 2**-20), so a tree doesn't depend on how rows are dealt.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import SQL_SETTINGS, cut_lineage, read_back_by
from . import blocks
from .blocks import UNIT

# One task may grow all trees; what it runs travels by value, as that of blocks does.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_CURVATURE = 1e-3
# Blocks are large: buffers for many of them would be made larger again and again, and copied.
PLANNED_ONCE = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20),
    "spark.sql.inMemoryColumnarStorage.batchSize": "16",
}
FEW = 1 << 21  # different rows, some 60 bytes each, that one task keeps
PARTS = 8  # of one level's sums, whose number doesn't grow with the rows
CUT_EVERY = 16  # trees added to cached margins; then margins are made anew from the stored blocks


@dataclass(frozen=True)
class Feature:
    """A column in bins: 0 is missing; a number's bin is 1 + its edges below it, a level's 1 + its place."""

    name: str
    edges: tuple[float, ...] = ()
    levels: tuple[str, ...] | None = None

    @property
    def bins(self) -> int:
        return 2 + len(self.edges) if self.levels is None else 1 + len(self.levels)

    def bin(self) -> Column:
        value = F.col(self.name)
        if self.levels is not None:
            if not self.levels:
                return F.lit(0)
            place = F.array_position(F.array(*map(F.lit, self.levels)), value)
            return F.coalesce(place.cast("int"), F.lit(0))
        number = F.when(~F.isnan(value.cast("double")), value.cast("double"))
        if not self.edges:
            return F.when(number.isNotNull(), 1).otherwise(0)
        edges = F.array(*map(F.lit, self.edges))
        steps = [1 << k for k in reversed(range(len(self.edges).bit_length()))]

        def further(below: Column, step: Column) -> Column:
            fits = (below + step <= len(self.edges)) & (F.get(edges, below + step - 1) < number)
            return F.when(fits, below + step).otherwise(below)

        below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)
        return F.when(number.isNotNull(), below + 1).otherwise(0)


@dataclass(frozen=True)
class Node:
    """A split (feature and bin, and the missing side) or a leaf (value), numbered as in a heap."""

    tree: int
    node: int
    feature: int = -1
    bin: int = 0
    missing_left: bool = False
    value: float = 0.0


@dataclass(frozen=True)
class Trees:
    """A base margin, and trees as rows of nodes."""

    features: tuple[Feature, ...]
    base: float
    nodes: tuple[Node, ...]
    losses: tuple[float, ...] = field(default=(), compare=False)

    @property
    def rounds(self) -> int:
        return 1 + max((n.tree for n in self.nodes), default=-1)

    def rows(self) -> list[tuple]:
        """(tree, node, feature, threshold, level, missing_left, value): splits in the raw columns' terms."""
        out = []
        for n in self.nodes:
            if n.feature < 0:
                out.append((n.tree, n.node, None, None, None, None, n.value))
                continue
            f = self.features[n.feature]
            number = f.levels is None
            # behind the last edge stands every number that is not missing
            limit = (f.edges[n.bin - 1] if n.bin <= len(f.edges) else math.inf) if number else None
            out.append((n.tree, n.node, f.name, limit, None if number else f.levels[n.bin - 1], n.missing_left, None))
        return out


ROWS_SCHEMA = "tree int, node int, feature string, threshold double, level string, missing_left boolean, value double"


def number_text(value: float) -> str:
    """A double literal that both Spark and other engines read as one."""
    text = repr(float(value))
    return text if "e" in text else f"{text}e0"


def tree_sql(rows: Mapping[int, tuple], node: int = 0) -> str:
    """One tree as nested CASE, from its rows by node."""
    _, _, feature, threshold, level, missing_left, value = rows[node]
    if feature is None:
        return number_text(value)
    if level is not None:
        goes_left = f"{feature} = '{level.replace(chr(39), chr(39) * 2)}'"
    elif math.isinf(threshold):
        goes_left = f"{feature} IS NOT NULL"
    else:
        goes_left = f"{feature} <= {number_text(threshold)}" + (f" OR {feature} IS NULL" if missing_left else "")
    return f"CASE WHEN {goes_left} THEN {tree_sql(rows, 2 * node + 1)} ELSE {tree_sql(rows, 2 * node + 2)} END"


def margin_sql(base: float, rows: Sequence[tuple]) -> str:
    """The margin of a row as SQL text over its feature columns; numbers are doubles."""
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows:
        trees.setdefault(r[0], {})[r[1]] = r
    return " + ".join([number_text(base), *[f"({tree_sql(t)})" for _, t in sorted(trees.items())]])


def margin_column(base: float, rows: Sequence[tuple]) -> Column:
    """The same margin of the same columns, walked in blocks of rows: a text of many trees is too long to compile."""
    if not rows:
        return F.lit(base)
    features, grown, depth = _walked(rows)
    seen = F.struct(*[F.col(f.name) for f in features]) if features else F.struct(F.lit(0.0).alias("base"))
    return F.arrow_udf(blocks.scorer(base, grown, depth, _raw(features or [Feature("base")])), "double")(seen)


def swapped_margins(base: float, rows: Sequence[tuple], names: Sequence[str], seen: Column, donor: Column) -> Column:
    """For each name the margin of the struct ``seen`` with that column from ``donor``, as scoring such a row finds it."""
    features, grown, depth = _walked(rows)
    wanted = [next((i for i, f in enumerate(features) if f.name == name), None) for name in names]
    features = features or [Feature(names[0])]
    own, other = (F.struct(*[(side[f.name] if grown else F.lit(0.0)).alias(f.name) for f in features]) for side in (seen, donor))
    return F.arrow_udf(blocks.swapper(base, grown, depth, _raw(features), wanted), "array<double>")(own, other)


def _raw(features: Sequence[Feature]) -> list[tuple[bool, Sequence]]:
    """(True, levels) or (False, edges) of each feature."""
    return [(f.levels is not None, f.edges if f.levels is None else f.levels) for f in features]


def _walked(rows: Sequence[tuple]) -> tuple[list[Feature], list[blocks.Tree], int]:
    """The columns that a model's rows read, its trees over bins made of its own thresholds and levels, their depth."""
    inner = [r for r in rows if r[2] is not None]
    features = []
    for name in sorted({r[2] for r in inner}):
        known = {r[4] for r in inner if r[2] == name and r[4] is not None}
        edges = {r[3] for r in inner if r[2] == name and r[4] is None and not math.isinf(r[3])}
        features.append(Feature(name, levels=tuple(sorted(known))) if known else Feature(name, edges=tuple(sorted(edges))))
    at = {f.name: i for i, f in enumerate(features)}
    depth = max(((r[1] + 1).bit_length() - 1 for r in rows), default=0)
    splits: dict[int, dict[int, Split]] = {}
    values: dict[int, dict[int, float]] = {}
    for tree, node, name, threshold, level, missing_left, value in rows:
        if name is None:
            values.setdefault(tree, {})[node] = value
            continue
        f = features[at[name]]
        behind = level is None and math.isinf(threshold)
        place = len(f.edges) if behind else (f.edges if level is None else f.levels).index(threshold if level is None else level)
        splits.setdefault(tree, {})[node] = Split(0.0, at[name], place + 1, bool(missing_left) and not behind, (0, 0, 0), (0, 0, 0))
    grown = [_tree(depth, splits.get(t, {}), values.get(t, {}), features) for t in sorted({r[0] for r in rows})]
    return features, grown, depth


# ---- growing ---------------------------------------------------------------------


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    bin: int
    missing_left: bool
    left: tuple[int, int, int]
    right: tuple[int, int, int]


def best_split(hist: np.ndarray, features: Sequence[Feature], min_rows: int) -> Split | None:
    """The best split of one node from its sums (feature, bin, [gradient, curvature, rows]).

    Numbers split behind a bin, the missing on either side; levels split one from the rest. A
    split needs ``min_rows`` rows on both sides. Of equal gains the first found counts.
    """
    total = hist[0].sum(axis=0)
    best = None
    for f, feature in enumerate(features):
        bins = hist[f, : feature.bins]
        missing = bins[0]
        if feature.levels is not None:
            options = [(bins[1:], False)]
        else:
            below = np.cumsum(bins[1:], axis=0)
            if missing[2]:
                options = [(below, False), (below[:-1] + missing, True)]
            else:
                options = [(below[:-1], None)]
        for left, side in options:
            if not len(left):
                continue
            right = total - left
            g, h = left[:, 0] / UNIT, left[:, 1] / UNIT
            k, j = right[:, 0] / UNIT, right[:, 1] / UNIT
            fits = (left[:, 2] >= min_rows) & (right[:, 2] >= min_rows) & (h > MIN_CURVATURE) & (j > MIN_CURVATURE)
            if not fits.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = g * g / h + k * k / j - (total[0] / UNIT) ** 2 / (total[1] / UNIT)
            gains = np.where(fits, gains, -np.inf)
            at = int(np.argmax(gains))
            if gains[at] > 1e-9 and (best is None or gains[at] > best.gain):
                goes_left = bool(left[at, 2] >= right[at, 2]) if side is None else side
                best = Split(float(gains[at]), f, at + 1, goes_left, tuple(left[at].tolist()), tuple(right[at].tolist()))
    return best


def _left_bins(split: Split, features: Sequence[Feature]) -> list[bool]:
    """For each bin of a split's feature, whether it goes left."""
    feature = features[split.feature]
    if feature.levels is not None:
        return [b == split.bin for b in range(feature.bins)]
    return [split.missing_left] + [b <= split.bin for b in range(1, feature.bins)]


def _tree(depth: int, splits: Mapping[int, Split], values: Mapping[int, float], features: Sequence[Feature]) -> blocks.Tree:
    """A tree as arrays by node: feature, a bit per bin that says which one goes left, value."""
    size, width = (1 << (depth + 1)) - 1, max((f.bins for f in features), default=1)
    feature, left, value = np.full(size, -1, np.int16), np.zeros((size, width), np.uint8), np.zeros(size)
    for node, split in splits.items():
        feature[node] = split.feature
        sides = _left_bins(split, features)
        left[node, : len(sides)] = sides
    for node, leaf in values.items():
        value[node] = leaf
    return feature, np.packbits(left, axis=1), value


def _layout(features: Sequence[Feature]) -> blocks.Layout:
    return blocks.layout([f.bins for f in features])


def _sums(
    frame: DataFrame, tree: blocks.Tree, levels: int, nodes: Sequence[int], features: Sequence[Feature], count_loss: bool
) -> tuple[np.ndarray, float | None]:
    """Sums (node, feature, bin, 3) of the training rows in ``nodes``, and the loss over withheld rows."""
    width = max(f.bins for f in features)
    # only what a sum reads leaves the cache
    each = frame.select("held", "bins", "g", "h").mapInArrow(blocks.sums(tree, levels, nodes, _layout(features), width, count_loss), blocks.SUMS)
    # a task has a row per cell at most: nothing to combine before the exchange, and few parts hold all cells
    got = each.repartition(PARTS, "cell").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
    cell, *units = (got.column(c).to_numpy() for c in ("cell", "g", "h", "n"))
    keep = cell != blocks.LOSS
    total_loss = None if keep.all() else float(units[0][~keep].sum()) / UNIT
    out = np.zeros((len(nodes) * len(features) * width, 3), np.int64)
    for k, column in enumerate(units):
        out[cell[keep], k] = column[keep]
    return out.reshape(len(nodes), len(features), width, 3), total_loss


def binned(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """(label, weight, withheld, bins) of rows with those columns and the features."""
    raw = F.struct(*[F.col(f.name) if f.levels is not None else F.col(f.name).cast("double").alias(f.name) for f in features])
    return df.select("label", "weight", "withheld", F.arrow_udf(blocks.binner(_raw(features)), "array<int>")(raw).alias("bins"))


def fit_trees(
    data: DataFrame, features: Sequence[Feature], rounds: int = 300, rate: float = 0.08, depth: int = 5,
    min_rows: int = 20, patience: int = 10, rows: int | None = None,
) -> Trees:
    """Boost over ``data`` (label, weight, withheld, bins), which is stored once in blocks.

    Rows marked ``withheld`` train nothing; the loss over them ends boosting after ``patience``
    rounds without a new best, and the trees up to the best round are kept. Without such rows all
    ``rounds`` are boosted. One job per level; the driver sees one level's sums at a time. Only the
    smaller child of a split is summed, the other is what its parent has besides.

    Given the number of ``rows``, weights are taken to follow from labels; if no more than ``FEW`` can
    differ, all trees are grown in one job.
    """
    sides = data.filter("not withheld").groupBy("label").agg(F.sum(F.floor(F.col("weight") * UNIT + 0.5)).alias("w")).collect()
    weights = {r["label"]: r["w"] for r in sides}
    base = math.log(weights[1.0] / weights[0.0]) if len(weights) == 2 else 0.0
    how = Growing(tuple(features), rounds, rate, depth, min_rows, patience)
    if rows is not None and min(rows, 4 * math.prod(f.bins for f in features)) <= FEW:
        return _grown_in_one_task(data, base, how)
    with read_back_by(_planned_once(data.sparkSession)):
        stored = cut_lineage(data.mapInArrow(blocks.pack(_layout(features)), blocks.BLOCKS))
    standing = _Standing(stored, features, depth, base)
    try:
        nodes, losses = how.grow(standing.sums, standing.add)
    finally:
        standing.close()
    return Trees(tuple(features), base, nodes, losses)


class _Standing:
    """Blocks with margins as a cached frame; sums and new margins are jobs over it."""

    def __init__(self, stored: DataFrame, features: Sequence[Feature], depth: int, base: float):
        self.stored, self.features, self.depth, self.base = stored, features, depth, base
        self.trees: list[blocks.Tree] = []
        self.frame = _margins(stored, [], depth, features, base)
        self.stale: DataFrame | None = None  # the margins before the last tree, until the new ones are cached

    def sums(self, grown: blocks.Tree, level: int, nodes: Sequence[int]) -> tuple[np.ndarray, float | None]:
        found = _sums(self.frame, grown, level, nodes, self.features, level == 0)
        if level == 0 and self.stale is not None:
            self.stale.unpersist()
            self.stale = None
        return found

    def add(self, tree: blocks.Tree) -> None:
        self.trees.append(tree)
        if len(self.trees) % CUT_EVERY:
            self.stale, self.frame = self.frame, _margins(self.frame, [tree], self.depth, self.features)
        else:  # from the stored blocks again, so that lineage stays short and no margins are written
            self.stale, self.frame = self.frame, _margins(self.stored, self.trees, self.depth, self.features, self.base)

    def close(self) -> None:
        for cached in (self.frame, self.stale):
            if cached is not None:
                cached.unpersist()


@dataclass(frozen=True)
class Growing:
    """How trees grow from sums, wherever those are made."""

    features: tuple[Feature, ...]
    rounds: int
    rate: float
    depth: int
    min_rows: int
    patience: int

    def grow(
        self, sums: Callable[[blocks.Tree, int, Sequence[int]], tuple[np.ndarray, float | None]], add: Callable[[blocks.Tree], None]
    ) -> tuple[tuple[Node, ...], tuple[float, ...]]:
        """Nodes and losses. ``sums`` of the rows in nodes of a tree grown so far, and the loss; ``add`` a tree to the margins."""
        nodes: list[Node] = []
        losses: list[float] = []
        for tree in range(self.rounds + 1):
            splits: dict[int, Split] = {}
            values: dict[int, float] = {}
            above: dict[int, np.ndarray] = {}  # sums of the level above, by node
            active = [0]
            for level in range(self.depth):
                smaller = {n: _smaller(n, splits[n]) for n in above if n in splits}
                grown = _tree(self.depth, splits, {}, self.features)
                found, loss = sums(grown, level, list(smaller.values()) or active)
                if level == 0 and loss is not None:
                    losses.append(loss)
                    best = int(np.argmin(losses))
                    if len(losses) - 1 - best >= self.patience or tree == self.rounds:
                        return _kept(nodes, best), tuple(losses)
                if level == 0 and tree == self.rounds:
                    return _kept(nodes, self.rounds), tuple(losses)
                hists = dict(zip(smaller.values() or active, found))
                for parent, child in smaller.items():
                    hists[4 * parent + 3 - child] = above[parent] - hists[child]
                below = []
                for node in active:
                    if level == 0:
                        values[0] = _leaf(hists[0][0].sum(axis=0), self.rate)
                    split = best_split(hists[node], self.features, self.min_rows)
                    if split:
                        splits[node] = split
                        for child, part in ((2 * node + 1, split.left), (2 * node + 2, split.right)):
                            values[child] = _leaf(part, self.rate)
                            below.append(child)
                above, active = hists, below
                if not active:
                    break
            for node in sorted(values):
                if node in splits:
                    s = splits[node]
                    nodes.append(Node(tree, node, s.feature, s.bin, s.missing_left))
                else:
                    nodes.append(Node(tree, node, value=values[node]))
            add(_tree(self.depth, splits, values, self.features))
        raise AssertionError


GROWN = "tree int, node int, feature int, bin int, missing_left boolean, value double"


def _grown_in_one_task(data: DataFrame, base: float, how: Growing) -> Trees:
    """The same trees, grown over the different rows with their numbers by one task."""
    coded, width = _layout(how.features), max(f.bins for f in how.features)

    def run(batches: blocks.Batches) -> blocks.Batches:
        kept = blocks.Kept(batches, coded, how.depth, base)
        if not kept.blocks:
            return
        nodes, losses = how.grow(lambda grown, level, wanted: kept.sums(grown, level, wanted, width), kept.add)
        rows = [(n.tree, n.node, n.feature, n.bin, n.missing_left, n.value) for n in nodes]
        rows += [(-1, i, -1, 0, False, loss) for i, loss in enumerate(losses)]
        kinds = (pa.int32(),) * 4 + (pa.bool_(), pa.float64())
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "feature", "bin", "missing_left", "value"])

    different = data.groupBy("label", "weight", "withheld", "bins").agg(F.count(F.lit(1)).alias("times"))
    found = [tuple(r) for r in different.coalesce(1).mapInArrow(run, GROWN).collect()]
    nodes = tuple(Node(*r) for r in sorted(r for r in found if r[0] >= 0))
    return Trees(how.features, base, nodes, tuple(r[5] for r in sorted(r for r in found if r[0] < 0)))


def _planned_once(spark: SparkSession) -> SparkSession:
    """A session without adaptive plans, as a level's sums have a known, small size, and with few blocks to a batch."""
    plain = spark.newSession()
    for key, value in (*SQL_SETTINGS.items(), *PLANNED_ONCE.items()):
        plain.conf.set(key, value)
    return plain


def _smaller(node: int, split: Split) -> int:
    """The child of a split that has fewer rows."""
    return 2 * node + (1 if split.left[2] <= split.right[2] else 2)


def _margins(
    frame: DataFrame, trees: Sequence[blocks.Tree], depth: int, features: Sequence[Feature], base: float | None = None
) -> DataFrame:
    """The margins with ``trees`` added, cached."""
    moved = frame.mapInArrow(blocks.move(list(trees), depth, _layout(features), base), blocks.STANDING)
    return moved.persist(StorageLevel.MEMORY_AND_DISK)


def _leaf(part: Sequence[int], rate: float) -> float:
    return -rate * part[0] / part[1] if part[1] > 0 else 0.0


def _kept(nodes: Sequence[Node], best: int) -> tuple[Node, ...]:
    return tuple(n for n in nodes if n.tree < best)
