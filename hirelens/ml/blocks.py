"""Binned rows in blocks of bytes, and what a task does with one: walk trees, slopes, sums.

Functions here run in tasks over Arrow batches; Spark deals the blocks, keeps them and adds the sums.
Narrow features share a code (``layout``), so a row is a few codes: one sum per code holds the sums of
all its features. A block's columns are bytes of one numpy array each, one code after the other, its
withheld rows last.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Functions sent to executors travel by value, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 1 << 20
ROWS = 1 << 14  # of a block: larger ones are slower to move
SUMMED = 1 << 16  # rows that are summed at once
CODES = 1 << 11  # values of a code that several features share
BLOCKS = "n int, held int, y binary, w binary, bins binary"
STANDING = f"{BLOCKS}, margin binary, g binary, h binary"
SUMS = "cell long, g long, h long, n long"
LOSS = -1  # the cell of the withheld rows' loss

Batches = Iterator[pa.RecordBatch]
# feature by node (-1: a leaf), bits by node and bin (1: goes left), value by node
Tree = tuple[np.ndarray, np.ndarray, np.ndarray]
# (feature, step of its bins, number of its bins) of every feature in a code, by code
Layout = tuple[tuple[tuple[int, int, int], ...], ...]


def layout(bins: Sequence[int], most: int = CODES) -> Layout:
    """Features of so many bins dealt to codes of at most ``most`` values, or a code of its own for a wider one."""
    codes: list[list[tuple[int, int, int]]] = []
    for f in sorted(range(len(bins)), key=lambda f: -bins[f]):
        code = next((c for c in codes if _values(c) * bins[f] <= most), None)
        if code is None:
            codes.append(code := [])
        code.append((f, _values(code), bins[f]))
    return tuple(map(tuple, codes))


def _values(code: Sequence[tuple[int, int, int]]) -> int:
    """How many values a code has."""
    return code[-1][1] * code[-1][2] if code else 1


def _kind(coded: Layout) -> str:
    """The type that holds every code."""
    return "u2" if max(map(_values, coded)) <= 1 << 16 else "u4"


def _coded(bins: np.ndarray, coded: Layout) -> np.ndarray:
    """The codes of rows from their bins by feature."""
    return np.array([sum(bins[f].astype(np.int64) * step for f, step, _ in code) for code in coded]).astype(_kind(coded))


def binner(columns: Sequence[tuple[bool, Sequence]]) -> Callable[[pa.Array], pa.Array]:
    """The bins of rows as structs of raw columns; a column is (True, levels) or (False, edges)."""

    def bins(rows: pa.Array) -> pa.Array:
        placed = _placed(rows, columns, True)
        starts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(columns))
        return pa.ListArray.from_arrays(starts, pa.array(np.ascontiguousarray(placed.T, np.int32).reshape(-1)))

    return bins


def _placed(rows: pa.Array, columns: Sequence[tuple[bool, Sequence]], nan_missing: bool = False) -> np.ndarray:
    """The bins by column of rows as structs of raw columns; NaN is above all numbers, as in SQL, or missing."""
    bins = np.zeros((len(columns), len(rows)), "u2" if all(len(known) < 65_000 for _, known in columns) else "u4")
    for i, (values, (categorical, known)) in enumerate(zip(rows.flatten(), columns)):
        if categorical:
            if known:
                place = pc.index_in(values, pa.array(known, values.type), skip_nulls=True)
                bins[i] = place.fill_null(-1).to_numpy(zero_copy_only=False) + 1
        else:
            number = values.fill_null(0.0).to_numpy(zero_copy_only=False)
            missing = values.is_null().to_numpy(zero_copy_only=False)
            if nan_missing:
                missing = missing | np.isnan(number)
            bins[i] = np.where(missing, 0, np.searchsorted(np.array(known, np.float64), number) + 1)
    return bins


def pack(coded: Layout) -> Callable[[Batches], Batches]:
    """Blocks from rows (label, weight, withheld, bins)."""

    def run(batches: Batches) -> Batches:
        for y, w, held, bins, _ in _gathered(batches):
            order = np.argsort(held, kind="stable")
            arrays = *_weighed(y[order], w[order]), _coded(bins[:, order], coded)
            columns = [pa.array([n], pa.int32()) for n in (len(y), int(held.sum()))]
            columns += [pa.array([a.tobytes()], pa.binary()) for a in arrays]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "held", "y", "w", "bins"])

    return run


def _weighed(y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels and weights as stored: few weights once each, and their places above the label's bit."""
    known, place = np.unique(w, return_inverse=True)
    return (y + 2 * place.astype(np.uint8), known) if len(known) < min(len(w), 128) else (y, w)


def _labels(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels and weights by row."""
    y, w = _array(batch, i, "y", "u1"), _array(batch, i, "w", "f8")
    return (y, w) if len(y) == len(w) else (y & 1, w[y >> 1])


def _gathered(batches: Batches) -> Iterator[tuple[np.ndarray, ...]]:
    """(label, weight, withheld, bins, times) of about ``ROWS`` rows at a time."""
    waiting: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        label, weight, held = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "withheld"))
        bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).T
        times = batch.column("times").to_numpy(zero_copy_only=False) if "times" in batch.schema.names else np.ones(n)
        waiting.append(((label == 1.0).astype(np.uint8), weight.astype(np.float64), held.astype(np.uint8), bins.astype(np.int32), times))
        if sum(len(part[0]) for part in waiting) >= ROWS:
            yield tuple(np.concatenate(arrays, axis=-1) for arrays in zip(*waiting))
            waiting = []
    if waiting:
        yield tuple(np.concatenate(arrays, axis=-1) for arrays in zip(*waiting))


def _array(batch: pa.RecordBatch, i: int, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_buffer(), kind)


# ---- walking ---------------------------------------------------------------------

_HASHES = ((5, np.uint32, 0x077CB531, 27), (6, np.uint64, 0x03F79D71B4CB0A89, 58))


def masks(tree: Tree, depth: int, bins: Sequence[int]) -> dict[int, np.ndarray]:
    """By feature and bin a bit for each leaf that a row of that bin may still reach.

    A split that sends a row right rules out the leaves on its left; so a row ends in the lowest
    leaf that none of its bins rules out.
    """
    feature, bits, _ = tree
    kind = next(kind for most, kind, *_ in _HASHES if depth <= most)
    left, found = np.unpackbits(bits, axis=1), {}
    for node in np.flatnonzero(feature >= 0).tolist():
        level = (node + 1).bit_length() - 1
        span, f = (1 << depth) >> level, int(feature[node])
        dropped = ((1 << span // 2) - 1) << (node + 1 - (1 << level)) * span
        known = found.setdefault(f, np.full(bins[f], np.iinfo(kind).max, kind))
        known[left[node, : bins[f]] == 0] &= kind(np.iinfo(kind).max ^ dropped)
    return found


def ends(tree: Tree, depth: int) -> np.ndarray:
    """The node in which a row ends, by the hash of its lowest leaf's bit."""
    feature = tree[0]
    _, kind, magic, shift = next(h for h in _HASHES if depth <= h[0])
    width = 8 * np.dtype(kind).itemsize
    out = np.zeros(width, np.int64)
    for leaf in range(1 << depth):
        node = 0
        for level in range(depth):
            if feature[node] < 0:
                break
            node = 2 * node + 1 + (leaf >> (depth - level - 1) & 1)
        out[((magic << leaf) & ((1 << width) - 1)) >> shift] = node
    return out


def lowest(reach: np.ndarray) -> np.ndarray:
    """The hash of each row's lowest bit."""
    _, kind, magic, shift = next(h for h in _HASHES if reach.dtype == h[1])
    return ((reach & -reach) * kind(magic)) >> kind(shift)


def walker(tree: Tree, depth: int, coded: Layout) -> Callable[[np.ndarray], np.ndarray | int]:
    """What finds the node at which each row of codes ends; a node without rows below is one number."""
    feature, bits, _ = tree
    if not (feature >= 0).any():
        return lambda codes: 0
    if depth > _HASHES[-1][0]:
        return _stepper(tree, depth, coded)
    bins = {f: n for code in coded for f, _, n in code}
    reach = masks(tree, depth, bins)
    tables = []
    for i, code in enumerate(coded):
        used = [(f, step, n) for f, step, n in code if f in reach]
        if used:
            value = np.arange(_values(code))
            tables.append((i, np.bitwise_and.reduce([reach[f][value // step % n] for f, step, n in used])))
    node = ends(tree, depth)

    def walk(codes: np.ndarray) -> np.ndarray:
        left = None
        for i, table in tables:
            found = table.take(codes[i], mode="clip")  # all are in range; a check copies narrow indices
            left = found if left is None else np.bitwise_and(left, found, out=left)
        return node.take(lowest(left), mode="clip")

    return walk


def _stepper(tree: Tree, depth: int, coded: Layout) -> Callable[[np.ndarray], np.ndarray]:
    """The same for trees of more leaves than a number has bits, level by level."""
    feature, bits, _ = tree
    where = {f: (i, step, n) for i, code in enumerate(coded) for f, step, n in code}
    width, left = max(map(_values, coded)), np.unpackbits(bits, axis=1).astype(np.int64)
    following = np.repeat(np.arange(len(feature)), width).reshape(-1, width)
    code = np.zeros(len(feature), np.int64)
    for node in np.flatnonzero(feature >= 0).tolist():
        code[node], step, n = where[int(feature[node])]
        following[node] = 2 * node + 2 - left[node].take(np.arange(width) // step % n)
    steps = following.reshape(-1)

    def walk(codes: np.ndarray) -> np.ndarray:
        n = codes.shape[1]
        rows, flat, start = np.arange(n), codes.reshape(-1), code * n
        at = np.zeros(n, np.int64)
        for _ in range(depth):
            at = steps.take(at * width + flat.take(start.take(at) + rows))
        return at

    return walk


def scorer(base: float, trees: Sequence[Tree], depth: int, columns: Sequence[tuple[bool, Sequence]]) -> Callable[[pa.Array], pa.Array]:
    """The margins of rows as structs of raw columns; a column is (True, levels) or (False, edges)."""

    walks: list[tuple] = []  # made once in a task

    def margins(rows: pa.Array) -> pa.Array:
        if not walks:
            walks.extend((walker(t, depth, _apart(columns)), t[2]) for t in trees)
        placed, margin = _placed(rows, columns), np.full(len(rows), base)
        for walk, value in walks:
            margin += value[walk(placed)]
        return pa.array(margin)

    return margins


def _apart(columns: Sequence[tuple[bool, Sequence]]) -> Layout:
    """Every column's bins as a code of its own."""
    return tuple(((f, 1, len(known) + (1 if categorical else 2)),) for f, (categorical, known) in enumerate(columns))


def swapper(
    base: float, trees: Sequence[Tree], depth: int, columns: Sequence[tuple[bool, Sequence]], wanted: Sequence[int | None]
) -> Callable[[pa.Array, pa.Array], pa.Array]:
    """The margins of rows with one column's value taken from a donor, for each of the ``wanted`` columns.

    None stands for a column that no tree reads. A tree is walked again only where the column may
    change its leaf; values are added up in the order of trees, so margins are those of ``scorer``.
    """

    known: list[tuple] = []  # made once in a task

    def prepared() -> Iterator[tuple]:
        coded = _apart(columns)
        for tree in trees:
            used = sorted({int(f) for f in tree[0] if f >= 0})
            if used and depth <= _HASHES[-1][0]:
                yield used, masks(tree, depth, [code[0][2] for code in coded]), tree[2][ends(tree, depth)], None
            else:
                yield used, None, tree[2], walker(tree, depth, coded)

    def margins(rows: pa.Array, donors: pa.Array) -> pa.Array:
        if not known:
            known.extend(prepared())
        own, other, n = _placed(rows, columns), _placed(donors, columns), len(rows)
        plain = np.full(n, base)
        swapped = {f: np.full(n, base) for f in wanted if f is not None}
        for used, reach, values, walk in known:
            each = {}
            if walk:
                value = values[walk(own)]
                each = {f: values[walk(np.array([*own[:f], other[f], *own[f + 1 :]]))] for f in used if f in swapped}
            else:
                kept = [reach[f].take(own[f], mode="clip") for f in used]
                before, behind = [None], [None]  # what all columns before, and all behind, leave
                for a, b in zip(kept, reversed(kept)):
                    before.append(a if before[-1] is None else before[-1] & a)
                    behind.append(b if behind[-1] is None else behind[-1] & b)
                value = values.take(lowest(before[-1]), mode="clip")
                for k, f in enumerate(used):
                    if f in swapped:
                        left = reach[f].take(other[f], mode="clip")
                        for rest in (before[k], behind[len(used) - 1 - k]):
                            if rest is not None:
                                left &= rest
                        each[f] = values.take(lowest(left), mode="clip")
            plain += value
            for f, margin in swapped.items():
                margin += each.get(f, value)
        out = np.array([plain if f is None else swapped[f] for f in wanted]).T
        starts = pa.array(np.arange(n + 1, dtype=np.int32) * len(wanted))
        return pa.ListArray.from_arrays(starts, pa.array(np.ascontiguousarray(out).reshape(-1)))

    return margins


# ---- slopes and sums -------------------------------------------------------------


def _whole(values: np.ndarray) -> np.ndarray:
    """Units of 2**-20, rounded to a whole number of them."""
    return np.floor(values * UNIT + 0.5)


def slopes(y: np.ndarray, w: np.ndarray, held: int, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole gradient and curvature of each row; loss and 0 of the ``held`` last ones."""
    with np.errstate(over="ignore"):
        chance = 1 / (1 + np.exp(-margin))
    slope, bend = chance - y, chance * (1 - chance)
    if held:
        # log(1 + exp(-m)) for positives, log(1 + exp(m)) for the rest, without overflow
        signed = np.where(y[-held:] == 1, -margin[-held:], margin[-held:])
        slope[-held:], bend[-held:] = np.maximum(signed, 0.0) + np.log1p(np.exp(-np.abs(signed))), 0.0
    return _whole(w * slope), _whole(w * bend)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in four bytes each where they fit."""
    return values.astype("i4") if len(values) and np.abs(values).max() < 1 << 31 else values


def move(trees: Sequence[Tree], depth: int, coded: Layout, base: float | None = None) -> Callable[[Batches], Batches]:
    """Blocks with the margins after ``trees``, from those they have or else from ``base``, and whole slopes there.

    ``g`` and ``h`` are gradient and curvature, for withheld rows loss and 0.
    """

    def run(batches: Batches) -> Batches:
        walks = [(walker(t, depth, coded), t[2]) for t in trees]
        for batch in batches:
            for i in range(batch.num_rows):
                y, w = _labels(batch, i)
                codes = _array(batch, i, "bins", _kind(coded)).reshape(len(coded), -1)
                margin = np.full(len(y), base) if base is not None else _array(batch, i, "margin", "f8")
                for walk, value in walks:
                    margin = margin + value[walk(codes)]
                g, h = map(_narrow, slopes(y, w, batch.column("held")[i].as_py(), margin))
                kept = [batch.column(c).slice(i, 1) for c in ("n", "held", "y", "w", "bins")]
                fresh = [pa.array([a.tobytes()], pa.binary()) for a in (margin, g, h)]
                yield pa.RecordBatch.from_arrays([*kept, *fresh], names=["n", "held", "y", "w", "bins", "margin", "g", "h"])

    return run


class Sums:
    """Sums of gradient, curvature and rows by node, feature and bin, over blocks given one by one.

    Sums of whole numbers in doubles are exact below 2**53; weights have a mean of one, so that
    is 2**33 rows.
    """

    def __init__(self, tree: Tree, levels: int, nodes: Sequence[int], coded: Layout):
        # nodes at the last level are leaves of what has grown so far
        self.walk, self.coded, self.nodes = walker(tree, levels, coded) if levels else None, coded, len(nodes)
        self.place = np.full(len(tree[0]), -1)
        self.place[list(nodes)] = np.arange(len(nodes))
        self.totals = [np.zeros((3, len(nodes) * _values(code)), np.int64) for code in coded]

    def add(self, codes: np.ndarray, g: np.ndarray, h: np.ndarray, times: np.ndarray | None = None) -> None:
        """``codes`` and slopes of training rows, which stand for ``times`` rows each."""
        at = None
        if self.walk:
            place = self.place.take(self.walk(codes), mode="clip")
            found = np.flatnonzero(place >= 0)
            at, g, h, times = place[found], g[found], h[found], None if times is None else times[found]
        if not len(g):
            return
        # rows are counted above the curvatures where both fit
        bits = int(float(h.max()) * len(h)).bit_length()
        both = h + float(1 << bits) if times is None and (len(h) + 1) << bits < 1 << 53 else None
        for code, values, total in zip(self.coded, codes, self.totals):
            cell, size = (values, total.shape[1]) if at is None else (at * _values(code) + values[found], total.shape[1])
            total[0] += np.bincount(cell, g, size).astype(np.int64)
            if both is not None:
                packed = np.bincount(cell, both, size).astype(np.int64)
                total[2] += packed >> bits
                total[1] += packed & ((1 << bits) - 1)
            else:
                total[1] += np.bincount(cell, h, size).astype(np.int64)
                total[2] += np.bincount(cell, times, size).astype(np.int64)

    def spread(self, features: int, width: int) -> np.ndarray:
        """The sums as (node, feature, bin, 3)."""
        out = np.zeros((self.nodes, features, width, 3), np.int64)
        for code, total in zip(self.coded, self.totals):
            cube = total.reshape(3, self.nodes, *(n for _, _, n in reversed(code)))
            for k, (f, _, n) in enumerate(code):
                axis = cube.ndim - 1 - k
                others = tuple(a for a in range(2, cube.ndim) if a != axis)
                out[:, f, :n] = np.moveaxis(cube.sum(axis=others), 0, -1)
        return out


def sums(tree: Tree, levels: int, nodes: Sequence[int], coded: Layout, width: int, count_loss: bool) -> Callable[[Batches], Batches]:
    """One row per (node, feature, bin) that training rows of a task fall in, numbered in that order, and their sums."""

    def run(batches: Batches) -> Batches:
        total, loss, some, waiting = Sums(tree, levels, nodes, coded), None, False, []

        def summed() -> None:
            total.add(*(np.concatenate(arrays, axis=-1) for arrays in zip(*waiting)))
            waiting.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                codes = _array(batch, i, "bins", _kind(coded)).reshape(len(coded), -1)
                held, n = batch.column("held")[i].as_py(), codes.shape[1]
                g, h = (np.frombuffer(b, f"{'i' if len(b) == 4 * n else 'f'}{len(b) // n}") for b in (batch.column(c)[i].as_buffer() for c in ("g", "h")))
                if count_loss and held:
                    loss = (loss or 0) + int(g[n - held :].sum())
                waiting.append((codes[:, : n - held], g[: n - held], h[: n - held]))
                some = True
                if sum(a.shape[1] for a, *_ in waiting) >= SUMMED:
                    summed()
        if waiting:
            summed()
        if loss is not None:
            yield pa.RecordBatch.from_pydict({"cell": [LOSS], "g": [loss], "h": [0], "n": [0]})
        if some:
            flat = total.spread(sum(map(len, coded)), width).reshape(-1, 3)
            cells = np.flatnonzero(flat[:, 2])
            columns = [cells, *(flat[cells, k] for k in range(3))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cell", "g", "h", "n"])

    return run


class Kept:
    """All rows in one task's memory, with margins: what ``sums`` and ``move`` do over blocks elsewhere."""

    def __init__(self, batches: Batches, coded: Layout, depth: int, base: float):
        self.coded, self.depth, self.blocks = coded, depth, []
        for y, w, held, bins, times in _gathered(batches):
            order = np.argsort(held, kind="stable")
            block = {"y": y[order], "w": w[order], "held": int(held.sum()), "codes": _coded(bins[:, order], coded), "times": times[order].astype(np.float64)}
            self.blocks.append(block | {"margin": np.full(len(y), base)})
            self._slopes(self.blocks[-1])

    def _slopes(self, block: dict) -> None:
        g, h = slopes(block["y"], block["w"], block["held"], block["margin"])
        block["g"], block["h"] = g * block["times"], h * block["times"]

    def add(self, tree: Tree) -> None:
        walk = walker(tree, self.depth, self.coded)
        for block in self.blocks:
            block["margin"] = block["margin"] + tree[2][walk(block["codes"])]
            self._slopes(block)

    def sums(self, tree: Tree, levels: int, nodes: Sequence[int], width: int) -> tuple[np.ndarray, float | None]:
        total, loss = Sums(tree, levels, nodes, self.coded), None
        for block in self.blocks:
            n = len(block["y"]) - block["held"]
            total.add(block["codes"][:, :n], block["g"][:n], block["h"][:n], block["times"][:n])
            if block["held"]:
                loss = (loss or 0) + int(block["g"][n:].sum())
        return total.spread(sum(map(len, self.coded)), width), None if loss is None else loss / UNIT
