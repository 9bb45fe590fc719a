"""Exact order statistics of several columns at once, by counting the digits of their codes.

A number becomes a 64-bit code that sorts as the number does. The rows are counted by the code's
first 16 bits; the counts tell in which bucket a rank falls, and only rows of such buckets are
counted by the next 16 bits, and so on. Counts combine on the map side, values never travel.
"""

from __future__ import annotations

import math
import struct
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

BITS, DIGITS = 16, 4
HELD = 1 << 18  # counts that a task keeps before it passes them on
_LOW = (1 << 63) - 1


def _codes(rows: pa.Array) -> pa.Array:
    """Longs that sort as the doubles in the fields of structs do, one array per struct; null for null and NaN."""
    fields = rows.flatten()
    flat, none = np.empty((len(rows), len(fields)), np.int64), np.empty((len(rows), len(fields)), bool)
    for i, values in enumerate(fields):
        number = values.fill_null(math.nan).to_numpy(zero_copy_only=False)
        bits = (number + 0.0).view(np.int64)  # minus zero becomes zero
        flat[:, i], none[:, i] = np.where(bits >= 0, bits, bits ^ _LOW), np.isnan(number)
    starts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(fields))
    return pa.ListArray.from_arrays(starts, pa.array(flat.reshape(-1), mask=none.reshape(-1)))


def _counted(shift: int, prefixes: Mapping[int, Sequence[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(col, prefix, digit, n) of the digits behind ``shift`` in codes that begin with one of a column's prefixes."""
    first = shift + BITS == 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {c: np.array(sorted(p), np.int64) for c, p in prefixes.items()}
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {c: [] for c in known}

        def merged(c: int) -> tuple[np.ndarray, np.ndarray]:
            cells, back = np.unique(np.concatenate([k for k, _ in held[c]]), return_inverse=True)
            return cells, np.bincount(back, np.concatenate([n for _, n in held[c]])).astype(np.int64)

        def passed(c: int) -> pa.RecordBatch:
            cells, n = merged(c)
            held[c] = []
            digits = (cells & ((1 << BITS) - 1)) - ((1 << (BITS - 1)) if first else 0)
            columns = [pa.array(np.full(len(cells), c, np.int32)), *map(pa.array, (known[c][cells >> BITS], digits, n))]
            return pa.RecordBatch.from_arrays(columns, names=["col", "prefix", "digit", "n"])

        for batch in batches:
            flat = batch.column("codes").flatten()
            if not batch.num_rows:
                continue
            width = len(flat) // batch.num_rows
            codes = flat.fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, width)
            there = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width)
            for c, starts in known.items():
                code = codes[there[:, c], c]
                digit = code >> shift
                if first:  # the sign's digit counts from the lowest
                    cell = digit + (1 << (BITS - 1))
                else:
                    prefix = digit >> BITS
                    place = np.minimum(np.searchsorted(starts, prefix), len(starts) - 1)
                    fits = starts[place] == prefix
                    cell = (place[fits] << BITS) | (digit[fits] & ((1 << BITS) - 1))
                if len(cell):
                    held[c].append(np.unique(cell, return_counts=True))
                if sum(len(k) for k, _ in held[c]) >= HELD:
                    held[c] = [merged(c)]
                    if len(held[c][0][0]) >= HELD // 2:
                        yield passed(c)
        for c in known:
            if held[c]:
                yield passed(c)

    return run


def value_of(code: int) -> float:
    bits = code if code >= 0 else code ^ _LOW
    return struct.unpack(">d", struct.pack(">q", bits))[0]


def order_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One stored row of ``codes`` per row, in the order of ``columns``."""
    if not columns:
        return cut_lineage(df.select(F.array().cast("array<long>").alias("codes")))
    numbers = F.struct(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    return cut_lineage(df.select(F.arrow_udf(_codes, "array<long>")(numbers).alias("codes")))


def known_counts(codes: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """How many rows have a number, by column."""
    row = codes.agg(*[F.count(F.get("codes", F.lit(i))).alias(f"n{i}") for i in range(len(columns))]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


def select_ranks(codes: DataFrame, ranks: Mapping[int, Sequence[int]]) -> dict[int, dict[int, float]]:
    """{column: {rank: value}} for ranks from 0 among the known values of ``codes``' columns.

    Four counting passes over the stored codes. The driver receives one row per column and rank
    from each; a window orders the 65,536 counts of one bucket.
    """
    spark = codes.sparkSession
    wanted = [(c, r, 0, r) for c, rs in ranks.items() for r in sorted(set(rs))]
    if not wanted:
        return {}
    for k in range(DIGITS):
        # at most one row per column and rank
        spots = spark.createDataFrame(wanted, "col int, rank long, prefix long, left long")
        prefixes: dict[int, set[int]] = {}
        for col, _, prefix, _ in wanted:
            prefixes.setdefault(col, set()).add(prefix)
        counted = codes.select("codes").mapInArrow(_counted(64 - BITS * (k + 1), prefixes), "col int, prefix long, digit long, n long")
        counts = counted.groupBy("col", "prefix", "digit").agg(F.sum("n").alias("n"))
        reached = F.sum("n").over(Window.partitionBy("col", "prefix").orderBy("digit"))
        found = (
            counts.withColumn("reached", reached)
            .join(F.broadcast(spots), ["col", "prefix"])
            .filter((F.col("reached") > F.col("left")) & (F.col("reached") - F.col("n") <= F.col("left")))
        )
        wanted = [
            (r["col"], r["rank"], r["digit"] if k == 0 else r["prefix"] << BITS | r["digit"], r["left"] - r["reached"] + r["n"])
            for r in found.collect()
        ]
    out: dict[int, dict[int, float]] = {}
    for col, rank, code, _ in wanted:
        out.setdefault(col, {})[rank] = value_of(code)
    return out


def _median_ranks(count: int) -> tuple[int, int]:
    return (count - 1) // 2, count // 2


def _edge_ranks(count: int, bins: int) -> list[int]:
    cuts = [math.ceil(count * k / bins) - 1 for k in range(1, bins)] if count >= bins else list(range(count))
    return [*cuts, count - 1]


def summaries(
    codes: DataFrame, columns: Sequence[str], bins: int = 0
) -> tuple[dict[str, float | None], dict[str, tuple[float, ...]]]:
    """Exact medians and bin edges of the columns behind ``order_codes``, from the same counting passes.

    A median is the mean of the two middle values for an even count, None for a column without
    values. Edges are at most ``bins`` - 1 order statistics that cut a column's values into parts
    of similar size; a value belongs to the part behind all edges below it. With few distinct
    values each but the largest is an edge.
    """
    counts = known_counts(codes, columns)
    ranks = {i: [*_median_ranks(counts[c])] for i, c in enumerate(columns) if counts[c]}
    if bins:
        for i in ranks:
            ranks[i] += _edge_ranks(counts[columns[i]], bins)
    found = select_ranks(codes, ranks)
    middle: dict[str, float | None] = dict.fromkeys(columns)
    edges: dict[str, tuple[float, ...]] = dict.fromkeys(columns, ())
    for i, values in found.items():
        count = counts[columns[i]]
        low, high = _median_ranks(count)
        middle[columns[i]] = (values[low] + values[high]) / 2
        if bins:
            cuts = {values[r] for r in _edge_ranks(count, bins)}
            edges[columns[i]] = tuple(sorted(v for v in cuts if v < values[count - 1]))
    return middle, edges


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of ``df``'s columns."""
    return summaries(order_codes(df, columns), columns)[0]
