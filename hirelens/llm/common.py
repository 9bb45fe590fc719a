"""Shared helpers: reading, Arrow slices, sorted groups, block pairs, fixed-size counts."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import cut_lineage as cut

SLICE_BYTES = 1 << 18
BATCH_BYTES = 1 << 22

__all__ = [
    "Texts",
    "block_pairs",
    "cut",
    "groups_of",
    "kept_in_process",
    "merged_counts",
    "read",
    "rows_of",
    "small_batches",
    "text_slices",
]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send tasks Arrow batches of about ``BATCH_BYTES``, however wide their rows are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Texts:
    """A slice of a batch's texts as one byte array; null texts are empty."""

    def __init__(self, array: pa.Array):
        array = array.cast(pa.large_string())
        self.nulls = array.is_null().to_numpy(zero_copy_only=False)
        if len(array) and self.nulls.any():
            array = array.fill_null("")
        self.array = array
        _, offsets, data = array.buffers()
        bounds = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.bounds = bounds - bounds[0]
        self.data = whole[bounds[0] : bounds[-1]]

    def __len__(self) -> int:
        return len(self.array)

    def strings(self) -> list[str]:
        return self.array.to_pylist()


def text_slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Pieces of the batches whose texts take about ``most`` bytes, at least one row each.

    A task thus holds working arrays for a few hundred kilobytes however large its batches are;
    a longer text is a piece of its own and is still taken whole.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        texts = Texts(column)
        ends, start = texts.bounds[1:], 0
        while start < len(texts):
            stop = int(np.searchsorted(ends, texts.bounds[start] + most, "right"))
            stop = max(stop, start + 1)
            part = batch.slice(start, stop - start)
            yield part, Texts(part.column(part.schema.get_field_index(text)))
            start = stop


def kept_in_process(key: object, make: Callable[[], object]) -> object:
    """``make()``, once per worker process and key: compiled models outlive a task where workers are reused."""
    box = sys.modules.setdefault("_hirelens_llm_kept", types.ModuleType("_hirelens_llm_kept"))
    if key not in box.__dict__:
        box.__dict__[key] = make()
    return box.__dict__[key]


def rows_of(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    arrays = [
        c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False)
        for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def groups_of(
    batches: Iterator[pa.RecordBatch], keys: int
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups and the groups' bounds, from batches sorted by the first ``keys`` columns."""
    held: list[pa.RecordBatch] = []

    def cuts(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        change[:1] = True
        for i in range(keys):
            values = table.column(i).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(change)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        starts = cuts(table)
        if len(starts) > 1:  # the last group may go on in the next batch
            yield table.slice(0, starts[-1]), starts
            held = table.slice(starts[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.append(cuts(table), table.num_rows)


def block_pairs(df: DataFrame, keys: list[str], by: str, block: int) -> DataFrame:
    """``df`` with (lo, hi, part): rows of a bucket, dealt to pairs of blocks of about ``block`` rows.

    A bucket of n rows has k = ceil(n / block) blocks; a row of block ``part`` is sent to the k
    pairs it belongs to. Two rows of a bucket meet in exactly one pair of blocks, unless both lie
    in the same block, where they meet in (part, part) alone, if pairs with lo < hi compare
    across blocks only. No task holds more than two blocks. Buckets of one row are dropped.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    k = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    each = df.join(sizes, keys).withColumn("_k", k)
    each = each.withColumn("part", F.pmod(F.xxhash64(F.lit(7), F.col(by)), F.col("_k")).cast("int"))
    each = each.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return each.withColumns(
        {"lo": F.least("part", "_other"), "hi": F.greatest("part", "_other")}
    ).drop("_n", "_k", "_other")


def merged_counts(
    df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]], width: int
) -> dict[int, np.ndarray]:
    """Sums of fixed-size count arrays over all rows: {row: int64 array of ``width``}.

    ``count`` yields (row, array) for a task. Arrays travel in chunks and are added in two
    levels, so no task adds more than a few hundred of them. The driver receives
    rows x width numbers, a size that does not depend on the data.
    """
    chunk = min(width, 1 << 14)
    schema = pa.schema([("row", pa.int32()), ("chunk", pa.int32()), ("salt", pa.int32()), ("counts", pa.binary())])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % 256
        for row, counts in count(batches):
            for at in range(0, width, chunk):
                part = counts[at : at + chunk].astype(np.int64)
                if part.any():
                    yield rows_of(schema, [row], [at // chunk], [salt], [part.tobytes()])

    def add(keep_salt: bool) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            total = np.zeros(chunk, np.int64)
            for value in table.column("counts"):
                part = np.frombuffer(value.as_buffer(), np.int64)
                total[: len(part)] += part
            first = table.slice(0, 1)
            salt = first.column("salt").to_pylist() if keep_salt else [0]
            return pa.table(
                [first.column("row"), first.column("chunk"), pa.array(salt, pa.int32()), pa.array([total.tobytes()], pa.binary())],
                schema=schema,
            )

        return run

    spark_schema = "row int, chunk int, salt int, counts binary"
    parts = df.mapInArrow(partial, spark_schema)
    merged = parts.groupBy("row", "chunk", "salt").applyInArrow(add(True), spark_schema)
    merged = merged.groupBy("row", "chunk").applyInArrow(add(False), spark_schema)
    out: dict[int, np.ndarray] = {}
    for r in merged.toLocalIterator():
        total = out.setdefault(r["row"], np.zeros(width, np.int64))
        part = np.frombuffer(bytes(r["counts"]), np.int64)[: max(0, width - r["chunk"] * chunk)]
        total[r["chunk"] * chunk : r["chunk"] * chunk + len(part)] += part
    return out


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of a value's text, modulo ``n``; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(n))
