"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosines.

A normalised vector falls, in each of several tables, into the bucket of its quantised
Gaussian projections, floor((a.v + b) / width) for each projection. Vectors that share a
bucket are compared exactly, in double precision, and a pair counts in the first table whose
bucket it shares, so links are counted without ever listing pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_pairs, cut, groups_of, rows_of
from .graph import components
from .words import mixed

THRESHOLD = 0.95


@dataclass(frozen=True)
class Tables:
    """``tables`` hash tables of ``projections`` projections each, quantised to ``width``.

    With the defaults a pair at cosine 0.95 shares a bucket with probability 0.99999, a closer
    one more surely; unrelated vectors share one table's bucket with probability 0.0007.
    """

    tables: int = 40
    projections: int = 10
    width: float = 2.0
    seed: int = 17

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        rng = np.random.default_rng(self.seed)
        n = self.tables * self.projections
        lines, shift = rng.standard_normal((unit.shape[1], n)), rng.uniform(0, self.width, n)
        cells = np.floor((unit @ lines + shift) / self.width).astype(np.int64).astype(np.uint64)
        cells = cells.reshape(len(unit), self.tables, self.projections)
        out = np.zeros((len(unit), self.tables), np.uint64)
        for p in range(self.projections):
            out = mixed(out ^ mixed(cells[:, :, p] + np.uint64(p + 1)))
        return out.view(np.int64)


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
    tables: Tables = Tables(), block: int = 1024,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    ``n_links`` is the number of other rows found with a cosine of at least ``threshold``,
    ``component_id`` the smallest id reachable by links, the row's own included, ``kept`` whether
    that is its own. Equal vectors are one class, compared once and counted by its rows. Null,
    zero and empty vectors, and those with a null or non-finite component, link with nothing;
    nor do vectors of different lengths link. Rows with a null id take no part: they come back
    with 0 links, a null component and not kept. Rows that share an id are one node of the links;
    each counts in ``n_links``. Ids are integers.

    A bucket is compared in blocks of about ``block`` vectors, each pair of blocks in a task
    of its own group; what leaves a pair of blocks is a link count and a spanning forest.
    """
    id_kind = df.schema[id_col].dataType.simpleString()
    kind = np.float32 if df.schema[vector_col].dataType.simpleString() == "array<float>" else np.float64  # in which vectors travel
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    keyed = cut(rows.select("id", F.when(sound, F.col("v")).alias("v")).withColumn("h", F.when(F.col("v").isNotNull(), F.xxhash64("v"))).withColumn("h2", F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(3), "v"))))
    classes = keyed.filter("v is not null").groupBy("h", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    heads = keyed.join(classes, ["h", "h2"]).filter("id = rep").dropDuplicates(["h", "h2"])
    node_schema = pa.schema([("bucket", pa.int64()), ("tab", pa.int32()), ("node", pa.int64()), ("rep", pa.int64()), ("copies", pa.int64()), ("vector", pa.binary()), ("codes", pa.binary())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, node, rep, copies = (batch.column(i) for i in range(4))
            lengths = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                ends = np.cumsum(lengths)[own]
                vector = values[(ends - length)[:, None] + np.arange(length)]
                for lo in range(0, len(own), 256):
                    part = own[lo : lo + 256]
                    n, t = len(part), tables.tables
                    codes = tables.codes(_units(vector[lo : lo + 256]))
                    raw, raw_codes = [x.tobytes() for x in vector[lo : lo + 256].astype(kind)], [x.tobytes() for x in codes]
                    again = np.repeat(np.arange(n), t)
                    yield rows_of(
                        node_schema,
                        codes.ravel(),
                        np.tile(np.arange(t, dtype=np.int32), n),
                        node.take(pa.array(part[again])),
                        rep.take(pa.array(part[again])).cast(pa.int64()),
                        copies.take(pa.array(part[again])),
                        [raw[i] for i in again],
                        [raw_codes[i] for i in again],
                    )

    tabled = heads.select("v", F.col("h").alias("node"), "rep", "copies").mapInArrow(
        hashed, "bucket long, tab int, node long, rep long, copies long, vector binary, codes binary"
    )
    dealt = block_pairs(tabled, ["tab", "bucket"], "node", block).select("tab", "bucket", "lo", "hi", "part", "node", "rep", "copies", "vector", "codes")
    dealt = dealt.repartition("tab", "bucket", "lo", "hi").sortWithinPartitions("tab", "bucket", "lo", "hi", "part")
    found_schema = pa.schema([("rep", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in groups_of(batches, 4):
            tab, lo, hi, part = (table.column(c).to_numpy() for c in ("tab", "lo", "hi", "part"))
            rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
            vectors, codes = table.column("vector").combine_chunks(), table.column("codes").combine_chunks()
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if b - a < 2:
                    continue
                split = a + int(np.searchsorted(part[a:b], hi[a])) if lo[a] != hi[a] else a
                if split == a != b and lo[a] != hi[a] or split == b:
                    continue
                yield from _links(vectors, kind, codes, rep, copies, int(tab[a]), a, split, b, threshold, found_schema)

    found = cut(dealt.mapInArrow(compare, "rep long, other long, n long"))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    reach = components(found.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    nodes = (
        classes.withColumn("rep", F.col("rep").cast("long"))
        .join(counts, "rep", "left").join(reach.withColumnRenamed("node", "rep"), "rep", "left")
        .select("h", "h2", "rep", "copies", "n", "component")
    )
    out = keyed.select("id", "h", "h2").join(nodes, ["h", "h2"], "left")
    out = out.select(
        "id",
        F.when(F.col("rep").isNull(), 0).otherwise(F.col("copies") - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("component", "rep", "id").cast("long").alias("component_id"),
    )
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return out.withColumn("kept", kept).withColumn("id", F.col("id").cast(id_kind)).withColumnRenamed("id", id_col)


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _links(vectors: pa.Array, kind: type, codes: pa.Array, rep: np.ndarray, copies: np.ndarray, tab: int, a: int, split: int, b: int, threshold: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Links of one pair of blocks: rows a..split against split..b, or all of a..b where split is a."""

    def matrix(array: pa.Array, lo: int, hi: int, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), kind) for x in array[lo:hi]]

    vectors = matrix(vectors, a, b, kind)
    code = np.stack(matrix(codes, a, b, np.int64))
    dims = np.array([len(v) for v in vectors])
    if (dims != dims[0]).any():  # a bucket of vectors of several lengths: compare like with like
        wide = np.zeros((len(vectors), dims.max()))
        for i, v in enumerate(vectors):
            wide[i, : len(v)] = v
        vectors = wide
    else:
        vectors = np.stack(vectors).astype(np.float64)
    vectors = _units(vectors)
    cosines = vectors[: split - a] @ vectors[split - a :].T if split > a else vectors @ vectors.T
    rows, cols = (slice(0, split - a), slice(split - a, b - a)) if split > a else (slice(0, b - a), slice(0, b - a))
    link = (cosines >= threshold) & (dims[rows][:, None] == dims[cols][None, :])
    if split == a:
        link &= np.tri(b - a, k=-1, dtype=bool)
    i, j = np.nonzero(link)
    if len(i) < 1 << 14:  # without pairs that an earlier table has counted
        again = (code[rows][i, :tab] == code[cols][j, :tab]).any(axis=1)
        link[i[again], j[again]] = False
    else:
        for t in range(tab):
            link &= code[rows, t][:, None] != code[cols, t][None, :]
    i, j = np.nonzero(link)
    if not len(i):
        return
    i, j = i + rows.start, j + cols.start
    weight, n = copies[a:b], np.zeros(b - a, np.int64)
    n[rows] += link @ weight[cols]
    n[cols] += link.T @ weight[rows]
    own = rep[a:b]
    some = np.flatnonzero(n)
    yield rows_of(schema, own[some], pa.nulls(len(some), pa.int64()), n[some])
    # a spanning forest: smallest labels spread until nothing changes
    label = own.copy()
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        if (before == label).all():
            break
    joined = np.flatnonzero(label != own)
    yield rows_of(schema, own[joined], label[joined], np.zeros(len(joined), np.int64))
