"""N-gram Jaccard join of whole documents: a grouped prefix join.

Two sets with a Jaccard similarity of at least t share one of their first
n - ceil(t n) + 1 elements in any common order. The order here puts shingles that are rare in
the corpus first. Documents with equal prefixes and sizes form a group; groups that share a
prefix shingle and have sizes within the bound are paired; pairs are then expanded to their
members' distinct sets, which are compared exactly.

Only components of links are asked for, so two groups need no comparison once they are known
to be connected. In a first wave each group is compared with two of the smallest groups at hand in
its buckets, a number of pairs linear in the groups; in a second wave, with all groups of
its buckets that are not yet in its component. No link between different components is lost
and a large group of near copies costs about two comparisons per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, block_pairs, cut, groups_of, merged_counts, rows_of, small_batches, text_slices
from .graph import components
from .words import SHINGLE, mixed, shingles, words

NUMERATOR, DENOMINATOR = 75, 100  # Jaccard of at least 75 / 100
COUNT_BITS = 20
MEMBER_BITS = 20
BLOCK = 2000
SMALL = 24  # buckets of up to so many rows are paired together,
SMALL_AT_ONCE = 500  # as many buckets at once
STRIP = 96  # rows of a larger bucket that are paired with all others at once
PICKS = 8
BRIEF_BYTES = 32  # of a bitmap that travels with a bucket's row
STEPS = 64  # in which a pair's distance is told apart


def shingle_sets(texts: Texts, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct ``n``-word shingles; see ``words.shingles``."""
    return shingles(*words(texts), n)


def prefix_length(size: int) -> int:
    return size - -(-NUMERATOR * size // DENOMINATOR) + 1


def _enough(rest: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether two sets of ``sizes`` elements together can be similar if they first meet where ``rest`` are left.

    Similar sets share 75 / 175 of their summed sizes, and from their first common element on
    they have at most the shorter rest in common. At other common elements this may fail.
    """
    return (NUMERATOR + DENOMINATOR) * rest >= NUMERATOR * sizes


def _ranks(s: np.ndarray, spread: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The common order of shingles, ``spread`` by ``mixed``: by how often their counter was hit, in powers of two, then by hash."""
    kind = classes[(s >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64)
    return (kind << np.uint64(58)) | (spread >> np.uint64(6))


def _count_classes(texts: DataFrame, n: int) -> np.ndarray:
    """For each of 2**COUNT_BITS counters, the bit length of the number of shingles of all documents in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for _, part in text_slices(batches):
            found = np.concatenate(shingle_sets(part, n)) >> np.uint64(64 - COUNT_BITS)
            np.add.at(total, found.astype(np.int64), 1)
        yield 0, total

    total = merged_counts(texts, count, 1 << COUNT_BITS).get(0, np.zeros(1 << COUNT_BITS, np.int64))
    return np.ceil(np.log2(total + 1)).astype(np.uint8)


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id) for every row.

    A document's set holds its distinct ``n``-word shingles (A-Z lower-cased, white-space words);
    with fewer words the whole sequence is one shingle; without words the set is empty and links
    with nothing. Documents link at a Jaccard similarity of at least 0.75; ``component_id`` is
    the smallest id that links reach, its own included.

    Rows with a null id take no part and get a null component. Rows that share an id are one
    node of the links. Shingles are known by 64-bit hashes. Ids are integers.
    """
    with small_batches(df.sparkSession):  # rows may hold whole sets of two documents
        return _components(df, id_col, text_col, n)


def _components(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """What ``jaccard_components`` returns; all its Arrow jobs have run by then."""
    id_kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    spark = df.sparkSession
    classes = spark.sparkContext.broadcast(_count_classes(rows.select("text"), n))  # 2**COUNT_BITS bytes
    schema = pa.schema([("id", pa.int64()), ("size", pa.int64()), ("whole", pa.int64()), ("lead", pa.int64()), ("prefix", pa.list_(pa.int64())), ("bits", pa.binary()), ("brief", pa.binary())])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            sizes, whole, lead, prefixes, bits, brief = [], [], [], [], [], []
            with np.errstate(over="ignore"):
                sets = shingle_sets(texts, n)
                joint = np.concatenate(sets)
                spread = mixed(joint)
                ranks = _ranks(joint, spread, classes.value)
                stop = 0
                for s in sets:
                    start, stop = stop, stop + len(s)
                    p = np.sort(ranks[start:stop])[: prefix_length(len(s))] if len(s) else s
                    sizes.append(len(s))
                    whole.append(spread[start:stop].sum(dtype=np.uint64).view(np.int64))
                    lead.append(mixed(p ^ np.uint64(len(s))).sum(dtype=np.uint64).view(np.int64))
                    prefixes.append(p.view(np.int64))
                    flips = parities(s)
                    bits.append(flips.tobytes())
                    while len(flips) > BRIEF_BYTES:
                        flips = flips[: len(flips) // 2] ^ flips[len(flips) // 2 :]
                    brief.append(flips.tobytes())
            offsets = np.cumsum([0, *map(len, prefixes)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(prefixes)))
            yield rows_of(schema, batch.column(0), sizes, np.array(whole, np.int64), np.array(lead, np.int64), lists, bits, brief)

    sets = cut(rows.mapInArrow(summarise, "id long, size long, whole long, lead long, prefix array<long>, bits binary, brief binary"))
    classes.destroy()
    taking_part = sets.filter("size > 0 and id is not null")
    # distinct sets, each known by its smallest id; groups of equal prefix and size likewise
    members = taking_part.groupBy("size", "lead", "whole").agg(F.min("id").alias("node"))
    groups = members.groupBy("size", "lead").agg(F.min("node").alias("grp"))
    entries = (
        taking_part.select("id", "size", "lead", "prefix")
        .join(groups, ["size", "lead"]).filter("id = grp")
        .select(F.posexplode("prefix").alias("pos", "token"), "size", "grp")
        .select("token", "size", "grp", (F.col("size") - F.col("pos")).alias("rest"))
    )
    first_schema = pa.schema([(c, pa.int64()) for c in ("token", "size", "grp", "rest", "leader")])

    def lead_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row of a bucket of several groups, with the smallest group that its size fits."""
        for table, bounds in groups_of(batches, 1):
            many = np.flatnonzero(np.diff(bounds) > 1)
            if not len(many):
                continue
            size, grp, rest = (table.column(c).to_numpy() for c in ("size", "grp", "rest"))
            leader = grp.copy()
            keep = np.zeros(len(size), bool)
            for k in many.tolist():
                a, b = bounds[k], bounds[k + 1]
                keep[a:b] = True
                while a < b:
                    stop = a + int(np.searchsorted(NUMERATOR * size[a:b], DENOMINATOR * size[a], "right"))
                    fits = _enough(np.minimum(rest[a], rest[a:stop]), size[a] + size[a:stop])
                    leader[a:stop][fits] = grp[a]
                    a = stop
            spots = pa.array(np.flatnonzero(keep))
            yield rows_of(first_schema, *(table.column(c).combine_chunks().take(spots) for c in ("token", "size", "grp", "rest")), leader[keep])

    index = entries.repartition("token").sortWithinPartitions("token", "size", "grp")
    index = cut(index.mapInArrow(lead_buckets, "token long, size long, grp long, rest long, leader long"))
    nodes = members.join(groups, ["size", "lead"]).select("grp", "node", "size")
    nodes = cut(nodes.join(index.select("grp").distinct(), "grp", "left_semi").unionByName(
        nodes.join(nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("grp"), "grp", "left_semi")
    ).distinct())
    marks = cut(sets.select("id", "size", "bits", "brief").join(nodes.select(F.col("node").alias("id")).distinct(), "id", "left_semi"))

    # first wave: leaders of buckets, and of groups, against the rest
    leaders = index.filter("leader <> grp").groupBy("grp").agg(F.min("leader").alias("first"), F.max("leader").alias("last"))
    leaders = leaders.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("a"), "grp")
    wave = leaders.join(nodes, "grp").select("a", F.col("node").alias("b"))
    wave = wave.unionByName(nodes.filter("node <> grp").select(F.col("grp").alias("a"), F.col("node").alias("b")))
    links = cut(_verified(wave.distinct(), marks, rows, n))
    reach = cut(components(links))

    # second wave: groups that share a bucket, but no component yet; once a few pairs for
    # each component, then all pairs of those that are still apart
    for few in (1, 0):
        more = cut(_verified(_apart(index, nodes, reach, marks, few), marks, rows, n))
        reach = cut(_joined(reach, more))

    named = sets.select("id", "size", "lead", "whole").join(members, ["size", "lead", "whole"], "left").join(reach, "node", "left")
    return named.select(
        F.col("id").cast(id_kind).alias(id_col),
        F.col("size").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"),
    )


def _apart(index: DataFrame, nodes: DataFrame, reach: DataFrame, marks: DataFrame, few: int) -> DataFrame:
    """Pairs (a, b) of sets that meet in a bucket or group and lie in different components.

    Groups with one set bring its bitmap, folded, so most pairs that it rules out are not made.
    With ``few`` at most ``PICKS`` pairs for each component, whatever their number, the closest by
    their bitmaps, other ones of equal distance for another value; with 0 all.
    """
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = nodes.join(reach.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = placed.groupBy("grp").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("k"))
    brief = marks.groupBy(F.col("id").alias("grp")).agg(F.min("brief").alias("bits"), F.max("brief").alias("same")).filter("bits = same")
    lone = spread.filter("k = 1").select("grp").join(brief.drop("same"), "grp")
    spread = spread.drop("k")
    bucket = index.select("token", "size", "grp", "rest").join(spread, "grp")
    several = bucket.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).filter("l <> h").select("token")
    pair_schema = pa.schema([(c, pa.int64()) for c in ("a", "b", "low", "high", "gap")])

    def pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in groups_of(batches, 3):
            lo, hi, part, size, grp, rest, low, high = (
                table.column(c).to_numpy() for c in ("lo", "hi", "part", "size", "grp", "rest", "low", "high")
            )
            token, bits = table.column("token").to_numpy(), table.column("bits").combine_chunks()
            out, held = [], 0
            small = np.diff(bounds) <= SMALL
            values = [x.astype(np.int64) for x in (lo, hi, part, size, grp, rest, low, high, token)]
            for first in range(0, len(small), SMALL_AT_ONCE):
                some = slice(first, first + SMALL_AT_ONCE)
                found = _small_pairs(bounds[first : first + SMALL_AT_ONCE + 1], small[some], few > 0, bits, *values)
                if found.shape[1]:
                    out.append(found)
                    held += found.shape[1]
            for a, b in zip(bounds[:-1][~small].tolist(), bounds[1:][~small].tolist()):
                for top in range(a, b - 1, STRIP):
                    i, j = slice(top, min(top + STRIP, b)), slice(top, b)
                    x, y = size[i][:, None], size[j][None, :]
                    fits = (NUMERATOR * y <= DENOMINATOR * x) & _enough(np.minimum(rest[i][:, None], rest[j][None, :]), x + y)
                    fits &= (low[i][:, None] != low[j][None, :]) | (high[i][:, None] != high[j][None, :]) | (low[i][:, None] != high[j][None, :])
                    if lo[a] != hi[a]:
                        fits &= part[i][:, None] != part[j][None, :]
                    u, v = np.nonzero(np.triu(fits, 1))
                    gap = _gaps(bits, size, u + top, v + top)
                    u, v, gap = u[gap >= 0], v[gap >= 0], gap[gap >= 0]
                    if not len(u):
                        continue
                    found = np.stack([grp[i][u], grp[j][v], np.minimum(low[i][u], low[j][v]), np.maximum(high[i][u], high[j][v]), gap])
                    if few:  # for each component met here the closest pair, and the closest with the one it meets most
                        chance = mixed((found[0] * 31 + found[1] * few + token[a : a + 1]).view(np.uint64))
                        _, which, times = np.unique(mixed(found[2].view(np.uint64)) + found[3].view(np.uint64), return_inverse=True, return_counts=True)
                        picked = []
                        for order in (np.lexsort((chance, gap)), np.lexsort((chance, gap, -times[which]))):
                            ends = np.unique(found[2:4, order].ravel(), return_index=True)[1] % found.shape[1]
                            picked.append(order[ends])
                        found = found[:, np.unique(np.concatenate(picked))]
                    out.append(found)
                    held += found.shape[1]
                if held > 100_000:
                    yield rows_of(pair_schema, *np.concatenate(out, axis=1))
                    out, held = [], 0
            if out:
                yield rows_of(pair_schema, *np.concatenate(out, axis=1))

    def met(rows: DataFrame, key: str, by: str) -> DataFrame:
        dealt = block_pairs(rows, [key], by, BLOCK).select(F.col(key).alias("token"), "lo", "hi", "part", "size", F.col(by).alias("grp"), "rest", "low", "high")
        dealt = dealt.join(lone, "grp", "left") if by == "grp" else dealt.withColumn("bits", F.lit(None).cast("binary"))
        dealt = dealt.select("token", "lo", "hi", "part", "size", "grp", "rest", "low", "high", "bits")
        dealt = dealt.repartition(tasks, "token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "size", "grp")
        found = dealt.mapInArrow(pair_up, "a long, b long, low long, high long, gap long")
        if not few:
            return found.select("a", "b").distinct()
        ends = found.withColumn("end", F.explode(F.array("low", "high")))
        lot = F.pmod(F.xxhash64(F.lit(few), "a", "b"), F.lit(PICKS))
        closest = F.struct("gap", F.xxhash64("a", "b").alias("chance"), "a", "b")
        chosen = ends.groupBy("end").agg(*[F.min(F.when(lot == k, closest)).alias(f"p{k}") for k in range(PICKS)])
        picks = chosen.select(F.explode(F.array(*[f"p{k}" for k in range(PICKS)])).alias("p")).filter("p is not null")
        return picks.select("p.a", "p.b").distinct()

    pairs = met(bucket.join(several, "token"), "token", "grp")
    sides = placed.select("grp", "node", "component")
    across = pairs.join(sides.toDF("a", "x", "cx"), "a").join(sides.toDF("b", "y", "cy"), "b").filter("cx <> cy")
    # members of one group that are not all in one component
    split = placed.join(spread.filter("low <> high").select("grp"), "grp", "left_semi")
    one = F.lit(1).cast("long")
    inside = met(split.select("grp", "node", one.alias("size"), one.alias("rest"), F.col("component").alias("low"), F.col("component").alias("high")), "grp", "node")
    return across.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(inside).distinct()


def _small_pairs(
    bounds: np.ndarray, small: np.ndarray, few: bool, bits: pa.Array, lo: np.ndarray, hi: np.ndarray, part: np.ndarray,
    size: np.ndarray, grp: np.ndarray, rest: np.ndarray, low: np.ndarray, high: np.ndarray, token: np.ndarray,
) -> np.ndarray:
    """(a, b, low, high, gap) of the pairs in all buckets of at most ``SMALL`` rows, made at once.

    With ``few`` only the closest pair of each component in each bucket.
    """
    sizes = np.diff(bounds)[small]
    stops = np.repeat(bounds[1:][small], sizes)
    rows = stops - 1 - (np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(len(stops)))
    later = stops - 1 - rows
    total = np.cumsum(later)
    u = np.repeat(rows, later)
    v = u + 1 + np.arange(len(u)) - np.repeat(total - later, later)
    stop = np.repeat(stops, later)
    fits = (NUMERATOR * size[v] <= DENOMINATOR * size[u]) & _enough(np.minimum(rest[u], rest[v]), size[u] + size[v])
    fits &= (low[u] != low[v]) | (high[u] != high[v]) | (low[u] != high[v])
    fits &= (lo[u] == hi[u]) | (part[u] != part[v])
    u, v, stop = u[fits], v[fits], stop[fits]
    gap = _gaps(bits, size, u, v)
    u, v, stop, gap = u[gap >= 0], v[gap >= 0], stop[gap >= 0], gap[gap >= 0]
    found = np.stack([grp[u], grp[v], np.minimum(low[u], low[v]), np.maximum(high[u], high[v]), gap])
    if not few or not len(u):
        return found
    chance = mixed((found[0] * 31 + found[1] + token[u]).view(np.uint64))
    bucket, component, pair = np.tile(stop, 2), found[2:4].ravel(), np.tile(np.arange(len(u)), 2)
    order = np.lexsort((np.tile(chance, 2), np.tile(gap, 2), component, bucket))
    first = np.ones(len(order), bool)
    first[1:] = (bucket[order][1:] != bucket[order][:-1]) | (component[order][1:] != component[order][:-1])
    return found[:, np.unique(pair[order][first])]


def _sets_of(rows: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, shingles) of the documents asked for, written once.

    A fixed-size map of the ids' hashes first drops most other texts where they are read; the
    join that follows is exact.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros(1 << MEMBER_BITS, np.int64)
        for batch in batches:
            total[mixed(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - MEMBER_BITS)] = 1
        yield 0, total

    marks = merged_counts(ids, mark, 1 << MEMBER_BITS).get(0, np.zeros(1 << MEMBER_BITS, np.int64)) > 0
    held = rows.sparkSession.sparkContext.broadcast(np.packbits(marks))  # 2**MEMBER_BITS bits

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = mixed(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - MEMBER_BITS)
            slot = slot.astype(np.int64)
            found = np.flatnonzero(held.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
            if len(found):
                yield batch.take(pa.array(found))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in shingle_sets(texts, n)], pa.binary())], names=["id", "shingles"]
            )

    few = rows.filter("id is not null").mapInArrow(likely, "id long, text string")
    exact = few.join(ids, "id", "left_semi").filter("text is not null")
    made = cut(exact.mapInArrow(build, "id long, shingles binary"))
    held.destroy()
    return made


def _joined(reach: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links, found among the components so far rather than all nodes."""
    ends = links
    for side in ("a", "b"):
        ends = ends.join(reach.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    ends = ends.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    grown = cut(components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))))
    renamed = grown.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = reach.join(renamed, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return old.unionByName(grown.join(reach, "node", "left_anti").select("node", "component"))


def parities(s: np.ndarray) -> np.ndarray:
    """A bitmap of at least two bits per element, a power of two, in which each element flips one bit.

    Two bitmaps differ in at most as many bits as the sets differ in elements, also after the
    longer one is folded onto the shorter, so a larger difference proves that sets are apart.
    """
    size = max(64, 1 << int(2 * max(1, len(s)) - 1).bit_length())
    slots = (s & np.uint64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=size).astype(np.uint8) & 1)


def may_link(x: np.ndarray, y: np.ndarray, size: int) -> bool:
    """False only if sets of ``size`` elements together differ in too many to be similar."""
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    apart = int(np.bitwise_count(x ^ y).sum())
    # shared = (size - apart) / 2 at most, union = size - shared
    return DENOMINATOR * (size - apart) >= NUMERATOR * (size + apart)


def _gaps(bits: pa.Array, size: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For pairs of rows the least distance that their bitmaps allow, in ``STEPS``; -1 unless they ``may_link``.

    Rows without a bitmap count as half as far apart as a link may be.
    """
    out = np.full(len(u), (DENOMINATOR - NUMERATOR) * STEPS // (2 * DENOMINATOR), np.int64)
    if not len(u):
        return out
    bounds = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1].astype(np.int64)
    data = np.frombuffer(bits.buffers()[2], np.uint8) if bits.buffers()[2] is not None else np.zeros(0, np.uint8)
    length = np.diff(bounds)
    shorter, longer = np.minimum(length[u], length[v]), np.maximum(length[u], length[v])
    for width in np.unique(shorter[(shorter > 0) & (longer <= 2 * shorter)]).tolist():
        own = np.flatnonzero((shorter == width) & (longer <= 2 * shorter))
        for part in np.array_split(own, -(-len(own) * width // (1 << 22))):
            x = np.zeros((len(part), width), np.uint8)
            for side in (u[part], v[part]):
                x ^= data[bounds[side][:, None] + np.arange(width)]
                twice = np.flatnonzero(length[side] == 2 * width)
                x[twice] ^= data[bounds[side[twice]][:, None] + np.arange(width, 2 * width)]
            apart = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
            both = size[u[part]] + size[v[part]]
            may = DENOMINATOR * (both - apart) >= NUMERATOR * (both + apart)
            out[part] = np.where(may, 2 * apart * STEPS // (both + apart), -1)
    return out


def _verified(pairs: DataFrame, marks: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity.

    Bitmaps, a thirtieth of the sets' size, first rule out pairs that cannot; the sets of
    the rest are made from their texts and intersected exactly.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            x, y = batch.column(4), batch.column(5)
            keep = [
                i for i, size in enumerate(sizes.tolist())
                if may_link(np.frombuffer(x[i].as_buffer(), np.uint8), np.frombuffer(y[i].as_buffer(), np.uint8), size)
            ]
            yield rows_of(schema, *(batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64)
                at = np.searchsorted(y, x).clip(max=len(y) - 1)
                shared = int((y[at] == x).sum())
                if DENOMINATOR * shared >= NUMERATOR * (len(x) + len(y) - shared):
                    keep.append(i)
            yield rows_of(schema, *(batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)))

    def sided(left: DataFrame, values: DataFrame) -> DataFrame:
        names = [c for c in values.columns if c != "id"]
        for side in ("a", "b"):
            left = left.join(values.toDF(side, *(f"{c}_{side}" for c in names)), side)
        return left.select("a", "b", *(f"{c}_{side}" for c in names for side in ("a", "b")))

    close = cut(sided(pairs, marks.select("id", "size", "bits")).mapInArrow(sift, "a long, b long").distinct())
    ids = close.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return sided(close, _sets_of(rows, ids, n)).mapInArrow(check, "a long, b long").distinct()
