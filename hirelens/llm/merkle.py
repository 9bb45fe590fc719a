"""Merkle manifest of a table: a persistent ternary hash tree per group, and one over the groups.

Leaves are numbered inside their group by a range partitioning and offsets per partition, and
dealt to aligned blocks of ``BLOCK`` consecutive ones. A block hashes its own levels; its last
digest is a node of the next round, whose blocks hash the levels above, until one node is left.
No task ever holds more than one block's digests, however many leaves a group has.

A tampered leaf makes a version of the tree that shares every untouched node with the original
and holds copies of the leaf's ancestors alone: first those inside its block, then those of the
blocks above. What a copy needs beside itself are the siblings of each ancestor, its path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

FANOUT = 3
LEVELS = 6  # hashed inside one block
BLOCK = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left: string, right: string>>"


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest_of(*map(field, values))


def _key(group: Column) -> Column:
    """A group's value as text that is never null and sorts as the value does, null first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, from 0 inside each ``grp`` by ``order``, and ``n``, the group's size.

    Rows are spread by ranges of (group, order), so a group may fill any number of partitions;
    a row's place is its place in its partition plus what earlier partitions hold of its group.
    Rows that agree in everything may stand in any order.
    """
    spread = nodes.withColumn("tie", F.monotonically_increasing_id())
    spread = spread.repartitionByRange("grp", *order, "tie").sortWithinPartitions("grp", *order, "tie").drop("tie")
    placed = cut(spread.withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftright("row", 33).alias("part")
    runs = placed.groupBy("grp", part).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "grp",
        "part",
        (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(Window.partitionBy("grp")).alias("n"),
    )
    return (
        placed.withColumn("part", part)
        .join(runs, ["grp", "part"])
        .withColumn("pos", F.col("row") + F.col("shift"))
        .drop("row", "part", "shift")
    )


def _level_above(nodes: Column) -> Column:
    """The hash of each run of ``FANOUT`` digests, of the last run with fewer too."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / FANOUT).cast("int") - 1)
    return F.transform(runs, lambda i: digest_of(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), "")))


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per aligned block of nodes (grp, pos, n, digest, payload).

    ``tree`` holds the digests of each level from the nodes up to ``top``; a group that fits one
    block stops where one digest is left, others are hashed through all ``LEVELS``.
    """
    member = F.struct((F.col("pos") % BLOCK).cast("int").alias("at"), "digest", "payload")
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    rows = nodes.groupBy("grp", block).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members"))
    left_over = [(F.col("n") > FANOUT**k).cast("int") for k in range(LEVELS)]
    rows = rows.withColumn("levels", sum(left_over[1:], left_over[0]))
    rows = rows.withColumn("level_0", F.col("members.digest"))
    for k in range(1, LEVELS + 1):
        hashed = F.when(F.col("levels") >= k, _level_above(F.col(f"level_{k - 1}")))
        rows = rows.withColumn(f"level_{k}", F.coalesce(hashed, F.array().cast("array<string>")))
    tree = F.array(*[F.col(f"level_{k}") for k in range(LEVELS + 1)])
    rows = rows.withColumn("tree", F.slice(tree, 1, F.col("levels") + 1))
    top = F.element_at(F.col("tree"), -1)[0].alias("top")
    return rows.select("grp", "block", "n", "levels", "members", "tree", top)


def _path(at: Column) -> Column:
    """The siblings, left and right, of a member's ancestors inside its block."""

    def siblings(k: Column) -> Column:
        nodes = F.element_at("tree", k + 1)
        place = F.floor(at / F.pow(F.lit(FANOUT), k)).cast("int")
        first = place - place % FANOUT
        return F.struct(
            F.array_join(F.slice(nodes, first + 1, place - first), "").alias("left"),
            F.array_join(F.slice(nodes, place + 2, first + FANOUT - 1 - place), "").alias("right"),
        )

    inside = F.transform(F.sequence(F.lit(0), F.col("levels") - 1), siblings)
    return F.when(F.col("levels") > 0, inside).otherwise(F.array().cast(_PATH))


def _with_paths(members: Column) -> Column:
    def each(m: Column) -> Column:
        return F.struct(m["at"].alias("at"), m["digest"].alias("digest"), m["payload"].alias("payload"), _path(m["at"]).alias("path"))

    return F.transform(members, each)


@dataclass(frozen=True)
class Tree:
    """The stored rounds of blocks of a forest, one tree per ``grp``; the leaves' round first."""

    rounds: list[DataFrame]

    @staticmethod
    def over(nodes: DataFrame) -> Tree:
        """The tree of ``nodes`` (grp, pos, n, digest, payload); the driver sees one number a round."""
        rounds = []
        while True:
            blocks = cut(_blocks(nodes))
            rounds.append(blocks)
            most = blocks.agg(F.max("n")).first()[0]
            if most is None or most <= BLOCK:
                return Tree(rounds)
            nodes = blocks.select(
                "grp",
                F.col("block").alias("pos"),
                F.ceil(F.col("n") / BLOCK).alias("n"),
                F.col("top").alias("digest"),
                F.lit(None).cast("boolean").alias("payload"),
            )

    def tops(self) -> DataFrame:
        """(grp, digest): the last digest of each tree."""
        return self.rounds[-1].select("grp", F.col("top").alias("digest"))

    def members(self, above: DataFrame) -> DataFrame:
        """(grp, pos, digest, payload, path, and the columns of ``above``) for each leaf.

        ``above`` has (grp, path) and more: how each tree's own top goes on. Paths come down
        round by round; a key of these joins is one block, so no group's size matters.
        """
        shared = [c for c in above.columns if c not in ("grp", "path")]
        upper = above.withColumn("block", F.lit(0).cast("long"))
        for blocks in reversed(self.rounds):
            known = upper.withColumnRenamed("path", "rest")
            each = blocks.join(known, ["grp", "block"]).withColumn("member", F.explode(_with_paths(F.col("members"))))
            upper = each.select(
                "grp",
                (F.col("block") * BLOCK + F.col("member.at")).alias("pos"),
                F.col("member.digest").alias("digest"),
                F.col("member.payload").alias("payload"),
                F.concat(F.col("member.path"), F.col("rest")).alias("path"),
                *shared,
            )
            leaves, upper = upper, upper.select("grp", F.col("pos").alias("block"), "path", *shared)
        return leaves


def copies(path: Column, start: Column) -> Column:
    """A version's own nodes: ``start`` and the copies of its ancestors up to the root.

    All other nodes of the version are those of the original tree.
    """

    def copy(done: Column, beside: Column) -> Column:
        return F.concat(done, F.array(digest_of(beside["left"], F.element_at(done, -1), beside["right"])))

    return F.aggregate(path, F.array(start), copy)


def proof_digest(path: Column) -> Column:
    """The hash of all siblings of a path, left to right and upwards."""
    return digest_of(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def merkle_manifest(
    df: DataFrame, tampered: dict[str, Column] | None = None, when: Column | None = None,
    id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS,
) -> DataFrame:
    """(id, leaf, subroot, root, path, copies) for each row of ``df``.

    A row's leaf is the hash of its ``fields``, each null or with its length, so values can't run
    into each other. Per group, leaves stand by id, null ids first, equal ids by their hash; each
    run of three consecutive nodes, the last run with fewer or one, becomes one, until the group's
    ``subroot`` is left. The subroots, null group first, the others bytewise, become ``root`` alike.
    ``path`` lists the siblings of the leaf's ancestors up to the root.

    Rows where ``when`` is true get a version of the tree of their own, in which the columns named
    in ``tampered`` have other values: ``copies`` are the nodes which that version doesn't share,
    from the leaf up to its root. Other rows, those where ``when`` is null too, are hashed up
    from their own leaf.

    Repeated rows are leaves of their own, empty texts a value of length 0. ``group_col`` is
    compared as text. An empty table gives no rows. Other columns of ``df``, whatever their
    names, are not read.
    """
    values = {c: F.col(c) for c in fields}
    other = leaf([(tampered or {}).get(c, values[c]) for c in fields])
    changed = F.coalesce(when, F.lit(False)) if when is not None else F.lit(False)
    rows = df.select(
        _key(F.col(group_col)).alias("grp"),
        F.col(id_col).alias("id"),
        leaf(list(values.values())).alias("digest"),
        F.when(changed, other).alias("version"),
    )
    rows = numbered(cut(rows), ["id", "digest"])
    leaves = Tree.over(rows.select("grp", "pos", "n", "digest", F.struct("id", "version").alias("payload")))
    groups = leaves.tops().select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest")
    groups = numbered(groups, ["key"]).select("grp", "pos", "n", "digest", F.struct("key").alias("payload"))
    whole = Tree.over(groups)
    root = whole.tops().select("grp", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    above = whole.members(root).select(
        F.col("payload.key").alias("grp"), "path", F.col("digest").alias("subroot"), "root"
    )
    found = leaves.members(above)
    start = F.coalesce("payload.version", "digest")
    return found.select(
        F.col("payload.id").alias(id_col),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        copies(F.col("path"), start).alias("copies"),
    )


def document_proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each document.

    Every document whose crc32 of the decimal id is even is checked with its line breaks
    deleted, so it fails where its text has any; a null text or id is never changed.
    """
    broken = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    when = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = merkle_manifest(docs, {"text": broken}, when)
    folded = F.element_at("copies", -1)
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )
