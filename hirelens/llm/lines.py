"""Line de-duplication over levelled sorted runs of line hashes, with DataFrame operators only."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import shared_dir

SPACES = " \t\n\x0b\f\r"
MIN_CHARS = 40
MIN_DOCS = 5
FANOUT = 4
BATCHES = 6


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased; other letters keep their case."""
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


class LineRuns:
    """What is known of all lines so far, as sorted runs in levels under the shared folder.

    A run has a row per key hash: the number of documents of its batches that hold the key,
    and its keeper, if the run is the first to hold it. A level has fewer than ``fanout``
    runs; ``fanout`` of them are merged to one run of the next level. Every stored row is
    thus rewritten once per level, and a new batch meets a few runs only.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.fanout = spark, fanout
        self.path = path or f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/line-runs/{uuid.uuid4().hex}"
        self.levels: list[list[DataFrame]] = []

    def _write(self, run: DataFrame) -> DataFrame:
        path = f"{self.path}/{uuid.uuid4().hex}"
        run.sortWithinPartitions("h1", "h2").write.parquet(path)
        return self.spark.read.schema(run.schema).parquet(path)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def known(self) -> DataFrame | None:
        """All runs' rows; a key may have one in each run."""
        runs = self.runs()
        return reduce(DataFrame.unionByName, runs) if runs else None

    @staticmethod
    def _merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def add(self, batch: DataFrame) -> None:
        """Add a batch of (h1, h2, id), one row per document and key.

        Keys that no run holds are new: their keeper is the batch's largest id. So the batch
        with the largest ids comes first. The others are added without a keeper.
        """
        counted = batch.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("largest"))
        known = self.known()
        if known is None:
            run = counted.withColumnRenamed("largest", "keeper")
        else:
            seen = known.filter("keeper is not null").select("h1", "h2", F.lit(True).alias("seen"))
            run = counted.join(seen.hint("merge"), ["h1", "h2"], "left").select(
                "h1", "h2", "n_docs", F.when(F.col("seen").isNull(), F.col("largest")).alias("keeper")
            )
        self._push(self._write(run), 0)

    def _push(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._push(self._write(self._merge(reduce(DataFrame.unionByName, full))), level + 1)

    def totals(self) -> DataFrame:
        """(h1, h2, n_docs, keeper) with one row per key."""
        known = self.known()
        if known is None:
            raise ValueError("no batch was added")
        return self._merge(known)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    batches: int = BATCHES, fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with n_lines, n_dropped and the kept text in ``text_col``; other columns stay.

    A text is split at line feeds; a null text is one empty line, kept as an empty text. Lines
    whose key (stripped, A-Z lower-cased) has at least ``min_chars`` code points and is held by
    at least ``min_docs`` documents go, except in the largest id that holds it. The ids are cut
    into ``batches`` ranges, added from the largest on. A key is known by two 64-bit hashes.

    A document is an id: rows with one id are one document for counting, and each row's text is
    cut by itself. Rows with a null id are neither counted nor cut. Columns of ``docs`` named
    n_lines or n_dropped are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.split(text, "\n", -1)
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/lines/{uuid.uuid4().hex}"

    # one pass over the texts: the long lines' hashes, kept by batch
    numbered = docs.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("body"), F.posexplode(lines).alias("pos", "line")
    )
    keyed = numbered.filter(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    keyed = keyed.filter(F.char_length("key") >= min_chars)
    bounds = docs.agg(F.min(f"`{id_col}`").alias("lo"), F.max(f"`{id_col}`").alias("hi")).first()
    if bounds["lo"] is None:
        cut_points = []
    else:
        span = int(bounds["hi"]) - int(bounds["lo"]) + 1
        cut_points = [int(bounds["lo"]) + span * i // batches for i in range(1, batches)]
    batch_of = sum((F.when(F.col("id") >= c, 1).otherwise(0) for c in cut_points), F.lit(0))
    keyed.select(
        "id", "body", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(41), "key").alias("h2"), batch_of.alias("batch")
    ).write.partitionBy("batch").parquet(folder)
    id_kind = docs.schema[id_col].dataType.simpleString()
    stored = spark.read.schema(f"id {id_kind}, body long, pos int, h1 long, h2 long, batch int").parquet(folder)

    runs = LineRuns(spark, fanout=fanout)
    for b in range(len(cut_points), -1, -1):
        runs.add(stored.filter(F.col("batch") == b).select("h1", "h2", "id").distinct())
    common = runs.totals().filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
    dropped = stored.join(common, ["h1", "h2"]).filter("id <> keeper")
    spots = dropped.groupBy("id", "body").agg(F.collect_set("pos").alias("__line_spots"))  # as long as one text's lines at most

    whole = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{id_col}`").alias("__line_id"), F.xxhash64(text).alias("__line_body"))
    marked = whole.join(spots.select(F.col("id").alias("__line_id"), F.col("body").alias("__line_body"), "__line_spots"), ["__line_id", "__line_body"], "left")
    few = F.coalesce("__line_spots", F.array().cast("array<int>"))
    left = F.when(
        F.size(few) > 0, F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(few, i)), "\n")
    ).otherwise(text)
    return marked.select(
        *[left.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
        F.size(lines).cast("long").alias("n_lines"),
        F.size(few).cast("long").alias("n_dropped"),
    )
