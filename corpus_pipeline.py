"""From raw documents to token ids: language, lines, near copies, benchmark leaks, pieces.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns the rows
that it keeps; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import queries
from hirelens.llm.common import read, small_batches
from hirelens.llm.decontaminate import find_leaks
from hirelens.llm.language import UNDETERMINED, identify
from hirelens.llm.lines import dedup_lines
from hirelens.llm.pieces import encode
from hirelens.llm.shingle_join import jaccard_components
from hirelens.session import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a probability of at least ``LEAST_SCORE``.

    The model learns from the rows of ``docs`` with a language whose crc32(doc_id) mod 4 is
    not 2. ``lang`` itself stays as it was.
    """
    found = identify(docs.select(*COLUMNS), queries.language_model(docs))
    known = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.filter(known).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that five or more share; ``n_chars`` follows the text.

    A document that loses all its text goes.
    """
    left = dedup_lines(docs.select(*COLUMNS))
    cut_rows = F.col("n_dropped") > 0
    left = left.filter(~cut_rows | (F.trim("text") != ""))
    chars = F.when(cut_rows, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", chars).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; rows with a null id stay."""
    found = jaccard_components(docs)
    others = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(others, "doc_id", "left_anti").select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; rows with a null id are told apart by their texts."""
    keyed = docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.sha2("text", 256))).alias("key"))
    leaks = find_leaks(keyed, read(spark, sf_dir, "benchmark"), id_col="key").select("key").distinct()
    return keyed.join(leaks, "key", "left_anti").select(*COLUMNS)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the piece ids of the whole text, and their number."""
    coded = encode(docs.select("doc_id", "text"), queries.tokenizer())
    return coded.select("doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"))


STAGES = [
    ("language_id", keep_known_language),
    ("line_dedup", drop_common_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("sentencepiece", to_pieces),
]

# No stage chain with models, near copies by hash joins and Viterbi search has a SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/pipeline/{uuid.uuid4().hex}"
    with small_batches(spark):
        for name, stage in STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
