"""CSV files with line breaks inside quotes, read by as many tasks as their size asks for.

Lines are read split by split, as of any text file. Whether a line starts inside a quoted field
follows from the number of quotes before it in the file: odd means inside. Each split counts its
quotes, a running sum over the splits of a file says how many came before each split, and a
running sum inside a split does so for its lines. A line that starts outside begins a record;
lines that start inside are joined to it, across splits too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPLIT = ["file", "split"]


def _quotes(text: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit('"'), F.lit("")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, header) for each record: its text without the last line end, and whether a file begins with it.

    A quote belongs to a quoted field or is doubled inside one; lines end with a line feed, or with
    a carriage return and a line feed; where a record does, so do its inner lines, which then read
    as line feeds. The files are read twice, once for the quotes alone. A
    split's lines travel to one task; of the records only those that cross from one split into the
    next, at most two for each split, travel again.
    """
    lines = (
        spark.read.text(path, lineSep="\n")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
        .withColumn("quotes", _quotes("value"))
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("held").over(earlier), F.lit(0))
    splits = lines.groupBy(*_SPLIT).agg(F.sum("quotes").alias("held")).select(*_SPLIT, before.alias("before"))

    in_order = Window.partitionBy(*_SPLIT).orderBy("line")
    above = F.coalesce(F.sum("quotes").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(splits, _SPLIT).withColumn("inside", (F.col("before") + above) % 2 == 1)
    begins = F.when(~F.col("inside"), F.col("line"))
    placed = placed.withColumns(
        {
            "head": F.last(begins, ignorenulls=True).over(in_order),  # null: goes on from the split before
            "top": (F.col("split") == 0) & (F.first("line").over(in_order) == F.col("line")),
        }
    )
    one_line = ~F.col("inside") & (F.col("quotes") % 2 == 0)
    whole = placed.filter(one_line).select("file", F.col("value").alias("record"), F.col("top").alias("header"))
    pieces = (
        placed.filter(~one_line)
        .groupBy(*_SPLIT, "head")
        .agg(
            F.array_join(F.sort_array(F.collect_list(F.struct("line", "value")))["value"], "\n").alias("text"),
            F.bool_or("top").alias("header"),
            (F.sum("quotes") % 2 == 1).alias("odd"),
        )
        .withColumn("crosses", F.col("head").isNull() | F.col("odd"))
    )
    joined = pieces.filter("not crosses").select("file", F.col("text").alias("record"), "header")
    along = Window.partitionBy("file").orderBy("split", F.col("head").asc_nulls_first())
    crossing = (
        pieces.filter("crosses")
        .withColumn("number", F.count("head").over(along))
        .groupBy("file", "number")
        .agg(
            F.array_join(F.sort_array(F.collect_list(F.struct("split", "head", "text")))["text"], "\n").alias("record"),
            F.bool_or("header").alias("header"),
        )
        .drop("number")
    )
    records = whole.unionByName(joined).unionByName(crossing.select("file", "record", "header"))
    unified = F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), "\r\n", "\n")
    return records.withColumn("record", F.when(F.col("record").endswith("\r"), unified).otherwise(F.col("record")))


def read_multi_line_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Rows of headed CSV files whose quoted fields may hold line breaks; files are split like any others.

    Columns bind by position, the first record of a file is its header, empty lines are passed over,
    a malformed record fails the job. Equal to Spark's own ``multiLine`` reader, which takes one
    task per file, but that a quote which is never closed, so that the rest of the file would be one
    field, fails the job too.
    """
    unclosed = F.raise_error(F.concat(F.lit("MALFORMED_RECORD: unclosed quote in "), "file"))
    records = csv_records(spark, path).filter(~F.col("header") & (F.trim("record") != ""))
    record = F.when(_quotes("record") % 2 == 1, unclosed).otherwise(F.col("record"))
    parsed = F.from_csv(record, schema.simpleString(), {"mode": "FAILFAST", **options})
    return records.select(parsed.alias("row")).select("row.*")
