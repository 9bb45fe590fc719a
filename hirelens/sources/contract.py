"""Typed CSV files in, typed raw tables out."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CONTRACT
from .records import read_multi_line_csv
from .tables import Tables, at_once


def _path(src: str, table: str) -> str:
    return f"{src.rstrip('/')}/{table}.csv"


# Tables whose free text may hold line breaks inside quotes.
FREE_TEXT = frozenset({"interviews"})


def read_contract_csv(spark: SparkSession, src: str, table: str, multi_line: bool | None = None) -> DataFrame:
    """One contract table. Columns bind by position; a malformed row fails the job.

    Quotes inside quoted fields are doubled. With ``multi_line``, the default for tables with free
    text only, a quoted field may hold line breaks. Files split across tasks either way; such
    tables travel once more, see ``read_multi_line_csv``. Empty fields read as null, quoted or not.
    """
    path, options = _path(src, table), {"dateFormat": "yyyy-MM-dd", "escape": '"'}
    if table in FREE_TEXT if multi_line is None else multi_line:
        return read_multi_line_csv(spark, path, CONTRACT[table], **options)
    return spark.read.schema(CONTRACT[table]).csv(path, header=True, enforceSchema=True, mode="FAILFAST", **options)


def require_inputs(spark: SparkSession, src: str) -> None:
    """Raise, naming every contract file that is missing."""
    missing = []
    for table in CONTRACT:
        try:
            read_contract_csv(spark, src, table)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            missing.append(_path(src, table))
    if missing:
        raise FileNotFoundError(f"missing contract files: {', '.join(missing)}")


def contract_frames(
    spark: SparkSession, src: str, multi_line: Collection[str] = FREE_TEXT
) -> dict[str, DataFrame]:
    """All contract tables of a folder; raises, naming every file that is missing."""
    require_inputs(spark, src)
    return {table: read_contract_csv(spark, src, table, table in multi_line) for table in CONTRACT}


def land_raw(spark: SparkSession, src: str, tables: Tables, multi_line: Collection[str] = FREE_TEXT) -> dict[str, int]:
    """Reload the seven raw tables from CSV; rows per table and in total.

    Files of the tables in ``multi_line`` may hold line breaks inside quotes; where there are none,
    ``()`` saves the extra exchange that finds the records.
    """
    return land(contract_frames(spark, src, multi_line), tables)


def land(frames: Mapping[str, DataFrame], tables: Tables) -> dict[str, int]:
    """Write raw tables and count them from the stored files' footers."""
    counts = at_once(lambda name: tables.write(frames[name], "raw", name).count(), frames)
    return {**counts, "total": sum(counts.values())}


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every frame, and the grand total."""
    each = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    counted = reduce(DataFrame.unionByName, each)
    both = counted.select(F.explode(F.array("table_name", F.lit("total"))).alias("table_name"), "row_count")
    return both.groupBy("table_name").agg(F.sum("row_count").alias("row_count"))


def write_csv(df: DataFrame, path: str) -> None:
    """Standard CSV: quotes are doubled, outer spaces stay."""
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
