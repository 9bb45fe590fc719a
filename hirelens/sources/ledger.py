"""What a warehouse's builds have finished: an append-only table, and fingerprints of their inputs.

Every record is one small file that appears whole or not at all, so the ledger needs no lock for
its readers. One build at a time writes it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "seq long, generation string, step string, inputs string"
BEGUN, PUBLISHED, REMOVED = "begun", "published", "removed"


def fingerprint(df: DataFrame) -> DataFrame:
    """(rows, low, high): the row count and the sums of two hashes of each row.

    The same rows give the same sums in any order, files and partitions; a changed, missing or
    repeated row changes them. Nulls are hashed by place, so a value can't move to a neighbour.
    """
    values = [c for name in df.columns for c in (F.col(name), F.col(name).isNull())]

    def total(seed: int):
        return F.coalesce(F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")), F.lit(0)).cast("string")

    return df.agg(F.count(F.lit(1)).alias("rows"), total(1).alias("low"), total(2).alias("high"))


def inputs_key(frames: Mapping[str, DataFrame], **parameters: object) -> str:
    """One text for the content of all frames and the parameters of a build; one row per frame reaches the driver."""
    each = None
    for name, df in sorted(frames.items()):
        row = fingerprint(df).withColumn("name", F.lit(name))
        each = row if each is None else each.unionByName(row)
    sums = sorted([r["name"], r["rows"], r["low"], r["high"]] for r in each.collect())
    return hashlib.sha256(json.dumps([sums, parameters], sort_keys=True, default=str).encode()).hexdigest()


@dataclass(frozen=True)
class Record:
    seq: int
    generation: str
    step: str
    inputs: str


@dataclass(frozen=True)
class Ledger:
    """Records of one warehouse, in a folder or, without one, in a catalog table."""

    spark: SparkSession
    folder: str | None
    table: str

    def records(self) -> list[Record]:
        """All records in order: a few for each build that ever ran."""
        try:
            if self.folder:
                rows = self.spark.read.schema(SCHEMA).parquet(self.folder).collect()
            else:
                self.spark.catalog.refreshTable(self.table)
                rows = self.spark.table(self.table).collect()
        except AnalysisException as error:
            if "NOT_FOUND" not in str(error):
                raise
            return []
        return sorted((Record(*r) for r in rows), key=lambda r: r.seq)

    def append(self, generation: str, step: str, inputs: str = "") -> None:
        seq = max((r.seq for r in self.records()), default=0) + 1
        row = self.spark.createDataFrame([(seq, generation, step, inputs)], SCHEMA).coalesce(1)
        if self.folder:
            row.write.mode("append").parquet(self.folder)
        else:
            self.spark.sql(f"create database if not exists `{self.table.split('.')[0]}`")
            row.write.mode("append").format("parquet").saveAsTable(self.table)

    def begin(self, inputs: str, fresh: bool = False) -> str:
        """The generation to work on: the last one if it is unfinished and of the same inputs, else a new one."""
        begun = [r for r in self.records() if r.step == BEGUN]
        if begun and not fresh and begun[-1].inputs == inputs and PUBLISHED not in self.steps(begun[-1].generation):
            return begun[-1].generation
        generation = f"{inputs[:12]}_{uuid.uuid4().hex[:8]}"
        self.append(generation, BEGUN, inputs)
        return generation

    def steps(self, generation: str) -> set[str]:
        """What is finished of a generation."""
        return {r.step for r in self.records() if r.generation == generation}

    def published(self) -> list[Record]:
        """The generations that readers were given, the current one last."""
        return [r for r in self.records() if r.step == PUBLISHED]

    def current(self) -> Record | None:
        return (self.published() or [None])[-1]

    def begun_last(self) -> Record | None:
        return ([r for r in self.records() if r.step == BEGUN] or [None])[-1]

    def outdated(self, keep: int) -> list[str]:
        """Generations begun and not removed yet, but for the last ``keep`` published ones."""
        kept = {r.generation for r in self.published()[-keep:]} if keep else set()
        records = self.records()
        removed = {r.generation for r in records if r.step == REMOVED}
        return [r.generation for r in records if r.step == BEGUN and r.generation not in kept | removed]
