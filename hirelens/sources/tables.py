"""Stored tables in four layers: raw, staging, intermediate, marts; whole builds as generations."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from .files import remove
from .ledger import PUBLISHED, REMOVED, Ledger

LAYERS = ("raw", "intermediate", "marts")

T = TypeVar("T")
WRITERS = 4


def at_once(work: Callable[[str], T], names: Iterable[str], writers: int = WRITERS) -> dict[str, T]:
    """``work`` for every name, a few Spark jobs at a time; the first error is raised.

    Independent tables share the cluster, so the tail of one write does not idle it.
    """
    names = tuple(names)
    with ThreadPoolExecutor(writers) as pool:
        return dict(zip(names, pool.map(work, names)))


def layer_name(custom: str | None, default: str) -> str:
    """A layer's own name verbatim when it has one, else the target's default."""
    return custom.strip() if custom else default


class Frames(Mapping[str, DataFrame]):
    """Named frames, each planned when first asked for."""

    def __init__(self, names: Sequence[str], plan: Callable[[str], DataFrame]):
        self._names, self._plan, self._planned = tuple(names), plan, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            if name not in self._names:
                raise KeyError(name)
            self._planned[name] = self._plan(name)
        return self._planned[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


@dataclass(frozen=True)
class Tables:
    """Parquet tables under ``root``, or catalog tables when ``root`` is None.

    Tables may be bucketed, so that marts joined on the same key later read
    without an exchange. Under ``root`` only the frame that ``write`` returns
    knows of the buckets; ``read`` takes the files as they are.

    Without a ``generation`` tables have one place each. A build writes a generation of its own,
    which readers don't see until it is published: the ledger's last ``published`` record is the
    pointer they follow, and it is written after everything it points to.
    """

    spark: SparkSession
    root: str | None = None
    buckets: int | None = None
    generation: str | None = None

    @property
    def ledger(self) -> Ledger:
        folder = f"{self.root.rstrip('/')}/state/ledger" if self.root else None
        return Ledger(self.spark, folder, "state.ledger")

    def at(self, generation: str) -> Tables:
        return replace(self, generation=generation)

    def current(self) -> Tables:
        """The tables of the published generation; an error if there is none."""
        pointer = self.ledger.current()
        if pointer is None:
            raise LookupError(f"no build is published under {self.root or 'the catalog'}")
        return self.at(pointer.generation)

    def folder(self, name: str) -> str:
        """A folder for other files that belong to the generation."""
        if not self.root:
            raise ValueError("catalog tables have no folder")
        inside = f"/generations/{self.generation}" if self.generation else ""
        return f"{self.root.rstrip('/')}{inside}/{name}"

    def database(self, layer: str) -> str:
        return f"{layer}_{self.generation}" if self.generation else layer

    def location(self, layer: str, name: str) -> str:
        return f"{self.folder(layer)}/{name}" if self.root else f"{self.database(layer)}.{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        where = self.location(layer, name)
        return self.spark.read.parquet(where) if self.root else self.spark.table(where)

    def write(self, df: DataFrame, layer: str, name: str, bucket_by: Sequence[str] = ()) -> DataFrame:
        """Full refresh, then read back: later plans start at stored files."""
        writer = df.write.mode("overwrite")
        if self.root:
            location = self.location(layer, name)
            if self.buckets and bucket_by:
                table = f"hirelens_{hashlib.sha256(location.encode()).hexdigest()[:24]}"
                writer.bucketBy(self.buckets, *bucket_by).option("path", location).format("parquet").saveAsTable(table)
                return self.spark.table(table)
            writer.parquet(location)
        else:
            self.spark.sql(f"create database if not exists `{self.database(layer)}`")
            if self.buckets and bucket_by:
                writer = writer.bucketBy(self.buckets, *bucket_by).sortBy(*bucket_by)
            writer.format("parquet").saveAsTable(self.location(layer, name))
        return self.read(layer, name)

    def view(self, df: DataFrame, name: str) -> DataFrame:
        """A layer that is only named, not stored."""
        df.createOrReplaceTempView(name)
        return df

    def publish(self, inputs: str, keep: int = 2) -> None:
        """Make this generation the one that readers get, then remove all but the last ``keep`` published ones.

        Readers that opened an older one may go on with it until the next but one is published.
        Catalog tables also get views under the layers' plain names.
        """
        self.ledger.append(self.generation, PUBLISHED, inputs)
        if not self.root:
            for layer in LAYERS:
                self.spark.sql(f"create database if not exists `{layer}`")
                for table in self.spark.catalog.listTables(self.database(layer)):
                    if not table.isTemporary:
                        self.spark.sql(
                            f"create or replace view `{layer}`.`{table.name}` as "
                            f"select * from `{self.database(layer)}`.`{table.name}`"
                        )
        for generation in self.ledger.outdated(keep):
            self.at(generation).remove()

    def remove(self) -> None:
        """Delete this generation's tables."""
        if self.root:
            remove(self.spark, self.folder(""))
        else:
            for layer in LAYERS:
                self.spark.sql(f"drop database if exists `{self.database(layer)}` cascade")
        self.ledger.append(self.generation, REMOVED)

    def is_built(self) -> bool:
        """True after a build that passed all its checks, until another one begins."""
        begun, pointer = self.ledger.begun_last(), self.ledger.current()
        return pointer is not None and begun is not None and begun.generation == pointer.generation
