"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. The broadcast threshold and split sizes are left to the cluster.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange after the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


PARTITION_BYTES = 256 << 20
MAX_PARTITIONS = 50_000  # beyond this, tracking map x reduce blocks costs more than larger partitions


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime SQL settings every plan in this package expects.

    AQE merges small shuffle partitions and splits skewed ones, but it never
    raises their number. Pass the size of the largest shuffle, and shuffles start
    with partitions of about 256 MB, no fewer than the session's setting.
    """
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes:
        wanted = min(math.ceil(shuffle_bytes / PARTITION_BYTES), MAX_PARTITIONS)
        partitions = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hirelens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="hirelens-"))
    return context.getCheckpointDir()


_reader: ContextVar[SparkSession | None] = ContextVar("reader", default=None)


@contextmanager
def read_back_by(reader: SparkSession) -> Iterator[None]:
    """Inside, ``cut_lineage`` reads its tables by another session of the same application."""
    token = _reader.set(reader)
    try:
        yield
    finally:
        _reader.reset(token)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Nothing that is lost with an executor is needed again, and later readers
    scan only the columns they use.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/cut/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return (_reader.get() or spark).read.schema(df.schema).parquet(path)
