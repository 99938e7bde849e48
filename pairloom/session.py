"""Reliable storage and size checks taken from the running session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 16 * 1024 * 1024
# Parquet of texts: a text that comes again in a row group is a number there, as far as the different ones fit a dictionary.
TEXT_FILES = {
    "compression": "zstd",
    "parquet.dictionary.page.size": str(32 * 1024 * 1024),
    "parquet.block.row.count.limit": "20000",
}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only for local sessions."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="pairloom-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name beside the checkpoints; what is written there goes when the driver ends."""
    name = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a small derived table so that later plans read it as a leaf."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a derived table as Parquet beside the checkpoints and read it from there.

    For tables that later steps read in parts: scans prune columns and know the size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**TEXT_FILES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session, `_` for `.`, that hold for what is run inside."""
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffles_freed(spark: SparkSession):
    """Inside, the shuffle files of a query go as soon as its result is written, and not when the driver collects its garbage."""
    return settings(spark, spark_sql_classic_shuffleDependency_fileCleanup_enabled="true")


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    for name in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fits_broadcast(rows: int, text_bytes: int, bytes_per_row: int = 64) -> bool:
    return rows <= BROADCAST_MAX_ROWS and text_bytes + rows * bytes_per_row <= BROADCAST_MAX_BYTES


def broadcast_if(df: DataFrame, fits: bool) -> DataFrame:
    return F.broadcast(df) if fits else df
