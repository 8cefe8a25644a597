"""Shared folder for checkpoints and intermediate tables.

The folder is the one the cluster names in ``spark.checkpoint.dir``. A local folder is only used
when that is unset and Spark itself runs on one machine, as in tests.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Of tables whose size is known before they are stored.
ROWS_OF_A_FILE = 10_000


def _root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _one_machine()


@functools.cache
def _one_machine() -> str:
    return tempfile.mkdtemp(prefix="tierlake-")


def folder(spark: SparkSession, purpose: str) -> str:
    """A new path, not yet created, in the shared folder."""
    return f"{_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them from there, partition by partition.

    Later plans see the same placement of rows, also when executors are lost in between.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_root(spark))
    return df.checkpoint()


def stored(df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """Write the rows as Parquet to the shared folder; two readers then share one computation.

    ``rows`` is about how many there are at most, where that is known: a small table then has few files, however many
    shuffle partitions there are. Where files are local, Hadoop starts a process for each one that it makes, and while
    that starts it counts as much memory as the executor itself.
    """
    path = folder(df.sparkSession, purpose)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_OF_A_FILE)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def temporary(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """As ``stored``, for readers inside of the block; the files go at its end, also after a failure."""
    spark = df.sparkSession
    path = folder(spark, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
