"""What the training-data operators share: table access and durable intermediate tables."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space and the five ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or "*")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the session's spark.checkpoint.dir, or the context's checkpoint folder. Where neither
    is set, a temporary folder serves a local session; on a cluster that would be no shared one: an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isEmpty():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chainlattice-"))
            held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """While a table is written, Python workers get batches of so many rows at most: ten thousand texts at
    once, the default, take much memory on both sides. The session's own setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    if not 0 < int(own) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def durable(df: DataFrame, label: str, rows: int = 1024) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage ends there, and any
    executor can be lost afterwards. The files go when the application ends. rows: of a worker's batch at most."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    with small_batches(spark, rows):
        df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives freed memory back when its task ends: Python workers serve many
    tasks, and their allocators would keep the largest one's memory beside the next one's."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return whole


def trim() -> None:
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if give_back is not None:
        give_back(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows: a Python worker holds the words of one piece at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else kept."""
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(
        F.size(F.split(text, SPACE)) - F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) - F.when(text.rlike(r"(?:[\x20\x09-\x0D]|^)\z"), 1).otherwise(0),
        F.lit(0),
    ).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
