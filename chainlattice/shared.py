"""Fresh paths that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def place(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's shared folder, or in a temporary one of a local session; gone when the application ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{(base or tempfile.gettempdir()).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
