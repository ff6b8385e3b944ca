"""Files that the queries of sources and sinks write and read back."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import place


#: Rows of a landed file.
PART = 100_000


def landed(rows: DataFrame, line: Column, order: str, name: str, root: str | None = None, one: bool = False) -> str:
    """A folder of text files: a line for each row, in order, inside an XML root element of each file if one is named.
    A file has about PART rows and is one task's; one: a single file, for formats whose header or order is the file's."""
    spark = rows.sparkSession
    path = place(spark, name)
    lines = rows.select(F.col(order).cast("long").alias("k"), line.alias("value"))
    parts = 1 if one else max(1, -(-rows.count() // PART))

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("value", pa.string())])
        own = lambda values: pa.RecordBatch.from_arrays([values], schema=schema)
        yield own(pa.array([f"<{root}>"]))
        for batch in batches:
            yield own(batch.column(0))
        yield own(pa.array([f"</{root}>"]))

    sorted_lines = lines.repartitionByRange(parts, "k").sortWithinPartitions("k").select("value")
    (sorted_lines.mapInArrow(rooted, "value string") if root else sorted_lines).write.text(path)
    return path


def files(spark: SparkSession, contents: dict[str, str], name: str) -> str:
    """A folder of small files by relative path, written by the driver."""
    path = place(spark, name).removeprefix("file:")
    for relative, content in contents.items():
        full = os.path.join(path, relative)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w", encoding="utf-8") as f:
            f.write(content)
    return path


def tag(name: str, body: Column | str, **attributes: Column | str) -> Column:
    """An XML element."""
    text = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    given = [y for k, v in attributes.items() for y in (F.lit(f' {k}="'), text(v), F.lit('"'))]
    return F.concat(F.lit(f"<{name}"), *given, F.lit(">"), text(body), F.lit(f"</{name}>"))
