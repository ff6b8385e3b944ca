"""Stores and raw files of label records as JSON, batches as JSON lines, label sets as Parquet."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BATCH, FLAGS, LABEL, LABEL_SET, RECORD, SCALARS
from ..shared import place

_KINDS = {"address": "string", "chain": "string"} | dict.fromkeys(FLAGS, "boolean") | dict.fromkeys(SCALARS, "string") | {"last_verified": "string"}
_COLUMNS = ["address", "chain", "labels", *FLAGS, *SCALARS, "last_verified", "extras"]


def _typed(rows: DataFrame) -> DataFrame:
    """RECORD columns from (ord, address key or null, JSON text of a record). Keys beyond the schema go
    to extras as JSON text, present ones even if null."""
    parsed = F.from_json("body", "map<string,string>")
    rows = rows.withColumn("m", parsed)
    field = lambda c: F.try_element_at("m", F.lit(c))
    columns = [field(c).cast(kind).alias(c) for c, kind in _KINDS.items() if c != "address"]
    extras = F.map_filter("m", lambda k, v: ~k.isin(*_KINDS, "labels"))
    out = rows.select("ord", F.coalesce(field("address"), F.col("key")).alias("address"), F.from_json(field("labels"), f"array<{LABEL}>").alias("labels"), *columns, extras.alias("extras"))
    return out.select("ord", *_COLUMNS)


def read_records(spark: SparkSession, path: str, source: int = 0) -> DataFrame:
    """Records of one file: a JSON list, or an object of records by address. ord: (source, place).

    The places are assigned while the document is taken apart, so they follow the file."""
    whole = spark.read.text(path, wholetext=True)
    listed = whole.where(F.ltrim("value").startswith("["))
    keyed = whole.where(~F.ltrim("value").startswith("["))
    items = listed.select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "body")).select("pos", F.lit(None).cast("string").alias("key"), "body")
    # the value of a map keeps the order of the document
    pairs = keyed.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("pos", "e")).select("pos", F.col("e.key").alias("key"), F.col("e.value").alias("body"))
    return _typed(items.unionByName(pairs).withColumn("ord", F.struct(F.lit(source).alias("source"), F.col("pos").cast("long").alias("pos"))))


def read_many(spark: SparkSession, folder: str, names: list[str] | None = None, base: str | None = None) -> DataFrame:
    """Records of a base store (first) and of files of a folder, in the order given or by name."""
    if names is None:
        names = sorted(n for n in os.listdir(folder) if n.endswith(".json"))
    paths = ([base] if base else []) + [os.path.join(folder, n) for n in names]
    missing = [p for p in paths if not os.path.exists(p)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    out = empty(spark)
    for i, p in enumerate(paths):
        out = out.unionByName(read_records(spark, p, i if base else i + 1).withColumn("file", F.lit(os.path.basename(p))))
    return out


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"ord struct<source:int,pos:bigint>, {RECORD}, file string")


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """An attribution batch with ord, the line's number. One file is one task: its order is its meaning."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("ord", "line")).where(F.trim("line") != "")
    return lines.select(F.col("ord").cast("long").alias("ord"), F.from_json("line", BATCH).alias("r")).select("ord", "r.*")


def read_label_set(spark: SparkSession, path: str | None) -> DataFrame:
    """A label set as the base of a merge; its provenance starts empty."""
    if path is None:
        return spark.createDataFrame([], LABEL_SET)
    return spark.read.schema(LABEL_SET).parquet(path).withColumn("provenance", F.array().cast("array<string>"))


def file_digest(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def content_digest(df: DataFrame) -> str:
    """A digest of a table's rows that doesn't depend on their order or files: the sum of row hashes."""
    row = F.xxhash64(*[F.to_json(F.struct(F.col(c))) for c in sorted(df.columns)])
    r = df.select(row.cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("n"), F.coalesce(F.sum("h"), F.lit(0)).alias("s")).first()
    return hashlib.sha256(f"{r.n}:{r.s}".encode()).hexdigest()


def write_store(store: DataFrame, path: str) -> int:
    """The store as one JSON object in order of ord; null fields are left out. The number of records.

    Tasks write the records as sorted parts in the shared folder; the driver only appends their bytes, a buffer at a time."""
    spark = store.sparkSession
    kept = [c for c in store.columns if c not in ("ord", "extras", "n_records")]
    rows = store.orderBy("ord").select("address", F.to_json(F.struct(*kept)).alias("j"), F.to_json("extras").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for address, j, x in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                lines.append(json.dumps(address) + ": " + json.dumps(json.loads(j) | json.loads(x or "{}"), ensure_ascii=False) + ",")
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    parts = place(spark, "store-parts")
    rows.mapInArrow(run, "value string").write.text(parts)
    n = spark.read.text(parts).count()
    with open(path, "wb") as f:
        f.write(b"{\n" if n else b"{")
    hadoop = spark._jvm.org.apache.hadoop
    where = hadoop.fs.Path(parts)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(x.getPath().toString() for x in fs.listStatus(where) if x.getPath().getName().startswith("part-"))
    out = spark._jvm.java.io.FileOutputStream(path, True)
    for name in names:
        part = fs.open(hadoop.fs.Path(name))
        hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
        part.close()
    out.close()
    fs.delete(where, True)
    with open(path, "r+b") as f:
        if n:
            f.seek(-2, os.SEEK_END)  # the last record's comma
            f.truncate()
        f.seek(0, os.SEEK_END)
        f.write(b"\n}\n")
    return n


def write_table(df: DataFrame, path: str, order: list, compression: str = "snappy", refuse_empty: bool = True) -> None:
    """A registry as one sorted Parquet file."""
    if refuse_empty and df.isEmpty():
        raise ValueError("no records to write")
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("compression", compression).parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_manifest(path: str, **content) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(content, f, indent=2, ensure_ascii=False, sort_keys=True)


def write_tagpack(tags: DataFrame, header: dict, path: str, confidence: str | None) -> int:
    """A tag pack as YAML, tag by tag; the confidence that all share stands in the header. The number of tags."""
    quote = lambda v: json.dumps(v, ensure_ascii=False)  # noqa: E731  a JSON string is a YAML one
    columns = ["address", "currency", "label", "source", "category", *([] if confidence else ["confidence"]), "actor", "context"]
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        for k, v in (header | ({"confidence": confidence} if confidence else {})).items():
            f.write(f"{k}: {quote(v)}\n")
        f.write("tags:\n")
        for r in tags.orderBy("place").toLocalIterator():
            own = [(c, r[c]) for c in columns if r[c] is not None]
            f.write("".join(f"{'- ' if i == 0 else '  '}{c}: {quote(v)}\n" for i, (c, v) in enumerate(own)))
            n += 1
    return n
