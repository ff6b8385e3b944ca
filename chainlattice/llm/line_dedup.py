"""Line dedup: multi-line chunks that stand in the corpus before are removed.

A rolling hash over the hashes of WINDOW lines decides where a chunk ends, so boundaries depend on
the lines around them alone and find each other again after lines are put in or taken out. Chunks
have MIN_LINES lines or more; a text's last chunk may be shorter. It is left alone or, with `tails`,
goes if it stands after the same chunk at an earlier text's end: it is compared together with the
chunk before it, which is still compared for itself too. Texts of one line lose nothing, nor do
shared passages without a whole chunk inside; README gives figures.

First pass: the chunks' 128-bit hashes. Those that occur more than once are repeated, and the first
occurrence (smallest key, nulls last, then smallest text hash and place) stays. Second pass: the
texts of chunks whose hash may be repeated, by a bitmap of FILTER bits of all repeated hashes (8 MB,
however large the corpus; a full bitmap lets more texts through, never fewer), are written out, and
each repeated one is compared with its first occurrence byte by byte; equal ones go. Counts are
pre-aggregated before the shuffle; the comparison is a sort-merge join of two written tables, whose
hot hashes adaptive execution can split.

Cases: null texts stay null; empty ones stay empty. Identical rows (same key and text) are treated
alike and lose the same chunks: one of them is no earlier occurrence of the other. A chunk repeated
inside one text goes there from its second place on. Very long texts are taken whole. Input columns
other than key and text are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, slices

WINDOW, EVERY, MIN_LINES, FILTER = 2, 3, 2, 1 << 26


def chunks(data: bytes) -> list[tuple[int, list[bytes]]]:
    """The chunks of a text in order: first line number and lines."""
    lines = data.split(b"\n")
    one = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in lines), np.uint64, len(lines))
    rolled = one.copy()
    for back in range(1, WINDOW):
        turned = (one << np.uint64(back)) | (one >> np.uint64(64 - back))
        rolled[back:] ^= turned[:-back]
    ends = ((rolled % np.uint64(EVERY)) == 0).tolist()
    out, first = [], 0
    for i, end in enumerate(ends):
        if end and i + 1 - first >= MIN_LINES:
            out.append((first, lines[first : i + 1]))
            first = i + 1
    if first < len(lines):
        out.append((first, lines[first:]))
    return out


def _repeatable(data: bytes, tails: bool = False) -> Iterator[tuple[int, bytes]]:
    before: list[bytes] = []
    for first, own in chunks(data):
        if len(own) >= MIN_LINES:
            yield first, b"\n".join(own)
        elif tails and before:
            yield first, b"\n".join(before + own)
        before = own


def _bucket(digest: bytes) -> int:
    return int.from_bytes(digest[:4], "little") % FILTER


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["key"].eqNullSafe(b["key"]) & (a["print"] == b["print"])


def _bitmap(digests: DataFrame) -> np.ndarray:
    """One bit for each bucket, set where a digest falls into it."""
    parts = digests.select((F.col("bucket") + 1).alias("value")).groupBy(F.bitmap_bucket_number("value").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits")).collect()
    out = np.zeros(FILTER // 8, np.uint8)
    for part in parts:
        out[(part.bucket - 1) * len(part.bits) : part.bucket * len(part.bits)] = np.frombuffer(bytes(part.bits), np.uint8)
    return out


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", tails: bool = False) -> DataFrame:
    """key, text without the repeated chunks, n_lines, n_removed (lines) and n_chunks (removed)."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("print"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def listed(batch: pa.RecordBatch, keep=None) -> pa.RecordBatch | None:
        """A row for each chunk of a batch: key, print, at, digest and bucket or, of those to keep, the bytes."""
        found = [(i, at, xxhash.xxh3_128_digest(t), t) for i, data in enumerate(batch.column(2).cast(pa.binary()).to_pylist()) if data for at, t in _repeatable(data, tails)]
        if keep is not None:
            bits = np.array([_bucket(f[2]) for f in found], np.int64)
            found = [f for f, k in zip(found, (keep[bits >> 3] >> (bits & 7) & 1).tolist(), strict=True) if k]
        if not found:
            return None
        row, at, digest, chunk = zip(*found, strict=True)
        columns = [*(batch.column(c).take(pa.array(row)) for c in (0, 1)), pa.array(at, pa.int32()), pa.array(digest, pa.binary())]
        last = pa.array([_bucket(d) for d in digest], pa.int64()) if keep is None else pa.array(chunk, pa.binary())
        return pa.RecordBatch.from_arrays([*columns, last], names=["key", "print", "at", "digest", "bucket" if keep is None else "chunk"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from filter(None, map(listed, slices(batches)))

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from filter(None, (listed(batch, shared.value) for batch in slices(batches)))

    every = rows.mapInArrow(hashed, f"key {kind}, print long, at int, digest binary, bucket long")
    place = F.struct(F.col("key").isNull().alias("null"), "key", "print", "at")
    repeated = durable(every.groupBy("digest", "bucket").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"), "repeated")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(repeated))
    texts = durable(rows.mapInArrow(fetched, f"key {kind}, print long, at int, digest binary, chunk binary"), "texts")
    first = durable(texts.join(repeated.hint("merge"), "digest").where(place == F.col("first")).select("digest", F.col("chunk").alias("first_chunk"), "first").dropDuplicates(["digest"]), "first")
    gone = texts.join(first.hint("merge"), "digest").where((place != F.col("first")) & (F.col("chunk") == F.col("first_chunk"))).groupBy("key", "print").agg(F.collect_set("at").alias("gone"))
    gone = durable(gone, "gone")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for data, gone in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if data is None:
                    out.append((None, 0, 0, 0))
                    continue
                n = data.count(b"\n") + 1
                if gone:
                    kept = [x for first, own in chunks(data) if first not in gone for x in own]
                    out.append((b"\n".join(kept).decode(), n, n - len(kept), len(set(gone))))
                else:
                    out.append((data.decode(), n, 0, 0))
            if out:
                new, *numbers = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string()), *(pa.array(x, pa.int64()) for x in numbers)], names=["key", "text", "n_lines", "n_removed", "n_chunks"])

    whole = rows.join(gone.hint("merge"), _same(rows, gone), "left").select(rows["key"], "text", "gone")
    return whole.mapInArrow(cut, f"key {kind}, text string, n_lines long, n_removed long, n_chunks long").withColumnsRenamed({"key": key, "text": text})
