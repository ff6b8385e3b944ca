"""Token-id output: documents as token ids in checksummed, independently coded blocks.

Writing: documents are dealt by range of their key (text hash second) and sorted; each task
tokenises its range, ends each document with END, and gathers whole documents into segments of about
SEGMENT ids (a longer document makes a segment of its own). A segment is one row of a Parquet
table: its place (shard, number), the keys and lengths of its documents, and the coded bytes of
token_codec, whose blocks are reset and checksummed one by one. Spark's committer makes lost tasks
harmless: a shard is the partition number, so a second attempt writes the same segments.

Reading: a segment is decoded for itself and checked; the ids before it are a running sum over the
numbers of ids per segment and shard (a few bytes each).

White space never meets a token of the tokenizer used here (its pre-tokenizer drops it and no
normalisation joins characters across it), so texts are encoded piece by piece between ASCII white
space: Arrow splits and numbers the different pieces of a round of texts, and each is encoded once a
round. A piece of letters of ASCII and Latin-1, digits and ASCII punctuation without apostrophes is
only lower-cased by the tokenizer's normaliser and cut into runs of letters, single digits and runs of
punctuation by its pre-tokenizer, so such runs go to the tokenizer's model directly; all other pieces
go through the whole tokenizer. A Python worker keeps the ids of the first CACHE different runs and
other pieces that it meets twice in a round, over all its tasks, and encodes others again. Set pieces=False for other tokenizers.

The number of ranges follows the texts' bytes, PART for each, and is never below the session's shuffle partitions.

Cases: null and empty texts are the end id alone. Null keys come first. Rows with equal keys are
documents of their own, ordered by text hash; identical rows may be dealt over several ranges. Columns
other than key and text are not read, whatever their names. An empty table gives an empty output.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_path, shuffle_partitions, small_batches, trim, trimmed
from .token_codec import decode, encode

END, SEGMENT, CACHE, PART, ROUND = 1, 1 << 21, 200_000, 128 << 20, 2048
AT_ONCE = 2 << 20  # bytes of texts in a round, about
LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", r"!-&(-/:-@\[-`{-~"
PLAIN, RUN = f"^[{LETTERS}0-9{MARKS}]+\\z", f"([{LETTERS}]+|[0-9]|[{MARKS}]+)"  # for RE2
_OPEN: dict[tuple[str, bool], Pieces] = {}


def opened(path: str, pieces: bool) -> Pieces:
    """This process's encoder for a tokenizer: its known pieces serve all tasks of a worker."""
    if (path, pieces) not in _OPEN:
        _OPEN[path, pieces] = Pieces(path, pieces)
    return _OPEN[path, pieces]


def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches (key, text) in rounds of about AT_ONCE bytes of texts; a longer text is a round of its own."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            last = max(first + (not held), int(np.searchsorted(ends, before + AT_ONCE - size, "right")))
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(ends[last - 1]) - before
            if last < batch.num_rows:
                yield pa.concat_batches(held)
                held, size = [], 0
            first = last
    if held:
        yield pa.concat_batches(held)


class Pieces:
    """Encodes texts piece by piece, keeping the ids of up to CACHE runs and pieces."""

    def __init__(self, path: str, pieces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.pieces, self.known = Tokenizer.from_file(path), pieces, {}
        self.model = self.tokenizer.model
        added = [re.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = "(?i)" + "|".join(added) if added else None
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(128, 256)}

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids. The tokenizer's own records of a text are many times its ids, so it gets ROUND texts at once."""
        batches = (self.tokenizer.encode_batch_fast(texts[i : i + ROUND], add_special_tokens=False) for i in range(0, len(texts), ROUND))
        return [np.array(x.ids, np.uint32).tobytes() for own in batches for x in own]

    def _runs(self, runs: list[str]) -> list[bytes]:
        """The ids of lower-cased runs by the tokenizer's model, which takes letters as its byte-level form has them."""
        model, flat, ends = self.model.tokenize, array("I"), [0]
        for run in runs:
            flat.extend([x.id for x in model(run if run.isascii() else run.translate(self.letters))])
            ends.append(4 * len(flat))
        ids = flat.tobytes()
        return [ids[a:b] for a, b in pairwise(ends)]

    def _found(self, pieces: list[str], often: np.ndarray, encode: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different pieces, one after another, and how many each has. encode gets those that are not
        known; what occurs often enough is kept."""
        own = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(own) if x is None]
        kept = often[missing].tolist()
        for i, keep, ids in zip(missing, kept, encode([pieces[i] for i in missing]), strict=True):
            own[i] = ids
            if keep and len(self.known) < CACHE:
                self.known[pieces[i]] = ids
        return np.frombuffer(b"".join(own), np.uint32), np.fromiter(map(len, own), np.int64, len(own)) // 4

    def _pieces(self, pieces: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different pieces, how many each has, and each piece's place among these. times: how often each occurs."""
        plain = pc.match_substring_regex(pieces, PLAIN)
        if self.added:
            plain = pc.and_not(plain, pc.match_substring_regex(pieces, self.added))
        runs = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(pieces.filter(plain)), RUN, r"\1 "), " ")  # "" ends each
        coded = runs.flatten().dictionary_encode()
        mine = coded.indices.to_numpy()
        chosen = plain.to_numpy(zero_copy_only=False)
        starts = runs.offsets.to_numpy()
        often = np.bincount(mine, np.repeat(times[chosen], np.diff(starts)), len(coded.dictionary)) > 1
        ids, lengths = self._found(coded.dictionary.to_pylist(), often, self._runs)
        ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(ids)).take(pa.array(mine)).flatten().to_numpy()
        lengths = np.add.reduceat(lengths[mine], starts[:-1]) if len(mine) else lengths
        more, others = self._found(pieces.filter(pc.invert(plain)).to_pylist(), times[~chosen] > 1, self._ids)
        place = np.where(chosen, np.cumsum(chosen), len(lengths) + np.cumsum(~chosen)) - 1
        return np.concatenate([ids, more]), np.concatenate([lengths, others]), place.astype(np.int32)

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text, with END."""
        if not self.pieces:
            end = np.uint32(END).tobytes()
            return [np.frombuffer(x + end, np.uint32) for x in self._ids(texts if isinstance(texts, list) else texts.to_pylist())]
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        coded = split.flatten().dictionary_encode()
        numbers = coded.indices.to_numpy()
        ids, lengths, place = self._pieces(coded.dictionary, np.bincount(numbers, minlength=len(coded.dictionary)))
        ids, lengths = np.append(ids, np.uint32(END)), np.append(lengths, 1)
        # END is the last piece; it stands behind the pieces of each text
        closing = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)) + np.arange(len(split))
        order = np.full(len(coded) + len(split), len(lengths) - 1, np.int32)
        inner = np.ones(len(order), bool)
        inner[closing] = False
        order[inner] = place[numbers]
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(ids))
        whole = lists.take(pa.array(order)).flatten().to_numpy()
        ends = np.cumsum(lengths[order])[closing].tolist()
        return [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", pieces: bool = True, segment: int = SEGMENT) -> None:
    """Write the documents' ids under path, in ascending order of key."""
    spark = docs.sparkSession
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.col("__row")]
    rows = own.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(max(shuffle_partitions(spark), -(-size // PART)), *order).sortWithinPartitions(*order).drop("__row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, coder = TaskContext.get().partitionId(), 0, None
        keys, ids, n = [], [], 0

        def flush() -> pa.RecordBatch:
            sizes, whole = [len(x) for x in ids], np.concatenate(ids)
            ids.clear()
            trim()  # what the rounds took, before the coder takes its own
            columns = [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([keys], schema.field("keys").type), pa.array([sizes], pa.list_(pa.int32())), pa.array([n], pa.int64()), pa.array([encode(whole)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        schema = None
        for batch in rounds(batches):
            if schema is None:
                schema = pa.schema([("shard", pa.int32()), ("number", pa.int32()), ("keys", pa.list_(batch.column(0).type)), ("sizes", pa.list_(pa.int32())), ("n", pa.int64()), ("data", pa.binary())])
                coder = opened(tokenizer, pieces)
            for k, x in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1)), strict=True):
                if n and n + len(x) > segment:
                    yield flush()
                    keys, ids, n, number = [], [], 0, number + 1
                    trim()
                keys.append(k)
                ids.append(x)
                n += len(x)
        if keys:
            yield flush()

    with small_batches(spark):
        rows.mapInArrow(trimmed(run), f"shard int, number int, keys array<{rows.schema['key'].dataType.simpleString()}>, sizes array<int>, n long, data binary").write.parquet(path)


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """For each document of the files: key, start (ids before it), n_tokens and ids_crc32."""
    files = spark.read.parquet(path)
    inside = Window.partitionBy("shard").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n").alias("n")).select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    starts = files.select("shard", "number", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("first")).join(shards, "shard").select("shard", "number", (F.col("ahead") + F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = decode(batch.column(4)[i].as_py())
                sizes = np.array(batch.column(3)[i].as_py(), np.int64)
                ends = np.cumsum(sizes)
                if ends[-1] != len(ids):
                    raise ValueError("a segment's documents don't add up to its ids")
                starts = ends - sizes
                view, n = memoryview(ids), len(sizes)
                checks = [zlib.crc32(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * n, pa.int32()), pa.array([batch.column(1)[i].as_py()] * n, pa.int32()), batch.column(2)[i].values, pa.array(starts), pa.array(sizes), pa.array(checks, pa.int64())],
                    names=["shard", "number", "key", "at", "n_tokens", "ids_crc32"],
                )

    kind = files.schema["keys"].dataType.elementType.simpleString()
    each = files.select("shard", "number", "keys", "sizes", "data").mapInArrow(trimmed(run), f"shard int, number int, key {kind}, at long, n_tokens long, ids_crc32 long")
    return each.join(starts, ["shard", "number"]).select(F.col("key").alias(key), (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write docs to a fresh table in the shared folder and describe its documents as read back."""
    path = shared_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, key, text)
    return read(docs.sparkSession, path, key)
