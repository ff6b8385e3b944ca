"""Prefix trie of conversations: nodes of shared beginnings from sorted sequences and their LCP array.

A conversation is the sequence of its turns; a turn's symbol is the first 16 bytes of the SHA-256 of its
role's length, role and text. Equal sequences are one class with a number of members.

* Classes are sorted by ranges; a block is what one task of the sort wrote. LCP[i] is the number of symbols that sequence i
  shares with the one before it (-1 for the first).
* A node of depth d > LCP[i] is opened by sequence i and ends before the next j with LCP[j] < d: the Cartesian
  tree over the LCP array, where positions of equal LCP belong to one node (n_children counts them). Missing depths between
  a node and its parent are nodes of the same members.
* Inside a block one stack finds the nearest smaller values and sums up the intervals. In sorted order the least LCP of a block is
  that of its first and last sequence, so block minima come from an aggregation; a node that crosses blocks was opened
  in the nearest block to the left whose minimum is below its depth. Blocks are read in parallel; pieces of
  such nodes are added up by (block that opened it, depth). All sums are linear in the pieces.

The driver holds two sequences and a few numbers a block, as many blocks as shuffle partitions. A conversation's symbols
(16 bytes a turn) are one value; its texts aren't gathered. Member ids of a class are hashed as a sorted stream, so a class of
any size takes one task, but no memory.

Cases: rows without conv_id belong to no conversation. Equal turns are ordered by role and text, repeated
rows are turns of their own. Null roles and texts are empty. Other columns are left out. Without conversations there are no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, slices, trimmed

#: Bytes of a turn's symbol.
SYMBOL = 16
NONE = hashlib.sha256(b"").hexdigest()
NODE = "k long, depth int, opened long, parent_k long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
_NAMES = [c.split()[0] for c in NODE.split(", ")]


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (symbol in hex, code points of the text) in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    symbol = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * SYMBOL)
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", F.xxhash64(role, text).alias("t"), symbol.alias("s"), F.char_length(text).alias("n")).alias("x"))
    own = F.transform(F.sort_array(F.collect_list("x")), lambda x: F.struct(x["s"].alias("s"), x["n"].alias("n")))
    return rows.groupBy("conv_id").agg(own.alias("turns"))


def rebuilt(seqs: DataFrame, base: Column, head: Column) -> DataFrame:
    """Every conversation with its first head turns replaced by as many first ones (all if fewer, none if absent) of conversation base."""
    own = seqs.select("conv_id", "turns", base.alias("base"), head.alias("head"))
    need = own.groupBy("base").agg(F.max("head").alias("most"))
    heads = seqs.join(need, F.col("conv_id") == F.col("base"), "inner").select(F.col("base").alias("of"), F.slice("turns", F.lit(1), F.col("most")).alias("first"))
    rest = F.when(F.size("turns") > F.col("head"), F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns") - F.col("head"), F.lit(0)))).otherwise(F.slice("turns", 1, 0))
    lead = F.coalesce(F.slice("first", F.lit(1), F.col("head")), F.slice("turns", 1, 0))
    return own.join(heads, F.col("base") == F.col("of"), "left").select("conv_id", F.concat(lead, rest).alias("turns"))


def classes(seqs: DataFrame) -> DataFrame:
    """Distinct sequences: key (symbols), sizes, number of members, the smallest, and the hash of all members' ids."""
    rows = seqs.select("conv_id", F.unhex(F.array_join("turns.s", "")).alias("key"), F.col("turns.n").alias("sizes"))
    rows = durable(rows, "sequences")
    first = rows.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("sizes").alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hashed = None, None
        done: list[tuple] = []
        for batch in batches:
            for key, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key == last:
                    hashed.update(b",%d" % conv)
                    continue
                if hashed:
                    done.append((last, hashed.hexdigest()))
                last, hashed = key, hashlib.sha256(b"%d" % conv)
            yield pa.RecordBatch.from_pydict({"print": [k for k, _ in done], "ends": [e for _, e in done]}, schema=ended)
            done = []
        if hashed:
            yield pa.RecordBatch.from_pydict({"print": [last], "ends": [hashed.hexdigest()]}, schema=ended)

    ended = pa.schema([("print", pa.string()), ("ends", pa.string())])
    prints = rows.select(F.sha2("key", 256).alias("print"), "conv_id").repartition("print").sortWithinPartitions("print", "conv_id")
    ends = prints.mapInArrow(trimmed(run), "print string, ends string")
    return first.join(ends, F.sha2("key", 256) == F.col("print")).drop("print")


def common(a: bytes, b: bytes) -> int:
    """Number of symbols that two sequences share at their beginning."""
    low, high = 0, min(len(a), len(b)) // SYMBOL
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * SYMBOL] == b[: mid * SYMBOL] else (low, mid - 1)
    return low


class Blocks:
    """Per block: its first position, LCP at its start and after its end, least LCP; and where open nodes come from."""

    def __init__(self, found: list[tuple[int, int, bytes, bytes]]):
        self.first, self.enter, self.least, self.at = [], [], [], {}
        total, last = 0, None
        for i, (block, n, low, high) in enumerate(found):
            self.at[block] = i
            self.first.append(total)
            self.enter.append(-1 if last is None else common(last, low))
            self.least.append(min(self.enter[-1], common(low, high)) if n > 1 else self.enter[-1])
            total, last = total + n, high
        self.leave = [*self.enter[1:], -1]

    def opener(self, b: int) -> list[int]:
        """For depth 0 to LCP at the block's start: the nearest block to the left whose minimum is below."""
        out: list[int] = []
        left = b - 1
        for depth in range(self.enter[b], -1, -1):
            while self.least[left] >= depth:
                left -= 1
            out.append(left)
        return out[::-1]


class Open:
    """A node on the stack; position of its opening sequence, None where an earlier block opened it."""

    __slots__ = ("position", "k", "chars", "conv", "n", "children", "leaves", "saved", "ends", "parent")

    def __init__(self, position: int | None, k: int, chars: int, parent: int | None):
        self.position, self.k, self.chars, self.parent = position, k, chars, parent
        self.conv, self.n, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, None


def _block(b: int, blocks: Blocks, rows: Iterator[tuple]) -> Iterator[tuple]:
    """The nodes of a block's rows (key, conv_id, n, sizes, ends), and the pieces of those that cross its bounds (k < 0)."""
    stack: list[Open] = []

    def close(depth: int, crossing: bool) -> tuple:
        node = stack.pop()
        own = node.position is not None
        leaf = own and not crossing and not node.children
        leaves = node.leaves + leaf
        saved = node.saved + node.n * node.chars - (node.chars if own else 0)
        if stack:
            up = stack[-1]
            up.n, up.leaves, up.saved = up.n + node.n, up.leaves + leaves, up.saved + saved
            up.conv = node.conv if up.conv is None else min(up.conv, node.conv)
        k = -(b + 1) if own and crossing else node.k
        return k, depth, node.position, node.parent, node.conv, node.n, node.children, leaves, saved, node.ends

    last = b""
    for i, (key, conv, n, sizes, ends) in enumerate(rows):
        if i == 0:
            shared = blocks.enter[b]
            for depth, opener in enumerate(blocks.opener(b)):
                stack.append(Open(None, -(opener + 1), sizes[depth - 1] if depth else 0, None))
        else:
            shared = common(last, key)
        while len(stack) - 1 > shared:
            yield close(len(stack) - 1, False)
        position = blocks.first[b] + i
        for depth in range(shared + 1, len(key) // SYMBOL + 1):
            up = stack[-1] if stack else None
            if up:
                up.children += 1
            stack.append(Open(position, position, sizes[depth - 1] if depth else 0, up.k if up else None))
        top = stack[-1]
        top.n, top.ends, last = top.n + n, ends, key
        top.conv = conv if top.conv is None else min(top.conv, conv)
    while len(stack) - 1 > blocks.leave[b]:
        yield close(len(stack) - 1, False)
    while stack:
        yield close(len(stack) - 1, True)


def trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie over sequences (conv_id, turns)."""
    place = F.monotonically_increasing_id()
    own = durable(classes(seqs).orderBy("key").withColumn("place", place).withColumn("block", F.spark_partition_id()), "classes")
    found = own.groupBy("block").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).orderBy("block").collect()
    blocks = Blocks([(r.block, r.n, bytes(r.low), bytes(r.high)) for r in found])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in slices(batches):
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, out = rows(batches), []
        ahead = next(source, None)

        def of(block: int) -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == block:
                yield ahead[1:]
                ahead = next(source, None)

        while ahead is not None:
            block = ahead[0]
            for node in _block(blocks.at[block], blocks, of(block)):
                out.append(node)
                if len(out) == 4096:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    sorted_rows = own.repartition(max(1, len(found)), "block").sortWithinPartitions("block", "place").select("block", "key", "conv_id", "n", "sizes", "ends")
    pieces = durable(sorted_rows.mapInArrow(trimmed(run), NODE), "nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    crossing = pieces.where("k < 0").groupBy("k", "depth").agg(F.max("opened").alias("opened"), F.max("parent_k").alias("parent_k"), F.min("conv_id").alias("conv_id"), *sums, F.max("ends").alias("ends"))
    crossing = durable(crossing, "crossing")
    whole = pieces.where("k >= 0").unionByName(crossing)
    ids = whole.select(F.col("opened").alias("up"), F.col("depth").alias("up_depth"), F.col("conv_id").alias("parent_conv_id"))
    ids = ids.unionByName(crossing.select(F.col("k").alias("up"), F.col("depth").alias("up_depth"), F.col("conv_id").alias("parent_conv_id")))
    out = whole.join(ids, (F.col("parent_k") == F.col("up")) & (F.col("depth") - 1 == F.col("up_depth")), "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"))


def _batch(nodes: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 7, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes, strict=True), kinds, strict=True)], names=_NAMES)
