"""Benchmark decontamination: n-gram seeds join passages to test items, and Smith-Waterman
alignment scores the pairs, so that paraphrased or edited copies are found as well.

Words are lower-cased and lose ASCII punctuation. Every three-word sequence of an item is a seed,
rare or common: which of them an edited copy keeps can't be told from counts. One pass finds the
seeds in each document, cuts out the stretch around them and aligns it with the item (match +2,
other word -1, gap -1). The score is relative to the item's own: 1 for an exact copy. The stretch
reaches as far as an alignment through the seed that scores LIMIT can (it has no more gaps than the
item has words). A stretch that shares too few words with the item to reach LIMIT, each counted as
often as it stands in both, is not aligned (a match scores 2 at most, so nothing is lost by that);
this keeps common seeds cheap.

The limit of the method: a copy that keeps no three words of the item in a row has no seed.

The items are the query set, taken in blocks of at most BLOCK words, and all documents pass by
each block; a block's vocabulary and seeds are broadcast and bounded by BLOCK. Nothing is shuffled.

Cases: null and empty texts match nothing, nor do items with fewer than three words. Repeated items
are reported each, repeated rows too. Very long texts are taken whole. An empty benchmark flags
nothing. Input columns may have any names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import slices, trimmed

N, LIMIT, BLOCK = 3, 0.5, 200_000
MATCH, OTHER, GAP = 2, -1, -1
PUNCTUATION = b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(None, PUNCTUATION).split()


class Items:
    """A block of test items by word numbers (0: a word of no item), with the sequences they contain."""

    def __init__(self, rows: list[tuple]):
        self.number: dict[bytes, int] = {}
        self.keys = [k for k, _ in rows]
        self.ids = [np.array([self.number.setdefault(w, len(self.number) + 1) for w in words(t)], np.int64) for _, t in rows]
        self.bags = [np.unique(x, return_counts=True) for x in self.ids]
        places = defaultdict(list)
        for item, ids in enumerate(self.ids):
            for offset, g in enumerate(self.sequences(ids).tolist()):
                places[g].append((item, offset))
        self.grams = np.array(sorted(places), np.int64)
        self.places = [places[g] for g in self.grams.tolist()]

    def read(self, text: str | None) -> np.ndarray:
        get = self.number.get
        return np.array([get(w, 0) for w in words(text)], np.int64)

    def sequences(self, ids: np.ndarray) -> np.ndarray:
        """One number for each sequence of N known words, -1 for the others. With more than 2 million words
        in a block sequences may share a number: a seed then leads to an alignment in vain, and none is lost."""
        if len(ids) < N:
            return np.zeros(0, np.int64)
        base, out, known = len(self.number) + 1, ids[: len(ids) - N + 1].copy(), ids[: len(ids) - N + 1] > 0
        if base**N >= 1 << 63:
            base = 0x9E3779B97F4A7C15 - (1 << 64)  # products wrap around
        for i in range(1, N):
            part = ids[i : len(ids) - N + 1 + i]
            out, known = out * base + part, known & (part > 0)
        return np.where(known, out & (1 << 63) - 1, -1)

    def found(self, ids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ids the sequences of `among` (sorted) stand, and which they are."""
        own = self.sequences(ids)
        at = np.nonzero(own >= 0)[0]
        if not len(at) or not len(among):
            return at[:0], at[:0]
        slot = np.minimum(np.searchsorted(among, own[at]), len(among) - 1)
        hit = among[slot] == own[at]
        return at[hit], slot[hit]

    def matches(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item, score, first word, end) of the items that the text contains, with their best place."""
        ids = self.read(text)
        stretches: dict[int, list[list[int]]] = defaultdict(list)
        for at, slot in zip(*(x.tolist() for x in self.found(ids, self.grams)), strict=True):
            for item, offset in self.places[slot]:
                size = len(self.ids[item])
                low, high = max(0, at - offset - size), min(len(ids), at - offset + 2 * size)
                own = stretches[item]
                if own and low <= own[-1][1]:
                    own[-1] = [min(low, own[-1][0]), max(high, own[-1][1])]
                else:
                    own.append([low, high])
        out = []
        for item, own in stretches.items():
            best = max((self.score(item, ids, low, high) for low, high in own), default=(0.0, 0, 0))
            if best[0] >= LIMIT:
                out.append((item, *best))
        return out

    def score(self, item: int, ids: np.ndarray, low: int, high: int) -> tuple[float, int, int]:
        own, part = self.ids[item], ids[low:high]
        kinds, times = self.bags[item]
        slot = np.minimum(np.searchsorted(kinds, part), len(kinds) - 1)
        shared = np.bincount(slot[kinds[slot] == part], minlength=len(kinds))
        if np.minimum(shared, times).sum() < LIMIT * len(own):
            return 0.0, low, low
        score, end = align(own, part)
        if score < LIMIT * MATCH * len(own):
            return 0.0, low, low
        back = align(own[::-1], part[:end][::-1])[1]  # how far the passage reaches back from its end
        return score / (MATCH * len(own)), low + end - back, low + end


def align(item: np.ndarray, part: np.ndarray) -> tuple[int, int]:
    """Best local (Smith-Waterman) score, and where in part it ends."""
    steps = GAP * np.arange(len(part) + 1)
    row, best, end = np.zeros(len(part) + 1, np.int64), 0, 0
    for word in item:
        new = np.zeros_like(row)
        np.maximum(np.where(part == word, MATCH, OTHER) + row[:-1], row[1:] + GAP, out=new[1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new - steps) + steps  # gaps along the row
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """The items, BLOCK words at a time."""
    block, size = [], 0
    for k, t in benchmark.select(key, text).where(F.col(text).isNotNull()).toLocalIterator():
        block.append((k, t))
        size += len(words(t))
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item it contains: both keys, score (0.5 to 1), first_word, end_word."""
    only = docs.select(F.col(key), F.col(text).alias("__text"))
    kinds = f"`{key}` {only.schema[0].dataType.simpleString()}, `{item}` {benchmark.schema[item].dataType.simpleString()}, score double, first_word int, end_word int"
    out = docs.sparkSession.createDataFrame([], kinds)
    item_type = to_arrow_type(benchmark.schema[item].dataType)
    for rows in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Items(rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in slices(batches):
                found = [(i, *m) for i, t in enumerate(batch.column(1).to_pylist()) for m in own.matches(t)]
                if found:
                    at, which, score, low, end = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array([own.keys[i] for i in which], item_type), pa.array(score), pa.array(low, pa.int32()), pa.array(end, pa.int32())],
                        names=[key, item, "score", "first_word", "end_word"],
                    )

        out = out.unionByName(only.mapInArrow(trimmed(run), kinds))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs that contain no item, with all their columns."""
    for rows in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(Items(rows))
        where = docs.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, where=where) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield batch.filter(pa.array([not shared.value.matches(t) for t in batch.column(where).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(trimmed(run), docs.schema)
    return docs
