"""N-gram Jaccard join: documents whose sets of word shingles overlap, and their components.

A text's set is its distinct shingles of `width` words (the whole sequence if it has fewer), as
64-bit hashes. Texts with the same set are one node. Two nodes link when
100 * intersection >= percent * union, which is decided on the exact sorted arrays.

Candidates. All shingles have a common order: rarer ones first, by counts of all documents in 2**20
hash buckets, then by hash. Nodes that link share one of their first n - ceil(percent * n / 100) + 1
shingles, so each node enters a tile for each of these: the tile of the shingle and of the node's band of
sizes, of which the largest is at most 100 / percent times the smallest. All bands of a shingle are in one
task, which drops a node that is alone in its tile only if the tiles of the bands beside it are empty too.

Signatures. Each set has a bitmap in which every shingle flips one bit, of 64 bits up, growing with
the set's size class (a larger one folds onto a smaller one). The bits that differ bound the
symmetric difference from below and thus the overlap from above. Pairs that can't reach the
threshold by this bound, or by the places of the tile's shingle in both orders, are dropped in the
tile; the arrays of the others alone are fetched and intersected.

Large groups. The pairs of a tile are not all made. First each node is tried with one pivot: a tile's
pivot is the node with the fewest rarer shingles, the one nearest to what all have in common, and a
node takes the pivot of most of its tiles. A hot shingle, one in HOT documents or more beyond what its
bucket holds on average, has its tiles salted by node; the salts' pivots are tried with each other.
Later rounds join each band with itself and the next larger one, and look only at cells (shingle, pair
of bands) with nodes of two components: bitmaps are not sent to any other. A cell of more than HOLD
nodes is cut into parts by node, and each two parts are a task's work of their own, so no task holds more
than 2 * HOLD nodes of a cell. There a node is tried with one member of each other component, and
in the last round with every member. Links inside a component that is already found are not needed,
so a group of m mutual copies costs about m comparisons, while no link between components is lost.

Cases: null and empty texts have an empty set, are linked with nothing and form a component each.
Repeated rows share a node. Null keys don't name a component unless all its keys are null. Two sets
with the same 64-bit node number (told apart by a second hash) are found and lead to another seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, slices, trimmed
from .components import components

WIDTH, PERCENT = 4, 85
BUCKETS, SLICES = 1 << 20, 64
#: Rows of a few numbers that are broadcast at most (about 10 MB).
BROADCAST_ROWS = 1 << 18
PART = 1 << 18  # rows of a group that are held at once where pieces will do, and pairs that a task remembers
HOT, HOLD = 1 << 17, 1 << 13
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: bytes | None, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text's bytes; ASCII letters are lower-cased."""
    words = data.lower().split() if data else []  # for bytes: ASCII letters and white space alone
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    out = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for i in range(min(width, len(words))):
        out = (out ^ own[i : i + n]) * _MIX
        out ^= out >> np.uint64(31)
    return np.unique(out)


def signature(own: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set, as 64-bit words: a power of two of them, about one for 64 shingles."""
    size = 1 << int(len(own) // 64).bit_length()
    bits = np.bincount((own % np.uint64(64 * size)).astype(np.int64), minlength=64 * size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """Bits that differ, after the larger bitmap is folded onto the smaller one."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):
        a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def needed(na: int, nb: int, percent: int) -> int:
    """The smallest overlap with which sets of these sizes link."""
    return -(-percent * (na + nb) // (100 + percent))


def reachable(place: int, n: int, places: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets can link that share a shingle at these places of their orders: before it they share
    no more than the smaller place, from it on no more than the smaller rest."""
    shared = np.minimum(place, places) + np.minimum(n - place, sizes - places)
    return shared >= -(-percent * (sizes.astype(np.int64) + n) // (100 + percent))


def bands(percent: int) -> np.ndarray:
    """The sizes at which bands begin: a set links with those of its band and of the ones beside it at most,
    and may link with every size of its own. Empty for 100 %, where each size is a band."""
    out = [1]
    while percent < 100 and out[-1] < 1 << 31:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out if percent < 100 else [], np.int64)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    return len(np.intersect1d(a, b, assume_unique=True)) >= needed(len(a), len(b), percent)


def _number(own: np.ndarray, seed: int) -> tuple[int, int]:
    data = own.tobytes()
    return xxhash.xxh3_64_intdigest(data, seed) - (1 << 63), xxhash.xxh64_intdigest(data, seed) - (1 << 63)


def _sets(docs: DataFrame, kind: str, width: int, seed: int) -> DataFrame:
    """For each row key, print, node, check, n and bits; and for each task the counts of its shingles by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, schema = np.zeros(BUCKETS, np.uint32), None
        for batch in slices(batches):
            sets = [shingles(x, width) for x in batch.column(2).cast(pa.binary()).to_pylist()]
            if sets:
                counts += np.bincount((np.concatenate(sets) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS).astype(np.uint32)
                node, check = zip(*(_number(x, seed) if len(x) else (None, None) for x in sets), strict=True)
                out = [batch.column(0), batch.column(1), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array([len(x) for x in sets], pa.int32()), pa.array([signature(x).tobytes() for x in sets], pa.binary()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
                ready = pa.RecordBatch.from_arrays(out, names=["key", "print", "node", "check", "n", "bits", "slice", "counts"])
                schema = ready.schema
                yield ready
        if schema is not None:
            parts = counts.reshape(SLICES, -1)
            none = [pa.nulls(SLICES, f.type) for f in list(schema)[:6]]
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], schema=schema)

    return durable(docs.mapInArrow(trimmed(run), f"key {kind}, print long, node long, check long, n int, bits binary, slice int, counts binary"), "sets")


def _ranks(sets: DataFrame) -> np.ndarray:
    """For each bucket how common it is, on a logarithmic scale of 256 steps (1 MB in all)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[s] = total.get(s, 0) + np.frombuffer(x, np.uint32).astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([np.minimum(255, 8 * np.log2(1.0 + x)).astype(np.uint8).tobytes() for x in total.values()], pa.binary())], names=["slice", "rank"])

    found = {r["slice"]: r["rank"] for r in sets.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(trimmed(add), "slice int, rank binary").collect()}
    return np.frombuffer(b"".join(found.get(i, bytes(BUCKETS // SLICES)) for i in range(SLICES)), np.uint8)


def _entries(docs: DataFrame, ranks: np.ndarray, width: int, percent: int, seed: int, hot: int) -> DataFrame:
    """For each node and each shingle of its prefix: home (of all bands of the token and salt), token, band, salts of the
    token, n, node, place of the shingle in the order."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    counts = np.exp2(np.arange(256) / 8.0)
    usual = 4 * float(counts[ranks].mean())
    salts = np.maximum(1, (counts - usual) / hot).astype(np.int64)  # by rank
    limits = bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            token, n, node, ways = [], [], [], []
            for data in batch.column(0).cast(pa.binary()).to_pylist():
                own = shingles(data, width)
                if not len(own) or (number := _number(own, seed)[0]) in seen:
                    continue
                seen.add(number)
                first = len(own) - -(-percent * len(own) // 100) + 1
                rank = shared.value[(own & np.uint64(BUCKETS - 1)).astype(np.int64)]
                chosen = np.lexsort((own, rank))[:first]
                token.append(own[chosen])
                ways.append(salts[rank[chosen]])
                n.append(len(own))
                node.append(number)
            if node:
                times = np.array([len(x) for x in token])
                place = np.concatenate([np.arange(x, dtype=np.int32) for x in times])
                each, nodes, sizes = np.concatenate(token), np.repeat(np.array(node, np.int64), times), np.repeat(np.array(n, np.int32), times)
                band, way = (np.searchsorted(limits, sizes, "right") if len(limits) else sizes).astype(np.int32), np.concatenate(ways)
                salt = (nodes.view(np.uint64) >> np.uint64(20)) % way.astype(np.uint64)
                home = (each ^ (salt + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)) * _MIX
                columns = [(home ^ (home >> np.uint64(29))).view(np.int64), each.view(np.int64), band, way.astype(np.int32), sizes, nodes, place]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["home", "token", "band", "salts", "n", "node", "place"])

    return docs.select("text").mapInArrow(trimmed(run), "home long, token long, band int, salts int, n int, node long, place int")


def _held(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    """The columns of sorted batches in pieces that end with a group (first column), and whether they
    do: a group of more than `part` rows comes in several pieces."""
    rest: list[np.ndarray] = []
    for batch in batches:
        own = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        own = [np.concatenate(x) for x in zip(rest, own, strict=True)] if rest else own
        change = np.nonzero(own[0][1:] != own[0][:-1])[0]
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield [x[:cut] for x in own], True
        rest = [x[cut:] for x in own]
        if len(rest[0]) > part:
            yield rest, False
            rest = []
    if rest and len(rest[0]):
        yield rest, True


def _tiles(entries: DataFrame, percent: int) -> DataFrame:
    """The entries of tiles with two nodes or more, with nodes in the next band or with salts, each with the
    tile's pivot, or itself where it can't link with that: the pivot is the node in whose order the tile's
    shingle comes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = None  # home, band, pivot, its place and size, of a home that came in part
        for columns, whole in _held(batches, PART):
            home, node = columns[0], columns[5]
            keep = np.append(True, (home[1:] != home[:-1]) | (node[1:] != node[:-1]))
            home, token, band, salts, n, node, place = (x[keep] for x in columns)
            starts = np.nonzero(np.append(True, (home[1:] != home[:-1]) | (band[1:] != band[:-1])))[0]
            sizes = np.append(starts[1:], len(home)) - starts
            several = (sizes > 1) | (salts[starts] > 1)
            beside = (home[starts[1:]] == home[starts[:-1]]) & (band[starts[1:]] == band[starts[:-1]] + 1)
            several[1:] |= beside
            several[:-1] |= beside
            heads = [node[starts], place[starts], n[starts]]
            if begun is not None and begun[0] == home[0]:
                several |= home[starts] == home[0]
                if begun[1] == band[0]:
                    for head, old in zip(heads, begun[2:], strict=True):
                        head[0] = old
            if not whole:  # a piece of one home: its bands may go on
                several[:] = True
            begun = None if whole else (home[-1], band[-1], *(x[-1] for x in heads))
            pivot, spot, pn = (np.repeat(x, sizes) for x in heads)
            pivot = np.where(reachable(spot, pn, place, n, percent), pivot, node)
            out = np.repeat(several, sizes)
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (token, band, salts, n, node, place, pivot)], names=["token", "band", "salts", "n", "node", "place", "pivot"])

    held = entries.repartition("home").sortWithinPartitions("home", "band", "place", "node")
    return durable(held.mapInArrow(trimmed(run), "token long, band int, salts int, n int, node long, place int, pivot long"), "tiles", 10_000)


def _tries(tiles: DataFrame) -> DataFrame:
    """Pairs (x, y) of the first round: each node and the pivot of most of its tiles, and for hot shingles
    the pivots of all salts and the smallest of them."""
    most = tiles.where("node != pivot").groupBy("node", "pivot").count().groupBy("node").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("pivot"))
    salted = tiles.where("salts > 1").select("token", "band", "pivot").distinct()
    least = salted.groupBy("token", "band").agg(F.min("pivot").alias("least"))
    heads = salted.join(least, ["token", "band"]).where("pivot != least").select(F.col("pivot").alias("x"), F.col("least").alias("y"))
    return most.select(F.col("node").alias("x"), F.col("pivot").alias("y")).unionByName(heads).distinct()


def _arrays(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, width: int, seed: int) -> DataFrame:
    """node and its array, for the nodes of the pairs. Only their texts are read: the nodes' first rows are
    broadcast if there are few of them, and joined by a shuffle otherwise."""
    wanted = durable(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct().join(nodes, "node").select("node", F.col("first.key").alias("own_key"), F.col("first.print").alias("own_print")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            rows = []
            for node, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                own = shingles(data, width)
                if node not in seen and len(own) and _number(own, seed)[0] == node:
                    seen.add(node)
                    rows.append((node, own.tobytes()))
            if rows:
                node, arrays = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(arrays, pa.binary())], names=["node", "shingles"])

    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    found = docs.join(few, docs["key"].eqNullSafe(few["own_key"]) & (docs["print"] == few["own_print"])).select("node", "text")
    return durable(found.mapInArrow(trimmed(run), "node long, shingles binary"), "arrays")


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that the bitmaps of both don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            xn, xb, yn, yb = (batch.column(i).to_pylist() for i in range(2, 6))
            keep = [n + m - differing(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= 2 * needed(n, m, percent) for n, a, m, b in zip(xn, xb, yn, yb, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    x = nodes.select(F.col("node").alias("x"), F.col("n").alias("xn"), F.col("bits").alias("xb"))
    y = nodes.select(F.col("node").alias("y"), F.col("n").alias("yn"), F.col("bits").alias("yb"))
    return durable(pairs.join(y, "y").join(x, "x").select("x", "y", "xn", "xb", "yn", "yb").mapInArrow(trimmed(run), "x long, y long"), "possible")


def _verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, width: int, percent: int, seed: int) -> DataFrame:
    """The pairs (x, y) that link, by their sorted arrays."""
    arrays = _arrays(docs, pairs, nodes, width, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = [links(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    x = arrays.select(F.col("node").alias("x"), F.col("shingles").alias("xs"))
    y = arrays.select(F.col("node").alias("y"), F.col("shingles").alias("ys"))
    return durable(pairs.join(y, "y").join(x, "x").select("x", "y", "xs", "ys").mapInArrow(trimmed(run), "x long, y long"), "links")


def _folded(n: np.ndarray, bits: list[bytes], size: int) -> np.ndarray:
    """The bitmaps of sets in order of size, of `size` words or more each, folded to so many words."""
    out, i = np.zeros((len(bits), size), np.uint64), 0
    while i < len(bits):
        e = i + 1
        while e < len(bits) and len(bits[e]) == len(bits[i]):
            e += 1
        block = np.frombuffer(b"".join(bits[i:e]), np.uint64).reshape(e - i, -1, size)
        out[i:e], i = np.bitwise_xor.reduce(block, axis=1), e
    return out


def _cross(tiles: DataFrame, nodes: DataFrame, found: DataFrame, percent: int, every: bool, hold: int) -> DataFrame:
    """Pairs (x, y) of nodes of two components in a cell that neither their places nor their bitmaps rule
    out; of each other component one member for a node, or every one."""
    whose = nodes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("group"))
    both = F.explode(F.array(F.struct(F.col("band").alias("cell"), F.lit(0).alias("guest")), F.struct((F.col("band") - 1).alias("cell"), F.lit(1).alias("guest")))).alias("in")
    cells = tiles.join(whose, "node").select("token", "n", "node", "place", "group", both).select("token", "n", "node", "place", "group", "in.cell", "in.guest")
    counted = cells.groupBy("token", "cell").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.min("guest").alias("guest"), F.count("*").alias("size"))
    mixed = durable(counted.where("low != high and guest = 0").select("token", "cell", F.ceil(F.col("size") / hold).cast("int").alias("parts")), "mixed")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = cells.join(mixed, ["token", "cell"]).withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = F.xxhash64("token", "cell", F.least("part", "other"), F.greatest("part", "other")).alias("tile")
    own = dealt.join(nodes.select("node", "bits"), "node").select(tile, "n", "node", "place", "group", "guest", F.when(F.col("parts") > 1, F.col("part")).otherwise(-1).alias("part"), (F.col("part") == F.col("other")).alias("inner"), "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for (tile, n, node, place, group, guest, part, inner, bits), _ in _held(batches, 1 << 62):
            starts = np.nonzero(np.append(True, tile[1:] != tile[:-1]))[0]
            ends = np.append(starts[1:], len(tile))
            xs, ys = [], []
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                maps, first = None, 0
                for i in range(s, e - 1):
                    if guest[i]:
                        continue
                    upto = i + 1 + int(np.searchsorted(n[i + 1 : e], 100 * int(n[i]) // percent, "right"))
                    rest = slice(i + 1, upto)
                    may = (group[rest] != group[i]) & reachable(int(place[i]), int(n[i]), place[rest], n[rest], percent)
                    if not inner[i]:  # two parts: what is in the same one is compared elsewhere
                        may &= part[rest] != part[i]
                    own = i + 1 + np.nonzero(may)[0]
                    if not len(own):
                        continue
                    if maps is None or maps.shape[1] * 8 != len(bits[i]):
                        maps, first = _folded(n[i:e], bits[i:e].tolist(), len(bits[i]) // 8), i
                    apart = np.bitwise_count(maps[own - first] ^ maps[i - first]).sum(1, dtype=np.int64)
                    own = own[n[own].astype(np.int64) + n[i] - apart >= -(-percent * (n[own].astype(np.int64) + n[i]) // (100 + percent)) * 2]
                    if not every and len(own) > 1:
                        own = own[np.unique(group[own], return_index=True)[1]]
                    for y in node[own].tolist():
                        if (int(node[i]), y) not in done:
                            done.add((int(node[i]), y))
                            xs.append(int(node[i]))
                            ys.append(y)
                    if len(xs) > PART:
                        yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])
                        xs, ys = [], []
                if len(done) > PART:
                    done.clear()
            if xs:
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])

    return own.repartition("tile").sortWithinPartitions("tile", "n", "guest", "node").mapInArrow(trimmed(run), "x long, y long").distinct()


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, hot: int = HOT, hold: int = HOLD) -> DataFrame:
    """For each row of docs: key, print (xxhash64 of its text), n_shingles, component_id (smallest key
    of its component) and is_first (whether the row's key and print are the component's smallest)."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("print"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    seed = 0
    while True:
        sets = _sets(rows, kind, width, seed)
        place = F.struct(F.col("key").isNull().alias("none"), "key", "print")
        if sets.where("node is not null").groupBy("node").agg(F.min("check").alias("a"), F.max("check").alias("b")).where("a != b").isEmpty():
            break
        seed += 1
    tiles = _tiles(_entries(rows, _ranks(sets), width, percent, seed, hot), percent)
    nodes = durable(sets.where("node is not null").groupBy("node", "n", "bits").agg(F.min(place).alias("first")), "nodes")
    tried = _possible(_tries(tiles), nodes, percent)
    linked = _verified(rows, tried, nodes, width, percent, seed)
    found = components(linked)
    for every in (False, True):
        pairs = _cross(tiles, nodes, found, percent, every, hold)
        known = tried.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        fresh = durable(pairs.join(known, (F.least("x", "y") == F.col("a")) & (F.greatest("x", "y") == F.col("b")), "left_anti"), "fresh", 10_000)
        if not fresh.isEmpty():
            more = _verified(rows, fresh, nodes, width, percent, seed)
            tried, linked = tried.unionByName(fresh), linked.unionByName(more)
            found = components(linked) if not more.isEmpty() else found
    found = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    named = durable(found.join(nodes, "node").groupBy("component").agg(F.min("first").alias("named")), "named")
    whose = durable(nodes.join(found.join(named, "component").select("node", "named"), "node", "left").select("node", F.coalesce("named", "first").alias("first")), "whose")
    rest = sets.where("slice is null").select("key", "print", "node", "n")
    out = rest.where("node is not null").join(whose, "node").unionByName(rest.where("node is null").withColumn("first", place))
    return out.select(F.col("key").alias(key), "print", F.col("n").cast("long").alias("n_shingles"), F.col("first.key").alias("component_id"), (F.col("first") == place).alias("is_first"))


ORACLE = r"""
with recursive texts as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as materialized (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s from texts),
shingles as materialized (select doc_id, unnest(s) as x from sets),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
links as materialized (select a, b from shared join (select doc_id as a, len(s) as na from sets) using (a) join (select doc_id as b, len(s) as nb from sets) using (b) where 100 * n >= 85 * (na + nb - n)),
pairs as materialized (select a, b from links union all select b, a from links),
reach(doc_id, other) as (select doc_id, doc_id from sets union select r.doc_id, e.b from reach r join pairs e on r.other = e.a)
select doc_id, len(s)::bigint as n_shingles, (select min(other) from reach r where r.doc_id = sets.doc_id) as component_id from sets
"""
