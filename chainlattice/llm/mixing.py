"""Mixing of sources to target weights by a multivariate-hypergeometric splitting tree.

Sources stand in order of code points, null last, and weigh 1, 2, 3, repeating. They share 100 % of
all words; a target stops at CAP times its source's size, and the excess is shared anew by weight.

The documents of a source are permuted by a hash and cut into blocks of about BLOCK words. A source's
quota is an exact number of blocks: `full` whole passes over its blocks, and of one more pass those up
to the block in which its target is reached. The quotas are split among the output shards (SHARD words
each) by a binary tree: at each node the left half of the shards draws its share from all quotas
together, without replacement (multivariate hypergeometric), and the right half keeps the rest. So
a shard gets a run of each source's permuted blocks; runs are disjoint and add up to the quotas, which
is checked. A document is taken as often as its block was drawn. Of the last block only some documents
are taken: in PASSES passes those that still fit, in order, past the ones that don't; then, of two of
each doubling of size that are left, those with which the source's words come nearest its target. Inside
a shard, documents are shuffled locally.

What reaches the driver has one row for each source, and about 40 offers. The tree's upper nodes (SUBTREES
at most) are drawn on the driver; the rest is drawn by tasks, one for each subtree, as sparse rows of
source, first block, number and shard, which are joined to the documents by source and block, and only
broadcast where there are few. A hot source spreads over its blocks. Documents are never joined with
each other. There are never more than MOST blocks in all: beyond MOST * BLOCK words (2.2e12), blocks are larger.

Cases: null or empty texts have size 0, stand in some block and give no words. A source without any
words has target 0. Repeated rows are mixed each for itself (identical rows are interchangeable, and
share a block). Null keys are told apart by their texts. An empty table gives an empty mix. Reruns
agree: all draws follow from SEED and the rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, n_words, shuffle_partitions

WEIGHTS, CAP, SEED = (1, 2, 3), 3, 20
BLOCK, SHARD, MOST, SUBTREES, PASSES, RUN = 1 << 12, 1 << 16, 1 << 29, 1 << 8, 3, 1 << 10
#: Sources or blocks up to this number are broadcast (about 60 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 1 << 17


def targets(sizes: list[int], weights: list[float], cap: int = CAP) -> list[float]:
    """Each source's share of all words by weight, none above cap times its size."""
    total, free, out = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    left = float(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = {i for i in free if unit * weights[i] > cap * sizes[i]}
        if not over:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in sorted(over):
            out[i] = float(cap * sizes[i])
            left -= out[i]
        free -= over
    return out


def children(first: int, n: int, have: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """What the left and the right half of shards first to first + n - 1 get of the blocks they have."""
    draw = np.random.default_rng([seed, first, n]).multivariate_hypergeometric(have, int(have.sum()) * (n // 2) // n, method="marginals")
    return draw, have - draw


def descend(first: int, n: int, ahead: np.ndarray, have: np.ndarray, upto: int = 1) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The nodes of at most `upto` shards below a node: first shard, shards, blocks of each source before
    them, and blocks of each source that they get."""
    waiting = [(first, n, ahead, have)]
    while waiting:
        first, n, ahead, have = waiting.pop()
        if n <= upto:
            yield first, n, ahead, have
            continue
        left, right = children(first, n, have)
        waiting += [(first + n // 2, n - n // 2, ahead + left, right), (first, n // 2, ahead, left)]


def split(spark: SparkSession, quotas: np.ndarray, shards: int) -> DataFrame:
    """The tree's leaves as rows of sid, first (block of the source's quota), n and shard."""
    top = [(f, n, *(x.tolist() for x in (ahead, have))) for f, n, ahead, have in descend(0, shards, np.zeros_like(quotas), quotas, -(-shards // SUBTREES))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for f, n, ahead, have in frame.itertuples(index=False):
                for shard, _, at, own in descend(f, n, np.asarray(ahead, np.int64), np.asarray(have, np.int64)):
                    which = np.nonzero(own)[0]
                    yield pd.DataFrame({"sid": which.astype("int32"), "first": at[which], "n": own[which], "shard": np.int64(shard)})

    nodes = spark.createDataFrame(top, "first long, n long, ahead array<long>, have array<long>")
    leaves = durable(nodes.repartition(min(len(top), shuffle_partitions(spark))).mapInPandas(run, "sid int, first long, n long, shard long"), "leaves")
    dealt = {r.sid: r.n for r in leaves.groupBy("sid").agg(F.sum("n").alias("n")).collect()}
    if any(dealt.get(i, 0) != q for i, q in enumerate(quotas.tolist())):
        raise AssertionError("the shards' blocks don't add up to the quotas")
    return leaves


def fillers(gap: float, offers: list[tuple[int, int]]) -> list[int]:
    """The numbers of offers (size, number) that fill a gap: the largest that fit, in turn; at last the
    smallest one left, if its size is less than twice what is still open."""
    out = []
    for size, number in sorted(offers, key=lambda x: (-x[0], x[1])):
        if size <= gap:
            out.append(number)
            gap -= size
    left = [x for x in offers if x[1] not in out]
    if left and min(left)[0] < 2 * gap:
        out.append(min(left)[1])
    return out


def _reached(words: DataFrame, place: str) -> DataFrame:
    """For each source the last place before which there are fewer words than rest, and how many."""
    before = Window.partitionBy("sid").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    ahead = words.withColumn("ahead", F.col("base") + F.coalesce(F.sum("words").over(before), F.lit(0)))
    return ahead.where("ahead < rest").groupBy("sid").agg(F.max(place).alias("last"), F.max("ahead").alias("ahead"))


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", carry: tuple[str, ...] = (), shards: int | None = None, block: int = BLOCK) -> DataFrame:
    """Each row's key, size, source_size, target, taken, copies, shards (one for each copy) and the carried
    columns. The number of shards follows the number of words, unless it is given."""
    spark = docs.sparkSession
    sized = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), F.xxhash64(text).alias("print"), F.struct(F.lit(0).alias("_"), *carry).alias("carry"))
    sized = sized if carry else durable(sized, "sized")  # what is carried is worth reading again
    small = lambda df, n: F.broadcast(df) if n <= BROADCAST_ROWS else df  # noqa: E731  rows of a few numbers each
    found = [(r.source, int(r.n)) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    found.sort(key=lambda x: (x[0] is None, (x[0] or "").encode()))
    words = sum(n for _, n in found)
    shards, block = shards or -(-words // SHARD) or 1, max(block, -(-CAP * words // MOST))
    aims = targets([n for _, n in found], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))])
    info = [
        (i, name, n, aim, full := min(CAP, int(aim // n)) if n else 0, (aim - full * n) if full < CAP else 0.0, max(1, -(-n // block)))
        for i, ((name, n), aim) in enumerate(zip(found, aims, strict=True))
    ]
    sources = spark.createDataFrame(info, "sid int, name string, source_size long, target double, full int, rest double, blocks long")
    spread = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "key", "source", "print"), 1) / F.lit(float(1 << 63))
    rows = (
        sized.join(small(sources, len(info)), F.col("source").eqNullSafe(F.col("name")))
        .withColumn("order", spread)
        .withColumn("block", F.least(F.floor(F.col("order") * F.col("blocks")), F.col("blocks") - 1))
        .drop("name", "source")
    )
    # of each source's last pass: the block in which it ends and the words before that, first by runs of RUN blocks
    words_of = durable(rows.where("rest > 0").groupBy("sid", "rest", F.floor(F.col("block") / RUN).alias("run"), "block").agg(F.sum("size").alias("words")), "blocks")
    runs = _reached(words_of.groupBy("sid", "rest", "run").agg(F.sum("words").alias("words")).withColumn("base", F.lit(0)), "run").collect()
    chosen = spark.createDataFrame([(r.sid, r["last"], r.ahead) for r in runs], "sid int, run long, base long")
    ends = {r.sid: (r["last"], r.ahead) for r in _reached(words_of.join(small(chosen, len(runs)), ["sid", "run"]), "block").collect()}
    quotas = np.array([x[4] * x[6] + (ends[x[0]][0] + 1 if x[0] in ends else 0) for x in info], np.int64)
    limits = spark.createDataFrame([(x[0], *ends.get(x[0], (-1, 0))) for x in info], "sid int, last long, ahead long")
    rows = rows.join(small(limits, len(info)), "sid")

    # the last block of each source: in PASSES passes in order those that still fit, then offers among the others
    order = Window.partitionBy("sid").orderBy("order", "key", "print", "size")
    last = rows.where("block = last").withColumn("number", F.row_number().over(order)).withColumn("gap", F.col("rest") - F.col("ahead")).withColumn("fits", F.lit(False))
    for _ in range(PASSES):
        may = ~F.col("fits") & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
        last = last.withColumn("upto", F.sum(F.when(may, F.col("size"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        last = last.withColumn("new", F.coalesce(may & (F.col("upto") <= F.col("gap")), F.lit(False)))
        last = last.withColumn("gap", F.col("gap") - F.coalesce(F.max(F.when(F.col("new"), F.col("upto"))).over(Window.partitionBy("sid")), F.lit(0))).withColumn("fits", F.col("fits") | F.col("new"))
    last = last.drop("upto", "new")
    edge = durable(last.where("not fits and size > 0").select("sid", "size", "number", "gap"), "edge")
    doubling = Window.partitionBy("sid", F.floor(F.log2("size"))).orderBy("number")
    offers, gaps = defaultdict(list), {}
    for r in edge.withColumn("nth", F.row_number().over(doubling)).where("nth <= 2").collect():
        offers[r.sid].append((r["size"], r.number))
        gaps[r.sid] = r.gap
    filled = spark.createDataFrame([(sid, number) for sid, own in offers.items() for number in fillers(gaps[sid], own)], "sid int, number int").withColumn("fills", F.lit(True))

    leaves = split(spark, quotas, shards)
    each = leaves.select("sid", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("place"), "shard").join(small(sources.select("sid", "blocks"), len(info)), "sid")
    dealt = each.groupBy("sid", (F.col("place") % F.col("blocks")).alias("block")).agg(F.array_sort(F.collect_list(F.struct("place", "shard"))).alias("drawn"))  # CAP at most
    edges = last.join(F.broadcast(filled), ["sid", "number"], "left").withColumn("spared", ~(F.col("fits") | F.coalesce("fills", F.lit(False))) & (F.col("rest") > 0)).drop("number", "gap", "fits", "fills")
    placed = edges.unionByName(rows.where("block != last").withColumn("spared", F.lit(False)))
    drawn = F.coalesce(F.col("drawn.shard"), F.array().cast("array<long>"))
    return (
        placed.join(small(dealt, int(sum(x[6] for x in info))), ["sid", "block"], "left")
        .withColumn("shards", F.slice(drawn, F.lit(1), F.size(drawn) - F.col("spared").cast("int")))
        .withColumn("copies", F.size("shards"))
        .select(F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "shards", *[F.col("carry")[c].alias(c) for c in carry])
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", shards: int | None = None) -> DataFrame:
    """The mix itself: docs' columns, a row for each copy taken, dealt to shards and shuffled locally.
    Documents without words give nothing to a mix of words and are left out."""
    columns = docs.columns
    whole = plan(docs.withColumn("__row", F.struct(*columns)), key, text, source, ("__row",), shards)
    shuffled = [F.xxhash64(F.lit(SEED), "__copy", F.col("__row")[key], F.col("__row")[text]), F.col("__row")[text]]
    return (
        whole.where("size > 0")
        .select("__row", F.posexplode("shards").alias("__copy", "__shard"))
        .repartition(*([shards] if shards else []), "__shard")
        .sortWithinPartitions("__shard", *shuffled)
        .select("__row.*")
    )
